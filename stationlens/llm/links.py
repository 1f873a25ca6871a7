"""Connected components of link tables, by alternating hooking and shortcutting."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); component is the least node.

    Each round every node takes the least label among itself and its neighbours, then the
    label of that label; rounds end when no label changes.  Labels meet as minima, which
    combine before the shuffle, so a node with very many links is no larger task; tables are
    written between rounds.
    """
    spark = links.sparkSession
    both, edge_path = common.stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels, path = common.stored(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "node", "left").select(
            "node", "label", F.least("label", F.coalesce("near", "label")).alias("hook")
        )
        parents = labels.select(F.col("node").alias("hook"), F.col("label").alias("above"))
        moved, moved_path = common.stored(
            hooked.join(parents, "hook", "left").select(
                "node", F.least("hook", F.coalesce("above", "hook")).alias("label"),
                (F.least("hook", F.coalesce("above", "hook")) < F.col("label")).alias("changed"),
            ),
            "labels",
        )
        changed = moved.where("changed").limit(1).count()
        common.remove(spark, path)
        labels, path = moved.drop("changed"), moved_path
        if not changed:
            common.remove(spark, edge_path)
            return labels.select("node", F.col("label").alias("component"))
