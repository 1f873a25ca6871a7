"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words (see ``targets``); each of its documents is expected
``target / source size`` times.  Documents of a source lie in one order, by size, then by the md5
of the id; prefix sums of the expected copies are shifted by one random offset of the source, and
a document is emitted once for every whole number that its stretch of the sums crosses.  In
order of size the words taken differ from the target by no more than the source's longest document.

DataFrame functions only.  Rows alike in source, size, id and text are one *unit* with a count, so
a repeated row is no hot group.  A unit's place is the sum of three counts: of smaller sizes in the
source (a row a size), of earlier buckets of its size (a bucket is a range of md5s, as many
as keep buckets at ``BUCKET`` rows), and of earlier units of the bucket.  So no window holds a
source, however large that is.  Sums are whole numbers (the expected copies as a fraction of
2^24), so results don't depend on partitions, and no document exceeds ``most_copies``.

Defined cases: null and empty texts, and texts of white space, have size 0 and are copied like others
(0 words); a null source is a source of its own, after all others, '' one before all others; null ids
are ordered as the text '', and rows that repeat an id are emitted one by one; a source whose documents
are all empty has the target 0 and takes nothing; an empty table gives an empty table; other columns
are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Copies are counted in fractions of a document.
ONE = 1 << 24
#: Units of one size in a bucket, about.
BUCKET = 50_000
#: Rows that one row is unfolded to at a time.
CHUNK = 10_000
#: Sources are broadcast up to this number.
MAX_BROADCAST_SOURCES = 100_000
SPACES = "\t\n\x0b\x0c\r "


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; 0 for null.

    Every word with the white space after it becomes one sign, and what stood before the first
    word goes.
    """
    signs = F.regexp_replace(text, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.coalesce(F.length(F.translate(signs, SPACES, "")), F.lit(0)).cast("long")


def units(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(source, size, doc_id, digest, id_key, m): rows alike, counted."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"),
        F.col(id_col).cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("digest"),
    )
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return (
        rows.groupBy("source", "size", "doc_id", "digest").agg(F.count("*").alias("m"))
        .withColumn("id_key", F.md5(id_text.cast("binary")))
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_copies: int = 3) -> DataFrame:
    """(source, source_size, number, weight, target) of sources (source, source_size).

    Sources in code point order, null last, weigh ``weights``, repeating.  Together they get all
    sizes; a target stops at ``most_copies`` times its source, and the excess is shared again by
    weight, until none is above.  The shares only grow, so a source that stops stays stopped.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    # One row a source.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("number", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    named, path = common.stored(named, "mix-sources")
    most = F.col("source_size") * most_copies
    share, stopped = 0.0, -1
    while True:
        full = most <= share * F.col("weight")
        left = named.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, most).otherwise(0)).alias("given"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weights"), F.count_if(full).alias("stopped"),
        ).first()
        if not left["weights"] or left["stopped"] == stopped:
            break
        share, stopped = (left["all"] - left["given"]) / left["weights"], left["stopped"]
    target = F.least(most.cast("double"), F.lit(share) * F.col("weight"))
    done, _ = common.stored(named.withColumn("target", target), "mix-targets")
    common.remove(sizes.sparkSession, path)
    return done


def _offset(source: Column, seed: str) -> Column:
    """One whole number below ONE, drawn from the seed and the source."""
    text = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    most_copies: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, source, digest (md5 of the text), size, source_size, target, copies, taken of every row."""
    spark = docs.sparkSession
    found, found_path = common.stored(units(docs, id_col, text_col, source_col), "mix-units")
    sizes = found.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    sources = targets(sizes, weights, most_copies)
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * ONE)).otherwise(F.lit(0))
    rated = sources.withColumns({"expected": expected.cast("long"), "offset": _offset(F.col("source"), seed)})
    if sources.count() <= MAX_BROADCAST_SOURCES:
        rated = F.broadcast(rated)

    # As many hexadecimal signs of the id's md5 as keep a bucket small, if all rows had one size.
    rows, signs = found.count(), 0
    while rows > BUCKET * 16**signs:
        signs += 1
    of_source = rated.withColumnRenamed("source", "name")
    numbered = found.join(of_source, F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "bucket", F.substring("id_key", 1, signs)
    )

    def before(partition: list[str], *order: str) -> Column:
        return F.coalesce(
            F.sum("m").over(Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    by_size = numbered.groupBy("number", "size").agg(F.sum("m").alias("m")).select(
        "number", "size", before(["number"], "size").alias("smaller")
    )
    by_bucket = numbered.groupBy("number", "size", "bucket").agg(F.sum("m").alias("m")).select(
        "number", "size", "bucket", before(["number", "size"], "bucket").alias("earlier")
    )
    inside = before(["number", "size", "bucket"], "id_key", "doc_id", "digest")
    placed, _ = common.stored(
        numbered.withColumn("inside", inside).join(by_bucket, ["number", "size", "bucket"]).join(by_size, ["number", "size"])
        .select(
            "doc_id", "source", "digest", "size", "source_size", "target", "m", "expected", "offset",
            (F.col("smaller") + F.col("earlier") + F.col("inside")).alias("place"),
        ),
        "mix-placed",
    )
    common.remove(spark, found_path)

    # Each row of a unit in turn; units of very many rows are dealt out first.
    few = placed.where(F.col("m") <= CHUNK).withColumn("chunk", F.lit(0).cast("long"))
    many = (
        placed.where(F.col("m") > CHUNK).withColumn("chunk", F.explode(F.expr(f"sequence(0, (m - 1) div {CHUNK})")))
        .repartition("doc_id", "digest", "chunk")
    )
    last = F.least(F.col("m"), (F.col("chunk") + 1) * CHUNK) - 1
    each = few.unionByName(many).withColumn("i", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    copies = crossings(F.col("place") + F.col("i"), F.lit(1))
    return each.withColumn("copies", copies).select(
        "doc_id", "source", "digest", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def crossings(place: Column, n: Column) -> Column:
    """Whole numbers that the shifted sums cross over ``n`` documents from ``place`` on."""
    def sums(x: Column) -> Column:
        return F.shiftright(F.col("offset") + x * F.col("expected"), 24)

    return sums(place + n) - sums(place)


def texts(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, text, copy) of the mix: every text as often as ``mixed`` takes it, copy by copy."""
    keys = ["doc_id", "source", "digest"]
    wanted = mixed.groupBy(*keys).agg(F.sum("copies").alias("copies")).where("copies > 0")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.md5(text.cast("binary")).alias("digest"), text.alias("text"),
    ).groupBy(*keys).agg(F.first("text").alias("text"))
    w = wanted.toDF("w_id", "w_source", "w_digest", "copies")
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & F.col("source").eqNullSafe(F.col("w_source")) & (F.col("digest") == F.col("w_digest"))
    return (
        own.join(w, same)
        .withColumn("chunk", F.explode(F.expr(f"sequence(0, (copies - 1) div {CHUNK})")))
        .withColumn("copy", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(copies, (chunk + 1) * {CHUNK}) - 1)")))
        .select("doc_id", "source", "text", "copy")
    )
