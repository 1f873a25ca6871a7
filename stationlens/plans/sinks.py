"""Result sinks (K1-K3): Parquet by default, or the reference's plain text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.format import py_str

# Below this many observations every result is one file; above,
# up to four files (never more than the cluster's default parallelism).
SINGLE_FILE_ROWS = 100_000
MAX_OUTPUT_FILES = 4


def num_output_partitions(spark: SparkSession, records: int) -> int:
    """K3: output file count from the number of kept observations."""
    return 1 if records < SINGLE_FILE_ROWS else min(MAX_OUTPUT_FILES, spark.sparkContext.defaultParallelism)


# Fixed value: how Python prints a missing value.
MISSING = "None"


def text_line(*cols: Column) -> Column:
    """K2: ``a,b,c`` with no header and no quoting; doubles printed as Python does.

    A NULL is written as ``None``, so that the values after it keep their places.
    """
    return F.concat_ws(",", *[F.coalesce(c, F.lit(MISSING)) for c in cols]).alias("value")


def as_text(df: DataFrame, float_cols: tuple[str, ...] = ()) -> DataFrame:
    """Render every column, in order, as one comma-joined text line."""
    cols = [py_str(F.col(c)) if c in float_cols else F.col(c).cast("string") for c in df.columns]
    return df.select(text_line(*cols))


def write_result(df: DataFrame, path: str, partitions: int, fmt: str = "parquet") -> None:
    """K1: delete-and-replace ``path`` (any Hadoop file system) with ``df``.

    Text has the file count of K3: ``coalesce(1)`` for one file (small results
    only), else ``repartition`` -- a shuffle of result rows -- so the roll-up that
    produces them keeps its full parallelism.  Parquet follows the plan's own
    partitions.
    """
    if fmt == "text":
        shaped = df.coalesce(1) if partitions == 1 else df.repartition(partitions)
        shaped.write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").parquet(path)
