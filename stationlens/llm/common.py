"""Shared helpers: scratch tables in the shared folder, column picking, fixed folds."""

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder of its own; a session
    on a cluster is refused, as its executors could not see such a folder.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="stationlens-llm-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return _own_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back; with its path.

    This cuts the lineage: what reads the table survives the loss of any executor
    without repeating the work behind it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def give_back() -> None:
    """Return freed memory to the system, which Arrow's pool and the C library else keep.

    Python workers wait for their next task with all that they kept, beside those that run.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function from batches to batches, that gives memory back when a task is done."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def sampled(rows: DataFrame, key: Column, n: int) -> DataFrame:
    """``n`` different rows, those of the least ``key`` (a hash); all, if there are fewer.

    Only rows in the first (n and some more) parts of all different ones, by their key, are looked
    at, and rows alike combine before they are sent, so neither many partitions nor
    repeated rows bring more to one task.
    """
    different = rows.agg(F.approx_count_distinct(key, 0.02)).first()[0]
    few = rows
    if different > 2 * n:
        share = (1.15 * n + 6 * n**0.5 + 16) / different
        few = rows.where(F.shiftrightunsigned(key, 2) < int(min(share, 1) * 2**62))  # of a 62-bit number
    return few.distinct().orderBy(F.shiftrightunsigned(key, 2), *rows.columns).limit(n)


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (string, null as empty), whatever else ``df`` has."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)
