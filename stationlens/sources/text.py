"""Raw text sources: load lines, profile them, drop headers, first row per file.

A *lines* DataFrame has at least ``value STRING`` and ``file_path STRING``; when it
comes from files it also carries ``file_block_start`` (offset of the split a line
was read from).  Lines built from tables carry an explicit ``line_pos`` instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_field, tokenize


class NoInputError(RuntimeError):
    """The input path does not exist or cannot be read (reference: log, write nothing)."""


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of one file, a directory (its ``*.csv`` files) or a glob.

    Splits are planned by Spark (``spark.sql.files.maxPartitionBytes``); small files
    are packed together, large ones split, so the scan scales with the cluster.
    """
    return _with_places(_load(spark, path, "text"))


def _with_places(text: DataFrame) -> DataFrame:
    return text.select("value", F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_block_start").alias("file_block_start"))


def _load(spark: SparkSession, path: str | list[str], fmt: str) -> DataFrame:
    """The files of ``path``; :class:`NoInputError` if they can't be reached for any reason."""
    reader = spark.read.format(fmt)
    paths = [path] if isinstance(path, str) else list(path)
    try:
        if len(paths) == 1 and _is_directory(spark, paths[0]):
            reader = reader.option("pathGlobFilter", "*.csv")
        return reader.load(paths)
    except (PySparkException, Py4JJavaError) as exc:  # missing, unreadable, unknown scheme
        raise NoInputError(str(exc)) from exc


def _is_directory(spark: SparkSession, path: str) -> bool:
    """Ask the cluster's Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        return bool(fs.getFileStatus(hpath).isDirectory())
    except Py4JJavaError:  # glob or missing path: let the reader decide
        return False


def preview(lines: DataFrame, n: int = 3, width: int = 200) -> DataFrame:
    """First ``n`` lines, cut to ``width`` characters (a limit is the feature here)."""
    return lines.select(F.left(F.col("value"), F.lit(width)).alias("line")).limit(n)


def is_header(line: Column) -> Column:
    """True for a header line: its first field reads ``STATION``."""
    return clean_field(F.element_at(tokenize(line), 1)) == F.lit("STATION")


def drop_header(lines: DataFrame) -> DataFrame:
    """Drop header lines of every file (each GSOD file starts with one)."""
    return lines.filter(~F.coalesce(is_header(F.col("value")), F.lit(False)))


def _first_two(lines: DataFrame) -> DataFrame:
    """``file_path, value, _rank`` of lines 1 and 2 of each file, by position.

    With file input only the first split of a file can hold rows 1 and 2, and
    ``monotonically_increasing_id`` follows the read order inside a split.  The
    ``row_number() <= 2`` filter lets Catalyst insert a per-partition
    ``WindowGroupLimit``, so at most two rows per file reach the shuffle.
    """
    if "line_pos" in lines.columns:
        ordered = lines
    else:
        ordered = (lines.filter(F.col("file_block_start") == 0)
                   .withColumn("line_pos", F.monotonically_increasing_id()))
    w = Window.partitionBy("file_path").orderBy("line_pos")
    ranked = ordered.select("file_path", "value", F.row_number().over(w).alias("_rank"))
    return ranked.filter(F.col("_rank") <= 2)


def first_row_per_file(lines: DataFrame) -> DataFrame:
    """The first data row of each file: skip row 1 by position, keep row 2."""
    return _first_two(lines).filter(F.col("_rank") == 2).drop("_rank")


def files_with_first_row(lines: DataFrame) -> DataFrame:
    """``file_path, value`` of every file that has a line; ``value`` is NULL without a second one.

    Files are already together after the window, so this groups them without a further shuffle.
    """
    return _first_two(lines).groupBy("file_path").agg(F.max(F.when(F.col("_rank") == 2, F.col("value"))).alias("value"))


# Bytes that are read of a file at first; more only while its second line has not ended.
HEAD_BYTES = 16 * 1024

# Schemes of Hadoop paths and the names Arrow has for them.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _arrow_file(path: str):
    """Arrow's file system and path for a Hadoop path; ValueError if there is none for it."""
    from pyarrow import fs

    scheme, rest = re.match(r"(?:([a-zA-Z][\w+.-]*):)?(.*)", path, re.DOTALL).groups()
    if (scheme or "file") not in ARROW_SCHEMES:
        raise ValueError(f"no Arrow file system for {path}")
    if (scheme or "file") == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{ARROW_SCHEMES[scheme]}:{rest}")
    except (pa.ArrowException, OSError, ImportError) as exc:
        raise ValueError(str(exc)) from exc


def _second_line(path: str) -> str | None:
    """The second line of a file, or None; reads no further than it ends."""
    system, name = _arrow_file(path)
    data = b""
    with system.open_input_stream(name) as stream:
        while True:
            more = stream.read(max(HEAD_BYTES, len(data)))
            data += more
            # A carriage return at the very end may be half of a line break.
            lines = re.split(rb"\r\n|\n|\r", data[:-1] if more and data.endswith(b"\r") else data)
            if not more or len(lines) > 2:
                break
    if len(lines) < 2 or (len(lines) == 2 and not lines[1]):
        return None
    return lines[1].decode("utf-8", "replace")


class InputFiles:
    """The files of a path, listed once; zero-byte files included."""

    def __init__(self, spark: SparkSession, path: str | list[str]):
        self.spark, self.path = spark, path
        self.text = _load(spark, path, "text")
        self.names = self.text._jdf.inputFiles()  # a Java array, which is not copied
        self.count = len(self.names)

    def bytes_each(self) -> float:
        """Mean size, from the statistics of the listing."""
        size = self.text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return float(str(size)) / max(self.count, 1)

    def lines(self) -> DataFrame:
        return _with_places(self.text)


# Files of up to this mean size are scanned whole: a task reads many of them in one go.
SCANNED_BYTES = 1 << 20


def first_row_of_each_file(files: InputFiles) -> DataFrame:
    """``file_path, value`` of the second line of every file that has one.

    Small files are scanned by Spark (:func:`first_row_per_file`).  Of larger ones, dealt evenly
    from the listing, tasks read the first bytes through Arrow.  Where Arrow can't open the first
    of them in a task (no file system for the scheme, credentials that only Hadoop has),
    they are scanned too.
    """
    if files.bytes_each() <= SCANNED_BYTES or not _heads_readable(files):
        return first_row_per_file(files.lines())
    listed = _load(files.spark, files.path, "binaryFile").select(F.col("path").alias("file_path"))
    dealt = listed.repartition(files.spark.sparkContext.defaultParallelism, "file_path")
    return dealt.mapInArrow(_heads, "file_path string, value string")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        rows = [(p, v) for p in paths if (v := _second_line(p)) is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["file_path", "value"])


def _heads_readable(files: InputFiles) -> bool:
    """Whether a task can open one of the files through Arrow."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            opened = []
            for path in batch.column(0).to_pylist():
                try:
                    _second_line(path)
                    opened.append(True)
                except (ValueError, OSError, pa.ArrowException):
                    opened.append(False)
            yield pa.RecordBatch.from_arrays([pa.array(opened, pa.bool_())], names=["opened"])

    if not files.count:
        return True
    one = files.spark.createDataFrame([(files.names[0],)], "file_path string")
    return one.mapInArrow(probe, "opened boolean").first().opened


def count_input_files(spark: SparkSession, path: str | list[str]) -> int:
    """Number of input files, zero-byte files included (listing only, no scan)."""
    return InputFiles(spark, path).count
