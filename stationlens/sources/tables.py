"""Adapter: GSOD-style inputs derived, in Spark, from the driver's TPC-H tables.

No weather CSV ships with the test data, so ``lineitem`` becomes daily readings
(one "station" per supplier) and ``supplier`` joined with ``nation`` gives the
station attributes.  Every expression below is fixed: the DuckDB oracle
(``stationlens.plans.oracle``) states the same values in SQL.
"""

from __future__ import annotations

import gzip
import os
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The 28 columns of a GSOD daily CSV file, in file order.
GSOD_COLUMNS = (
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME",
    "TEMP", "TEMP_ATTRIBUTES", "DEWP", "DEWP_ATTRIBUTES", "SLP", "SLP_ATTRIBUTES",
    "STP", "STP_ATTRIBUTES", "VISIB", "VISIB_ATTRIBUTES", "WDSP", "WDSP_ATTRIBUTES",
    "MXSPD", "GUST", "MAX", "MAX_ATTRIBUTES", "MIN", "MIN_ATTRIBUTES",
    "PRCP", "PRCP_ATTRIBUTES", "SNDP", "FRSHTT",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _station_id(key: Column) -> Column:
    return F.lpad(key.cast("string"), 11, "0")


# The columns of ``lineitem`` that a reading is made of.
READING_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
                   "l_returnflag", "l_shipdate")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*READING_COLUMNS)


# The readings as numbers.
READINGS = {
    "TEMP": "case when l_orderkey % 97 = 0 then 9999.9 when l_orderkey % 7 = 0 then l_quantity + 0.125"
            " else l_quantity + 0.1 * l_linenumber end",
    "MAX": "case when l_partkey % 89 = 0 then 9999.9 else l_quantity + 20 end",
    "MIN": "l_quantity - 20",
    "PRCP": "case when l_orderkey % 11 = 0 then 99.99 else l_discount end",
    "WDSP": "l_tax * 100",
    "GUST": "case when l_partkey % 13 = 0 then 999.9 else l_quantity end",
}


def _reading_fields() -> dict[str, Column]:
    """The GSOD columns of a daily reading as text, from the columns of ``lineitem``.

    Sentinels (9999.9, 999.9), the unfiltered 99.99 PRCP code, malformed FRSHTT codes,
    readings of three decimals, impossible dates, unreadable numbers and lines of 27 or 30
    fields (:func:`_odd_fields`) are injected by fixed rules so the parsing and cleaning rules have
    work to do.
    """
    readings = {c: F.expr(x).cast("decimal(18,3)").cast("string") for c, x in READINGS.items()}
    frshtt = F.expr(
        "case when l_linenumber = 7 then '123' else concat("
        "cast(l_orderkey % 2 as string), cast(l_partkey % 2 as string), cast(l_suppkey % 2 as string),"
        " case when l_orderkey % 50 = 0 then '1' else '0' end,"
        " case when l_returnflag = 'R' then '1' else '0' end, '0') end")
    return {
        "STATION": _station_id(F.col("l_suppkey")),
        "DATE": F.expr("case when l_orderkey % 53 = 0 then '1995-13-41'"
                       " else substring(cast(cast(l_shipdate as date) as string), 1, 10) end"),
        **readings, "GUST": F.when(F.col("l_partkey") % 71 == 0, F.lit("n/a")).otherwise(readings["GUST"]),
        "FRSHTT": frshtt,
    }


def _odd_fields() -> Column:
    return F.expr("case when l_orderkey % 61 = 0 and l_linenumber = 1 then 27"
                  " when l_orderkey % 67 = 0 and l_linenumber = 2 then 30 end")


def _line_pos() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _with_stations(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    """``items`` with the columns of their supplier and its nation, as the tables have them.

    The two tables are joined one after the other and not with each other first: Catalyst takes
    the size of a join for the product of its sides, but knows that of a table, and so
    broadcasts them as long as they are small.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (items.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left"))


def _station_fields() -> dict[str, Column]:
    """Station attributes as text, from the columns of ``supplier`` and ``nation``."""
    return {
        "NAME": F.concat(F.col("s_name"), F.lit(", "), F.coalesce(F.col("n_name"), F.lit(""))),
        "LATITUDE": F.expr("concat(cast((s_suppkey * 7) % 180 - 90 as string), '.0')"),
        "LONGITUDE": F.expr("concat(cast((s_suppkey * 13 + s_nationkey) % 360 - 180 as string), '.0')"),
        "ELEVATION": F.when(F.col("s_suppkey") % 17 == 0, F.lit("unknown")).otherwise(F.col("s_acctbal").cast("string")),
    }


def _render(fields: dict[str, Column | str], padded: Column) -> Column:
    """One CSV line: every field quoted; padded files use ``", "`` separators and
    right-aligned numbers, which turns the comma in NAME into a field break for a
    CSV reader (the 29-field layout); compact files give 28 fields.

    The fields are joined by the text between two of them, closing and opening quote included, and
    constant fields that follow each other are one text, so
    the expression is short enough for the JIT compiler (8,000 bytes).
    """
    def v(c: str) -> Column:
        text = F.coalesce(fields[c], F.lit(""))
        return F.when(padded, F.lpad(text, 7, " ")).otherwise(text) if c in READINGS else text
    parts = []
    for constant, names in groupby(GSOD_COLUMNS, lambda c: isinstance(fields[c], str)):
        texts = list(names)
        if constant:
            joined = [between.join(fields[c].rjust(7)[:7] if wide and c in READINGS else fields[c] for c in texts)
                      for between, wide in (('", "', True), ('","', False))]
            parts.append(F.when(padded, F.lit(joined[0])).otherwise(F.lit(joined[1])))
        else:
            parts += [v(c) for c in texts]
    between = F.when(padded, F.lit('", "')).otherwise(F.lit('","'))
    return F.concat(F.lit('"'), F.call_function("concat_ws", between, *parts), F.lit('"'))


def _with_odd_fields(line: Column, padded: Column, n: Column) -> Column:
    """Cut or lengthen a line (28 fields if compact, 29 if padded) to ``n`` fields, if given."""
    short = F.when(padded, F.substring_index(line, ", ", 27)).otherwise(F.substring_index(line, ',"', 27))
    more = F.when(padded, F.lit(", 0")).otherwise(F.lit(",0,0"))
    return F.when(n == 27, short).when(n == 30, F.concat(line, more)).otherwise(line)


def _filler(name: str) -> str:
    # Fixed filler values for columns no operator reads.
    if name.endswith("_ATTRIBUTES"):
        return "8"
    return "9999.9" if name == "SLP" else "999.9"


def _with_lines(data: DataFrame, keep: tuple, fixed: dict[str, str] | None = None) -> DataFrame:
    """``keep``, whether the station is padded, and ``value``, the line of a reading of :func:`_with_stations`.

    Two projections, so that a line is made once and the few odd ones are cut from it.
    """
    made = {**_station_fields(), **_reading_fields()}
    fields = {c: made[c] if c in made else _filler(c) for c in GSOD_COLUMNS}
    fields |= fixed or {}
    padded = F.col("l_suppkey") % 2 == 1
    names = [f"_{i}" for i in range(len(keep))]
    lines = data.select(*[c.alias(n) for n, c in zip(names, keep)], padded.alias("_padded"),
                        _odd_fields().alias("_odd"), _render(fields, padded).alias("_line"))
    return lines.select(*names, "_padded", _with_odd_fields(F.col("_line"), F.col("_padded"), F.col("_odd")).alias("value"))


def _header(padded: Column) -> Column:
    """The header line; Catalyst makes a constant of each form."""
    names = {c: F.lit(c) for c in GSOD_COLUMNS}
    return F.when(padded, _render(names, F.lit(True))).otherwise(_render(names, F.lit(False)))


def _path(station: Column) -> Column:
    return F.concat(F.lit("gsod/"), station, F.lit(".csv"))


def _nation_file() -> Column:
    """The station id of a file with nothing but its header, one for every nation."""
    return F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))


def gsod_lines(spark: SparkSession, sf_dir: str, fixed: dict[str, str] | None = None) -> DataFrame:
    """Raw GSOD lines: one "file" per station (odd station keys padded, even
    compact), a header line first, then one line per reading.  ``fixed`` gives columns one
    value in all readings.

    Columns: ``value, file_path, line_pos``.  The join with the station tables are
    equi-joins; Catalyst broadcasts a table only when its statistics say it is small,
    otherwise it sort-merge joins.
    """
    # Line parsing is CPU work and a table of one row group would be one task: deal the rows evenly,
    # by their own key (never by station, which may hold a third of them).
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    items = _line_items(spark, sf_dir).repartition(parts, "l_orderkey", "l_linenumber")
    body = _with_lines(_with_stations(spark, sf_dir, items),
                       (_path(_station_id(F.col("l_suppkey"))), _line_pos()), fixed).select(
        "value", F.col("_0").alias("file_path"), F.col("_1").alias("line_pos"))
    before = F.lit(-1).cast("bigint").alias("line_pos")
    header = table(spark, sf_dir, "supplier").select(
        _header(F.col("s_suppkey") % 2 == 1).alias("value"),
        _path(_station_id(F.col("s_suppkey"))).alias("file_path"), before)
    empty = table(spark, sf_dir, "nation").select(
        _header(F.lit(False)).alias("value"), _path(_nation_file()).alias("file_path"), before)
    return header.unionByName(body).unionByName(empty)


# How rendered lines are written: a tenth (by station) to a quarter (as dealt) of their bytes.
LINE_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def render_lines(spark: SparkSession, sf_dir: str, out: str) -> str:
    """Write :func:`gsod_lines` as files of many stations each, as the lines were dealt; their glob.

    For what reads lines wherever they stand: the files are as many as tasks, not as stations.
    """
    gsod_lines(spark, sf_dir).select("value").write.options(**LINE_FILES).text(out)
    return f"{out}/part-*"


# Lines in one rendered file, about.
FILE_LINES = 1_000_000


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that a path names in a local file system; None in any other."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    scheme = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()
    return hpath.toUri().getPath() if scheme == "file" else None


def _files_of_folders(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write lines (columns: folder below ``root``, line) that come folder by folder, a file for each folder.

    A file gets its name when it is whole, so a task that runs again replaces what it wrote.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, file, files = None, None, 0

        def finish() -> None:
            file.close()
            os.replace(file.name, f"{root}/{at}/part-00000.txt.gz")

        for batch in batches:
            runs, start = pc.run_end_encode(batch.column(0)), 0
            for folder, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if folder != at:
                    if file:
                        finish()
                    os.makedirs(f"{root}/{folder}", exist_ok=True)
                    at, files = folder, files + 1
                    file = gzip.open(f"{root}/{folder}/.{uuid.uuid4().hex}", "wb", compresslevel=1)
                file.write(("\n".join(batch.column(1).slice(start, end - start).to_pylist()) + "\n").encode())
                start = end
        if file:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    return write


def lines_by_file(spark: SparkSession, sf_dir: str, fixed: dict[str, str] | None = None) -> DataFrame:
    """``name, part, value``: the lines of :func:`render_files`, file by file."""
    items = _line_items(spark, sf_dir).withColumn("line_pos", _line_pos())
    large = items.groupBy("l_suppkey").agg(
        F.min("line_pos").alias("first"), F.ceil(F.count(F.lit(1)) / FILE_LINES).cast("int").alias("parts"))
    # One row for a million lines at most.
    large = F.broadcast(large.where("parts > 1").withColumnRenamed("l_suppkey", "large_suppkey"))
    part = F.when(F.col("parts").isNull() | (F.col("line_pos") == F.col("first")), 0).otherwise(
        F.pmod(F.xxhash64("line_pos"), F.col("parts")).cast("int"))
    body = _with_stations(spark, sf_dir, items.join(large, F.col("l_suppkey") == F.col("large_suppkey"), "left")
                          .select(*READING_COLUMNS, "line_pos", part.alias("part"))).withColumn(
        "name", _station_id(F.col("l_suppkey")))
    before = (F.lit(-1).cast("bigint").alias("line_pos"), F.lit(0).alias("part"))
    header = table(spark, sf_dir, "supplier").select(
        _station_id(F.col("s_suppkey")).alias("name"), F.col("s_suppkey").cast("bigint").alias("l_suppkey"), *before)
    empty = table(spark, sf_dir, "nation").select(
        _nation_file().alias("name"), F.lit(0).cast("bigint").alias("l_suppkey"), *before)
    rows = body.unionByName(header.unionByName(empty), allowMissingColumns=True)
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartition(parts, "name", "part").sortWithinPartitions("name", "part", "line_pos")
    lines = _with_lines(placed, tuple(F.col(c) for c in ("name", "part", "line_pos")), fixed)
    value = F.when(F.col("_2") < 0, _header(F.col("_padded")))
    return lines.select(F.col("_0").alias("name"), F.col("_1").alias("part"), value.otherwise(F.col("value")).alias("value"))


def render_files(spark: SparkSession, sf_dir: str, out: str, fixed: dict[str, str] | None = None) -> str:
    """Write :func:`gsod_lines` as files ``name=<station>/part=<number>/part-*``; their glob.

    A station with more than ``FILE_LINES`` lines is dealt to several files by the hash of the line's
    position, so none of its tasks has more; the first has the header and the first
    reading, as the only file of a smaller station has.

    Rows of ``lineitem`` are dealt and sorted with the columns of their station, and become lines
    only as they are written: about 70 bytes of a
    row are shuffled, a line has 247.  The files are
    compressed, and each task moves its own into place (``out`` is read only when all are written).
    In a local file system a task's Python writes them: Hadoop starts a process there for the
    permissions of every file it creates, unless it has its native library.
    """
    lines = lines_by_file(spark, sf_dir, fixed)
    folder = _local_folder(spark, out)
    if folder is None:
        (lines.write.partitionBy("name", "part").options(**LINE_FILES)
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(out))
    else:
        place = F.concat(F.lit("name="), F.coalesce("name", F.lit("__HIVE_DEFAULT_PARTITION__")),
                         F.lit("/part="), F.col("part").cast("string"))
        lines.select(place, "value").mapInArrow(_files_of_folders(folder), "files bigint").agg(F.sum("files")).collect()
    return f"{out}/name=*/part=*/part-*"
