"""Station dimension from the first data row of each file.

The reference reads files one by one on the driver; here the first row of every
file comes from a distributed listing (or, for lines of a table, from a window), is
parsed with the same column expressions as the climate job, and deduplicated by an
aggregation, so the work is spread over the cluster however many files there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.format import py_fixed
from ..functions.text import clean_field, number_text, tokenize
from ..functions.values import parse_float
from ..sources.text import files_with_first_row, first_row_per_file
from .parse import once

# Positions of the station attributes (the same in both layouts;
# in the 29-field layout the name spans positions 5 and 6).
STATION_POS, LAT_POS, LON_POS, ELEV_POS, NAME_POS = 0, 2, 3, 4, 5

DIM_COLUMNS = ("station", "name", "latitude", "longitude", "elevation")


def station_rows(lines: DataFrame) -> DataFrame:
    """G1 per file: ``file_path, ok`` and the parsed attributes of its first data row.

    ``ok`` is false for a first row that is neither 28 nor 29 fields long or
    whose coordinates/elevation are not numbers (the reference counts the file
    as failed).  Files without a data row do not appear.
    """
    return rows_from_first(first_row_per_file(lines))


def rows_from_first(first: DataFrame) -> DataFrame:
    """:func:`station_rows` of given first data rows (``file_path, value``)."""
    t = first.select("file_path", once(tokenize(F.col("value"))).alias("_t"))

    def tok(i: int):
        return F.try_element_at(F.col("_t"), F.lit(i + 1))  # NULL past the end

    n = F.size("_t")
    texts = F.struct(
        n.alias("n"),
        clean_field(tok(STATION_POS)).alias("station"),
        number_text(tok(LAT_POS)).alias("lat"),
        number_text(tok(LON_POS)).alias("lon"),
        number_text(tok(ELEV_POS)).alias("elev"),
        clean_field(tok(NAME_POS)).alias("name1"),
        clean_field(tok(NAME_POS + 1)).alias("name2"))
    x = t.select("file_path", once(texts).alias("_x")).select("file_path", "_x.*")
    lat, lon, elev = (parse_float(F.col(c), stripped=True) for c in ("lat", "lon", "elev"))
    name = F.when(F.col("n") == 28, F.col("name1")).when(
        F.col("n") == 29, F.concat(F.col("name1"), F.lit(", "), F.col("name2")))
    parsed = x.select("file_path", "n", "station", name.alias("name"),
                      lat.alias("latitude"), lon.alias("longitude"), elev.alias("elevation"))
    ok = (F.col("n").isin(28, 29) & F.col("latitude").isNotNull()
          & F.col("longitude").isNotNull() & F.col("elevation").isNotNull())
    return parsed.select("file_path", F.coalesce(ok, F.lit(False)).alias("ok"), *DIM_COLUMNS)


def station_dimension(lines: DataFrame) -> DataFrame:
    """G1 + G2: one row per station; the first file (by path) wins."""
    return dimension_from_rows(station_rows(lines))


def dimension_from_rows(rows: DataFrame) -> DataFrame:
    """G2 on :func:`station_rows` output.

    ``min_by`` is an aggregate, so duplicates of a busy station combine
    map-side before the shuffle.
    """
    rows = rows.filter("ok")
    best = F.min_by(F.struct(*[c for c in DIM_COLUMNS if c != "station"]), F.col("file_path"))
    return rows.groupBy("station").agg(best.alias("_a")).select("station", "_a.*")


def extraction_report(lines: DataFrame) -> DataFrame:
    """One row ``files, stations, failed_files`` of the files seen in ``lines``, in one scan.

    Jobs on real files count the listing instead (:func:`report_from_rows`): it has
    zero-byte files, which no scan returns.
    """
    rows = rows_from_first(files_with_first_row(lines))
    return rows.agg(F.count(F.lit(1)).alias("files"), *_ok_columns()).select(
        "files", "stations", (F.col("files") - F.col("ok_files")).alias("failed_files"))


def _ok_columns() -> list[Column]:
    return [F.count_if("ok").alias("ok_files"), F.count_distinct(F.when(F.col("ok"), F.col("station"))).alias("stations")]


def report_from_rows(rows: DataFrame, total_files: int) -> DataFrame:
    """G3 on :func:`station_rows` output and the listed file count."""
    files = F.lit(total_files).cast("bigint")
    return rows.agg(*_ok_columns()).select(files.alias("files"), "stations", (files - F.col("ok_files")).alias("failed_files"))


def station_centre(dim: DataFrame) -> DataFrame:
    """Mean latitude and longitude over the stations (exact decimal sums)."""
    def mean(c: str):
        x = F.col(c)
        held = ~F.isnan(x) & (F.abs(x) != float("inf"))
        other = F.sum(F.when(~held, x))  # nan and inf count, as in a sum of floats
        exact = F.sum(F.when(held, x).cast("decimal(30,10)")).cast("double")
        return F.when(other.isNull(), exact).otherwise(other) / F.count(F.lit(1))
    return dim.agg(mean("latitude").alias("centre_latitude"), mean("longitude").alias("centre_longitude"))


def station_markers(dim: DataFrame) -> DataFrame:
    """Map-ready marker rows, text formatted exactly as the reference's map."""
    return dim.select(
        "station", "latitude", "longitude",
        F.concat(F.col("name"), F.lit(" ("), F.col("station"), F.lit(")")).alias("tooltip"),
        F.concat(py_fixed(F.col("latitude"), 4), F.lit("°")).alias("latitude_text"),
        F.concat(py_fixed(F.col("longitude"), 4), F.lit("°")).alias("longitude_text"),
        F.concat(py_fixed(F.col("elevation"), 1), F.lit(" m")).alias("elevation_text"))
