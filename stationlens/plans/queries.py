"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them start from the raw GSOD-style lines that Spark derives from the
driver's tables (``stationlens.sources.tables.gsod_lines``) and run the full
pipeline -- tokenise, clean, validate, aggregate -- over the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.events import EVENT_NAMES
from ..functions.text import ALL_RAW, VALUES, clean_field, csv_value, split_fields, tokenize
from ..operators import climate, cube, parse, stations
from ..session import checkpoint_dir
from ..sources.tables import gsod_lines, render_files, render_lines, table
from ..sources.text import InputFiles, first_row_of_each_file, preview, read_lines
from .jobs import JOB_REPORT, OUTPUTS, path_exists, run_climate_job, run_station_job
from .report import summary_lines


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gsod_lines(spark, sf_dir)


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.observations(_lines(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.valid_records(_lines(spark, sf_dir))


def _strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with PRCP 99.99 read as missing."""
    return parse.observations(_lines(spark, sf_dir), prcp_missing=99.99)


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.station_month_cube(_obs(spark, sf_dir))


def observations_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation parsed from raw text, flags as columns."""
    obs = parse.event_columns(_obs(spark, sf_dir))
    return obs.select("station", "date", "year", "month", "season", *parse.MEASURE_COLUMNS, "frshtt",
                      *[n.lower() for n in EVENT_NAMES])


def field_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per token count (28 = compact, 29 = name split at its comma)."""
    t = parse._tokens_all(_lines(spark, sf_dir), ())
    return t.groupBy(F.size("_t").alias("n_fields")).agg(F.count(F.lit(1)).alias("lines"))


def station_month_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cube(spark, sf_dir)
    return c.select(*cube.KEY, "n_obs", F.col("sum_temp").cast("double").alias("sum_temp"),
                    F.col("sum_prcp").cast("double").alias("sum_prcp"), "n_prcp",
                    "max_max_temp", "max_gust", *[n.lower() for n in EVENT_NAMES])


def _rendered(spark: SparkSession, sf_dir: str, fixed: dict[str, str] | None = None) -> str:
    """The lines as files in the shared folder; their glob."""
    return render_files(spark, sf_dir, f"{checkpoint_dir(spark)}/gsod-{uuid.uuid4().hex}", fixed)


def _part(c: str, key: str):
    """A partition value in a path."""
    return F.regexp_extract(c, f"/{key}=([^/]*)/", 1)


def lines_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many stations have how many lines, whatever files hold them."""
    lines = read_lines(spark, _rendered(spark, sf_dir))
    counts = lines.groupBy(_part("file_path", "name").alias("name")).agg(F.count(F.lit(1)).alias("lines"))
    return counts.groupBy("lines").agg(F.count(F.lit(1)).alias("files"))


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 on real files: the first data row of each station's first file, by its station, field count and date."""
    first = first_row_of_each_file(InputFiles(spark, _rendered(spark, sf_dir).replace("/part=*/", "/part=0/")))
    t = first.select(tokenize(F.col("value")).alias("t"))
    return t.select(clean_field(F.get("t", F.lit(0))).alias("station"), F.size("t").alias("n_fields"),
                    clean_field(F.get("t", F.lit(1))).alias("date"))


def _climate_output(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """The climate job on files of all lines; it takes lines from any files, so these hold many stations."""
    run = uuid.uuid4().hex
    out = f"{checkpoint_dir(spark)}/climate-{run}"
    return out, run_climate_job(spark, render_lines(spark, sf_dir, f"{checkpoint_dir(spark)}/gsod-{run}"), out)


def _text_columns(spark: SparkSession, path: str, schema: str) -> DataFrame:
    names = [c.split() for c in schema.split(", ")]
    v = F.split("value", ",")
    return spark.read.text(path).select(*[F.get(v, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(names)])


def climate_job_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly means as the job's text output has them."""
    out, _ = _climate_output(spark, sf_dir)
    return _text_columns(spark, f"{out}/monthly_avg_temp", "station string, year int, month int, avg_temp double")


def climate_job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event counts as the job's text output has them."""
    out, _ = _climate_output(spark, sf_dir)
    return _text_columns(spark, f"{out}/extreme_events", "station string, event_type string, event_count bigint")


def climate_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: how many text files the job has written for each result."""
    out, _ = _climate_output(spark, sf_dir)
    files = spark.read.format("binaryFile").load([f"{out}/{name}/part-*" for name in OUTPUTS])
    result = F.element_at(F.split("path", "/"), -2).alias("result")
    return files.select(result).groupBy("result").agg(F.count(F.lit(1)).alias("files"))


def preview_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 on texts in the order of their ids."""
    return preview(table(spark, sf_dir, "documents").orderBy("doc_id").select(F.col("text").alias("value")))


def climate_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the counts of the job's report, as it has written them (one row)."""
    out, _ = _climate_output(spark, sf_dir)
    return spark.read.parquet(f"{out}/{JOB_REPORT}")


def station_job_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The markers that the station job has written."""
    out = f"{checkpoint_dir(spark)}/stations-{uuid.uuid4().hex}"
    run_station_job(spark, _rendered(spark, sf_dir), out)
    schema = ("station string, latitude double, longitude double, tooltip string, latitude_text string, "
              "longitude_text string, elevation_text string")
    return spark.read.schema(schema).json(f"{out}/markers")


def jobs_without_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs on a missing path, on files that only have a header, and on all lines
    with their readings missing and their coordinates unreadable; with the lines or files they saw."""
    unusable = _rendered(spark, sf_dir, {"TEMP": "9999.9", "LATITUDE": "unknown"})
    inputs = {"missing": "no-such-scheme://none/here", "header only": unusable.replace("/name=*/", "/name=N*/"),
              "none valid": unusable}
    rows = []
    for kind, path in inputs.items():
        for job, run, seen in (("climate", run_climate_job, "lines"), ("stations", run_station_job, "files")):
            out = f"{checkpoint_dir(spark)}/none-{uuid.uuid4().hex}"
            report = run(spark, path, out)
            rows.append((kind, job, "error" in report, path_exists(spark, out), report.get(seen)))
    return spark.createDataFrame(rows, "input string, job string, error boolean, written boolean, seen long")


def tokenise_odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on lines with doubled, stray and cut quotes, made of ``customer``."""
    line = F.expr("""case c_custkey % 4
        when 0 then concat('"', c_name, '","', cast(c_nationkey as string), '""', c_mktsegment, '","', c_mktsegment, '"')
        when 1 then concat(c_name, ',"', cast(c_nationkey as string), ',', c_mktsegment, '",', c_mktsegment)
        when 2 then concat('"', c_name, '","', cast(c_nationkey as string), '"', c_mktsegment, '"', ',",')
        else concat(c_name, ', "', cast(c_nationkey as string), '",', c_mktsegment) end""")
    t = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), split_fields(line).alias("f"))
    value = F.transform("f.v", lambda x, i: F.when(
        (F.col("f.kind") == ALL_RAW) | ((F.col("f.kind") != VALUES) & (i == 0)), csv_value(x)).otherwise(x))
    return t.select("id", value.alias("v")).select(
        "id", F.size("v").alias("n_fields"), *[F.get("v", F.lit(i)).alias(n) for i, n in enumerate(("first", "second", "third"))])


def summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_lines(climate.climate_summary(_obs(spark, sf_dir)))


def _on_lines(fn):
    return lambda spark, sf_dir: fn(_lines(spark, sf_dir))


def _on_obs(fn):
    return lambda spark, sf_dir: fn(_obs(spark, sf_dir))


def _on_records(fn):
    return lambda spark, sf_dir: fn(_records(spark, sf_dir))


def _on_cube(fn):
    return lambda spark, sf_dir: fn(_cube(spark, sf_dir))


def _rounded(query, column: str):
    """A mean of DOUBLE means hangs on the order of its sum in the last digits: six places are shown."""
    return lambda spark, sf_dir: query(spark, sf_dir).withColumn(column, F.round(column, 6))


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.station_dimension(_lines(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources, parsing
    "observations_from_raw": observations_from_raw,
    "field_layouts": field_layouts,
    "ingest_profile": _on_lines(parse.ingest_profile),
    # aggregations over observations
    "monthly_avg_temp": _on_obs(climate.monthly_avg_temp),
    "yearly_avg_temp": _on_obs(climate.yearly_avg_temp),
    "seasonal_avg_prcp": _on_obs(climate.seasonal_avg_prcp),
    "station_max_temp": _on_obs(climate.station_max_temp),
    "extreme_events": _on_obs(climate.extreme_events),
    "event_totals": _on_records(climate.event_totals),
    "year_mean_of_stations": _rounded(
        _on_obs(lambda o: climate.year_mean_of_stations(climate.yearly_avg_temp(o))), "avg_temp"),
    "station_total_prcp": _on_obs(climate.station_total_prcp),
    "station_max_gust": _on_obs(climate.station_max_gust),
    "station_total_temp": _on_records(climate.station_total_temp),
    "distinct_stations": _on_obs(climate.distinct_stations),
    "seasonal_avg_prcp_strict": lambda spark, sf_dir: climate.seasonal_avg_prcp(_strict(spark, sf_dir)),
    # rankings
    "highest_max_temp": _on_obs(climate.highest_max_temp),
    "hottest_year": _rounded(_on_obs(climate.hottest_year), "avg_temp"),
    "wettest_station": _on_obs(climate.wettest_station),
    "wettest_station_strict": lambda spark, sf_dir: climate.wettest_station(_strict(spark, sf_dir)),
    "highest_gust": _on_obs(climate.highest_gust),
    "max_gust_record": _on_records(climate.max_gust_record),
    # summary
    "climate_summary": _rounded(_on_obs(climate.climate_summary), "hottest_year_temp"),
    "summary_lines": summary_text,
    # the station-month cube and roll-ups from it (must equal the direct results)
    "station_month_cube": station_month_cube,
    "monthly_avg_temp_from_cube": _on_cube(cube.monthly_avg_temp),
    "yearly_avg_temp_from_cube": _on_cube(cube.yearly_avg_temp),
    "seasonal_avg_prcp_from_cube": _on_cube(cube.seasonal_avg_prcp),
    "extreme_events_from_cube": _on_cube(cube.extreme_events),
    "highest_max_temp_from_cube": _on_cube(cube.highest_max_temp),
    "hottest_year_from_cube": _rounded(_on_cube(cube.hottest_year), "avg_temp"),
    "wettest_station_from_cube": _on_cube(cube.wettest_station),
    "highest_gust_from_cube": _on_cube(cube.highest_gust),
    # station dimension
    "station_dimension": _dim,
    "station_centre": lambda spark, sf_dir: stations.station_centre(_dim(spark, sf_dir)),
    "station_markers": lambda spark, sf_dir: stations.station_markers(_dim(spark, sf_dir)),
    "extraction_report": _on_lines(stations.extraction_report),
    # sources and jobs on rendered files
    "tokenise_odd_lines": tokenise_odd_lines,
    "lines_of_files": lines_of_files,
    "first_row_per_file": first_rows,
    "climate_job_monthly": climate_job_monthly,
    "climate_job_events": climate_job_events,
    "climate_job_report": climate_job_report,
    "climate_job_files": climate_job_files,
    "preview_lines": preview_lines,
    "station_job_markers": station_job_markers,
    "jobs_without_input": jobs_without_input,
}
