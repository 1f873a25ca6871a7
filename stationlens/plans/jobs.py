"""Job entry points: the climate job (J1) and the station job.

The climate job scans the raw lines once: the scan feeds one aggregation into
the station-month cube, which is written to the shared checkpoint folder (lineage
is cut there, so a lost executor never forces a rescan of the raw data), and all
six results are small roll-ups of that table.  The reference runs 22 separate
actions with three full scans of the raw text.
"""

from __future__ import annotations

import argparse
import logging
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import climate, cube, parse, stations
from ..session import checkpoint_dir
from ..sources.text import InputFiles, NoInputError, first_row_of_each_file, preview, read_lines
from .report import summary_lines
from .sinks import as_text, num_output_partitions, write_result

log = logging.getLogger("stationlens")

# The six result directories of the climate job.
OUTPUTS = ("monthly_avg_temp", "yearly_avg_temp", "seasonal_prcp", "highest_max_temp",
           "extreme_events", "summary")
# The counts of the job's report, beside them (Parquet).
JOB_REPORT = "job_report"


def _delete(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table of this job (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def climate_results(c: DataFrame) -> dict[str, DataFrame]:
    """The six results, all rolled up from the station-month cube."""
    return {
        "monthly_avg_temp": cube.monthly_avg_temp(c),
        "yearly_avg_temp": cube.yearly_avg_temp(c),
        "seasonal_prcp": cube.seasonal_avg_prcp(c),
        "highest_max_temp": cube.highest_max_temp(c),
        "extreme_events": cube.extreme_events(c),
        "summary": climate.climate_summary_from_cube(c),
    }


def climate_from_observations(spark: SparkSession, obs: DataFrame, output_path: str,
                              fmt: str = "text") -> dict:
    """The six results from already typed observations (e.g. landed Parquet)."""
    t0 = time.time()
    cube_path = f"{checkpoint_dir(spark, output_path)}/station_month_cube-{uuid.uuid4().hex}"
    try:
        cube.station_month_cube(obs).write.mode("overwrite").parquet(cube_path)
        c = spark.read.parquet(cube_path)
        kept = c.agg(F.sum("n_obs")).first()[0] or 0
        if not kept:
            return {"error": "no valid records after cleaning"}
        _write_climate(spark, c, output_path, fmt, kept)
    finally:
        _delete(spark, cube_path)
    return {"output": output_path, "kept_rows": kept, "total_seconds": time.time() - t0}


def _write_climate(spark: SparkSession, c: DataFrame, output_path: str, fmt: str, kept: int) -> None:
    results = climate_results(c)
    parts = num_output_partitions(spark, kept)
    for name in OUTPUTS:
        df = results[name]
        n = 1 if name in ("highest_max_temp", "summary") else parts
        if fmt == "text":
            df = summary_lines(df) if name == "summary" else as_text(
                df, tuple(f for f in ("avg_temp", "avg_prcp", "max_temp") if f in df.columns))
        write_result(df, f"{output_path.rstrip('/')}/{name}", n, fmt)


def run_climate_job(spark: SparkSession, input_path: str, output_path: str, fmt: str = "text",
                    lines: DataFrame | None = None) -> dict:
    """Raw GSOD lines -> six results under ``output_path``.

    ``fmt="text"`` writes the reference's comma-joined lines; ``"parquet"``
    typed tables.  Returns the job report (K5).  Missing input, no lines and no
    valid record write nothing and report an ``error`` (S2, S3).
    """
    report: dict = {"input": input_path, "output": output_path, "steps": {}}
    t_start = time.time()
    try:
        if lines is None:
            lines = read_lines(spark, input_path)
    except NoInputError as exc:
        report["error"] = f"could not load data from {input_path}: {exc}"
        log.error(report["error"])
        return report

    # The first three lines, cut to 200 characters (reads one split only).
    report["preview"] = [r.line for r in preview(lines).collect()]

    cube_path = f"{checkpoint_dir(spark, output_path)}/station_month_cube-{uuid.uuid4().hex}"
    try:
        return _climate_by_cube(spark, report, lines, cube_path, fmt, t_start)
    finally:
        _delete(spark, cube_path)


def _climate_by_cube(spark: SparkSession, report: dict, lines: DataFrame, cube_path: str, fmt: str,
                     t_start: float) -> dict:
    """The part of J1 that needs its intermediate table.

    One pass over the lines: the table holds the cube and the counts of lines by outcome, so
    the report's figures are read from it and are exact also where tasks were run again.
    """
    input_path, output_path = report["input"], report["output"]
    t0 = time.time()
    cube.line_cube(lines).write.mode("overwrite").parquet(cube_path)
    report["steps"]["scan_and_cube"] = time.time() - t0
    table = spark.read.parquet(cube_path)
    counts = cube.job_counts(table)
    report.update(counts.first().asDict())
    if report["lines"] == 0:
        report["error"] = f"no data loaded from {input_path}"
    elif report["valid_rows"] == 0:
        report["error"] = "no valid records after cleaning"
    if "error" in report:
        log.error(report["error"])
        return report

    t0 = time.time()
    n_kept = report["kept_rows"]
    _write_climate(spark, cube.of_kept(table), output_path, fmt, n_kept)
    write_result(counts, f"{output_path.rstrip('/')}/{JOB_REPORT}", 1, "parquet")
    report["steps"]["write_results"] = time.time() - t0
    total = time.time() - t_start
    report["total_seconds"] = total
    report["records_per_second"] = n_kept / total if total > 0 else 0.0
    return report


def land_observations(spark: SparkSession, input_path: str, output_path: str) -> dict:
    """Parse raw lines once and store the observations as Parquet partitioned by year.

    Later runs read typed columns instead of text: vectorised scans, column
    pruning, and partition pruning on ``year``.  ``events`` is not stored (it
    is a function of ``frshtt``).

    Landing only appends: ``data`` gets the rows with the input file and the landing they
    come from, then ``files`` gets one row for each input file.  A file that is landed again
    thereby replaces its own earlier rows, and no others, in
    :func:`read_observations`; a landing that breaks off leaves rows that nothing reads.
    """
    t0 = time.time()
    try:
        lines = read_lines(spark, input_path)
    except NoInputError as exc:
        return {"error": f"could not load data from {input_path}: {exc}"}
    out, landing = output_path.rstrip("/"), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    obs = parse.observations(lines, keep=("file_path",)).drop("events").withColumn("landing", F.lit(landing))
    # Rows of a year together, small years joined and large ones split by AQE
    # (spark.sql.adaptive.advisoryPartitionSizeInBytes), however many rows a year has.
    (obs.hint("rebalance", "year").write.mode("append").partitionBy("landing", "year")
     .parquet(f"{out}/data"))
    lines.select("file_path").distinct().withColumn("landing", F.lit(landing)).write.mode("append").parquet(f"{out}/files")
    return {"output": output_path, "landing": landing, "total_seconds": time.time() - t0}


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Observations landed by :func:`land_observations` (schema of ``parse.observations``):
    of every input file the rows of its last complete landing."""
    from ..functions.events import decode_events
    root = path.rstrip("/")
    last = spark.read.parquet(f"{root}/files").groupBy("file_path").agg(F.max("landing").alias("landing"))
    obs = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data")
    obs = obs.withColumn("landing", F.col("landing").cast("string")).join(last, ["file_path", "landing"], "left_semi")
    columns = ["station", "date", "obs_date", "year", "month", "season", *parse.MEASURE_COLUMNS, "frshtt"]
    return obs.select(*columns).withColumn("events", decode_events(F.col("frshtt")))


def run_station_job(spark: SparkSession, input_path: str, output_path: str) -> dict:
    """Station dimension and map markers (JSON lines) from the first row of each file.

    Small files are scanned, of large ones only the heads are read: the per-file first rows
    (one row per file) are written to the checkpoint folder, and the dimension, the report, the
    markers and the map centre all read that small table.
    """
    t0 = time.time()
    try:
        files = InputFiles(spark, input_path)
        first, total_files = first_row_of_each_file(files), files.count
    except NoInputError as exc:
        return {"error": f"no CSV files found at {input_path}: {exc}"}
    rows_path = f"{checkpoint_dir(spark, output_path)}/station_rows-{uuid.uuid4().hex}"
    try:
        stations.rows_from_first(first).write.mode("overwrite").parquet(rows_path)
        rows = spark.read.parquet(rows_path)
        rep = stations.report_from_rows(rows, total_files).first().asDict()
        if rep["stations"] == 0:
            rep["error"] = "no valid station data found in input files"
            return rep
        out = output_path.rstrip("/")
        stations.dimension_from_rows(rows).write.mode("overwrite").parquet(f"{out}/stations")
    finally:
        _delete(spark, rows_path)
    dim = spark.read.parquet(f"{out}/stations")
    stations.station_markers(dim).write.mode("overwrite").json(f"{out}/markers")
    centre = stations.station_centre(dim).first()
    rep.update(centre_latitude=centre[0], centre_longitude=centre[1], total_seconds=time.time() - t0)
    return rep


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m stationlens.plans.jobs climate|stations --input X --output Y``."""
    ap = argparse.ArgumentParser(description="GSOD climate analysis on Spark")
    ap.add_argument("job", choices=("climate", "stations", "land", "climate-from-landed", "stream-cube"))
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", default="text", choices=("text", "parquet"))
    ap.add_argument("--trigger-seconds", type=int, default=None,
                    help="stream-cube: run continuously with this trigger (default: process what is there, stop)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"stationlens-{args.job}").getOrCreate()
    if args.job == "climate":
        print(run_climate_job(spark, args.input, args.output, args.format))
    elif args.job == "stream-cube":
        from ..streaming.climate_stream import start_cube_stream
        q = start_cube_stream(spark, args.input, args.output, trigger_seconds=args.trigger_seconds,
                              available_now=args.trigger_seconds is None)
        q.awaitTermination()
    elif args.job == "land":
        print(land_observations(spark, args.input, args.output))
    elif args.job == "climate-from-landed":
        print(climate_from_observations(spark, read_observations(spark, args.input), args.output, args.format))
    else:
        print(run_station_job(spark, args.input, args.output))


if __name__ == "__main__":
    main()
