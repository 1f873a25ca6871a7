"""Benchmark: the climate and station jobs on raw GSOD-style CSV files.

Setup (untimed): Spark renders the sf tables as GSOD CSV files -- one file per
station, header first -- in a fresh scratch folder.  Timed, after one warm-up
run each: the full climate job (one scan, cube, six outputs; median of two), the
station job (median of two), and the headline queries over the same files (each
forced through a no-op sink).  Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from stationlens.operators import climate, parse, stations  # noqa: E402
from stationlens.plans.jobs import run_climate_job, run_station_job  # noqa: E402
from stationlens.session import local_session  # noqa: E402
from stationlens.sources.tables import render_files  # noqa: E402
from stationlens.sources.text import InputFiles, first_row_of_each_file, read_lines  # noqa: E402


def timed(fn, runs: int = 1) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t = time.time()
        fn()
        times.append(time.time() - t)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="stationlens-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"})
    src = render_files(spark, sf_dir, f"{scratch}/gsod")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def obs():
        return parse.observations(read_lines(spark, src))

    queries = {}
    report = {}
    n = [0]

    def climate_job():
        n[0] += 1
        report.update(run_climate_job(spark, src, f"{scratch}/out{n[0]}", fmt="text"))

    queries["climate_job"] = timed(climate_job, runs=2)
    queries["station_job"] = timed(lambda: run_station_job(spark, src, f"{scratch}/stations"), runs=2)
    queries["ingest_profile"] = timed(lambda: noop(parse.ingest_profile(read_lines(spark, src))))
    queries["monthly_avg_temp"] = timed(lambda: noop(climate.monthly_avg_temp(obs())))
    queries["yearly_avg_temp"] = timed(lambda: noop(climate.yearly_avg_temp(obs())))
    queries["seasonal_avg_prcp"] = timed(lambda: noop(climate.seasonal_avg_prcp(obs())))
    queries["extreme_events"] = timed(lambda: noop(climate.extreme_events(obs())))
    queries["highest_max_temp"] = timed(lambda: noop(climate.highest_max_temp(obs())))
    queries["climate_summary"] = timed(lambda: noop(climate.climate_summary(obs())))
    queries["station_dimension"] = timed(lambda: noop(stations.dimension_from_rows(
        stations.rows_from_first(first_row_of_each_file(InputFiles(spark, src))))))

    kept = report.get("kept_rows", 0)
    out = {
        "metric": "climate_job_seconds",
        "value": round(queries["climate_job"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "sf": sf,
        "cpus": cpus,
        "input_lines": report.get("lines"),
        "kept_records": kept,
        "records_per_second": round(kept / queries["climate_job"], 1) if queries["climate_job"] else None,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
