"""Golden replay: a reconstructed input must reproduce the original job's results.

The input is rebuilt from the published results (row counts per month are
pinned by the one-decimal TEMP means; PRCP shares by the seasonal means), in
mixed 28/29-field layouts, with a header-only file and an empty file.
"""

from __future__ import annotations

import os
from decimal import Decimal

import pytest

from stationlens.plans.jobs import run_climate_job

from gsod_fixture import HEADER_COMPACT, HEADER_PADDED, gsod_line, write_files

# The original job's published results for this input.
EXPECTED_MONTHLY = """\
01001099999,2025,1,24.95862068965517
01001499999,2025,4,54.45
01001499999,2025,5,50.142857142857146
01001499999,2025,7,64.85
01002099999,2025,7,37.2
01001099999,2025,2,30.011111111111113
01001099999,2025,3,24.958064516129035
01001099999,2025,5,35.36
01001499999,2025,2,43.22222222222222
01001499999,2025,8,58.190909090909095
01002099999,2025,3,13.362499999999999
01002099999,2025,4,4.025
01002099999,2025,5,25.336363636363636
01002099999,2025,6,33.2
01002099999,2025,8,40.36666666666667
01001099999,2025,4,28.686206896551727
01001099999,2025,6,39.306666666666665
01001099999,2025,7,45.527272727272724
01001099999,2025,8,46.31818181818181
01001499999,2025,1,38.771428571428565
01001499999,2025,3,45.388888888888886
01001499999,2025,6,57.34444444444445
01002099999,2025,1,14.183333333333332
01002099999,2025,2,16.728571428571428"""
EXPECTED_YEARLY = """\
01001499999,2025,50.2625
01001099999,2025,33.63772727272727
01002099999,2025,19.271428571428572"""
EXPECTED_SEASONAL = """\
01001099999,2025,Winter,5.413928571428569
01001099999,2025,Spring,1.136222222222223
01001499999,2025,Winter,87.49125
01001499999,2025,Spring,66.66
01002099999,2025,Spring,0.0
01002099999,2025,Summer,0.0
01001099999,2025,Summer,0.05148648648648648
01001499999,2025,Summer,81.81
01002099999,2025,Winter,0.0"""
EXPECTED_TOP = """\
01001499999,80.6
01001099999,57.2
01002099999,47.8"""
EXPECTED_EVENTS = """\
01001499999,Thunder,1
01001099999,Snow,73
01001099999,Rain,97
01001099999,Fog,49
01001499999,Snow,4
01001499999,Fog,3
01001499999,Rain,42"""
EXPECTED_SUMMARY = """\
Hottest year: 2025 with avg temp 34.39
Wettest station: 01001499999 with total prcp 4399.56
Highest gust: 01001099999 with 58.50"""

# Reconstructed input: rows per month (Jan..Aug 2025) and PRCP per season.
ROWS = {"01001099999": [29, 27, 31, 29, 30, 30, 22, 22],
        "01001499999": [7, 9, 9, 2, 7, 9, 2, 11],
        "01002099999": [6, 7, 8, 8, 11, 5, 1, 3]}
PRCP_TOTAL = {"01001099999": {"Winter": "303.18", "Spring": "102.26", "Summer": "3.81"}}
PRCP_MISSING_ROWS = {"01001499999": {"Winter": 14, "Spring": 12, "Summer": 18}}
MAX_TEMP = {"01001099999": "57.2", "01001499999": "80.6", "01002099999": "47.8"}
EVENTS = {"01001099999": {"Fog": 49, "Rain": 97, "Snow": 73},
          "01001499999": {"Fog": 3, "Rain": 42, "Snow": 4, "Thunder": 1}}
SEASON = {1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring", 6: "Summer", 7: "Summer", 8: "Summer"}


def _split(total: Decimal, n: int, quantum: Decimal) -> list[Decimal]:
    """n values with ``quantum`` precision summing exactly to ``total``."""
    base = (total / n).quantize(quantum)
    vals = [base] * (n - 1)
    return vals + [total - sum(vals)]


def build_input(directory: str) -> None:
    monthly = {}
    for line in EXPECTED_MONTHLY.splitlines():
        st, _, m, mean = line.split(",")
        monthly[(st, int(m))] = Decimal(mean)
    files = {}
    for layout, (st, counts) in enumerate(ROWS.items()):
        rows = []
        for m, n in enumerate(counts, start=1):
            total = (monthly[(st, m)] * n).quantize(Decimal("0.1"))
            for d, t in enumerate(_split(total, n, Decimal("0.1")), start=1):
                rows.append([st, f"2025-{m:02d}-{d:02d}", str(t), m])
        # PRCP per season
        by_season: dict[str, list[list]] = {}
        for r in rows:
            by_season.setdefault(SEASON[r[3]], []).append(r)
        for season, rs in by_season.items():
            if st in PRCP_TOTAL:
                vals = _split(Decimal(PRCP_TOTAL[st][season]), len(rs), Decimal("0.01"))
            else:
                k = PRCP_MISSING_ROWS.get(st, {}).get(season, 0)
                vals = [Decimal("99.99")] * k + [Decimal("0.00")] * (len(rs) - k)
            for r, v in zip(rs, vals):
                r.append(str(v))
        ev = EVENTS.get(st, {})
        out = [HEADER_PADDED if layout != 1 else HEADER_COMPACT]
        for i, (s, date, temp, m, prcp) in enumerate(rows):
            flags = "".join("1" if i < ev.get(e, 0) else "0"
                            for e in ("Fog", "Rain", "Snow", "Hail", "Thunder", "Tornado"))
            max_t = MAX_TEMP[st] if i == 0 else "0.0"
            gust = "58.50" if (st == "01001099999" and i == 5) else "10.0"
            out.append(gsod_line(s, date, temp, max_t, "-1.0", prcp, "5.0", gust, flags,
                                 name="JAN MAYEN NOR NAVY, NO", padded=(layout != 1)))
            if i == 3:  # a row with a missing reading is dropped entirely
                out.append(gsod_line(s, date, "9999.9", max_t, "-1.0", prcp, "5.0", gust, flags))
        files[f"{st}.csv"] = out
    files["header_only.csv"] = [HEADER_PADDED]
    files["empty.csv"] = []
    write_files(directory, files)


def _read(path: str) -> list[str]:
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name)) as f:
                out.extend(line.rstrip("\n") for line in f if line.strip())
    return out


def _close(got: list[str], expected: str) -> None:
    exp = sorted(expected.splitlines())
    got = sorted(got)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        gs, es = g.split(","), e.split(",")
        assert gs[:-1] == es[:-1]
        assert float(gs[-1]) == pytest.approx(float(es[-1]), rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("fmt", ["text"])
def test_golden_replay(spark, tmp_path, fmt):
    src = str(tmp_path / "in")
    build_input(src)
    out = str(tmp_path / "out")
    rep = run_climate_job(spark, src, out, fmt=fmt)
    assert "error" not in rep, rep
    _close(_read(f"{out}/monthly_avg_temp"), EXPECTED_MONTHLY)
    _close(_read(f"{out}/yearly_avg_temp"), EXPECTED_YEARLY)
    _close(_read(f"{out}/seasonal_prcp"), EXPECTED_SEASONAL)
    assert _read(f"{out}/highest_max_temp") == EXPECTED_TOP.splitlines()
    assert sorted(_read(f"{out}/extreme_events")) == sorted(EXPECTED_EVENTS.splitlines())
    assert _read(f"{out}/summary") == EXPECTED_SUMMARY.splitlines()
    assert rep["stations"] == 3


def test_no_input_writes_nothing(spark, tmp_path):
    rep = run_climate_job(spark, str(tmp_path / "missing"), str(tmp_path / "out"))
    assert "error" in rep
    assert not os.path.exists(tmp_path / "out")


def test_no_valid_record_writes_nothing(spark, tmp_path):
    src = write_files(str(tmp_path / "in"), {"a.csv": [HEADER_PADDED, gsod_line(
        "01", "2025-01-01", "9999.9", "1", "1", "1", "1", "1", "000000")]})
    rep = run_climate_job(spark, src, str(tmp_path / "out"))
    assert rep.get("error") == "no valid records after cleaning"
    assert not os.path.exists(tmp_path / "out")


def test_odd_lines_are_dropped_not_fatal(spark, tmp_path):
    good = gsod_line("01", "2025-12-31", "10.0", "20.0", "0.0", "0.10", "5.0", "9.0", "100000")
    src = write_files(str(tmp_path / "in"), {"a.csv": [HEADER_PADDED, "", "no commas here", '"a","b"', good,
                                                       good + ', "extra"', good.replace("2025-12-31", "2025-02-30")]})
    from stationlens.operators.parse import ingest_profile
    from stationlens.sources.text import read_lines
    p = ingest_profile(read_lines(spark, src)).first()
    assert (p.lines, p.headers, p.valid_rows, p.kept_rows, p.stations) == (7, 1, 2, 1, 1)
    rep = run_climate_job(spark, src, str(tmp_path / "out"))
    assert (rep["lines"], rep["valid_rows"], rep["kept_rows"]) == (7, 2, 1)
    assert _read(str(tmp_path / "out" / "seasonal_prcp")) == ["01,2025,Winter,0.1"]
    written = spark.read.parquet(str(tmp_path / "out" / "job_report")).first()
    assert (written.lines, written.valid_rows, written.kept_rows, written.stations) == (7, 2, 1, 1)


def test_report_is_exact_when_a_task_is_run_again(spark, tmp_path, monkeypatch):
    """Each task of the scan fails once after its rows were read: counts are of the table, not of runs."""
    from pyspark import TaskContext

    good = [gsod_line("01", f"2025-01-{d:02d}", "10.0", "20.0", "0.0", "0.10", "5.0", "9.0", "100000") for d in range(1, 29)]
    src = write_files(str(tmp_path / "in"), {"a.csv": [HEADER_PADDED, *good, "odd"]})
    tries = spark.sparkContext.accumulator(0)

    def again(batches):
        yield from batches
        if not os.path.exists(f"{tmp_path}/failed"):
            open(f"{tmp_path}/failed", "w").close()
            tries.add(1)
            raise OSError(f"lost, attempt {TaskContext.get().attemptNumber()}")

    from stationlens.operators import cube
    from stationlens.sources.text import read_lines
    lines = read_lines(spark, src).select("value")
    if spark.sparkContext.master.startswith("local["):  # local mode doesn't run a failed task again: run the job again
        flaky = cube.line_cube(lines.mapInArrow(again, "value string"))
        try:
            flaky.write.mode("overwrite").parquet(str(tmp_path / "cube"))
        except Exception:
            flaky.write.mode("overwrite").parquet(str(tmp_path / "cube"))
    counts = cube.job_counts(spark.read.parquet(str(tmp_path / "cube"))).first()
    assert (counts.lines, counts.valid_rows, counts.kept_rows, counts.stations) == (30, 28, 28, 1)


def test_a_year_is_landed_by_several_tasks(spark, tmp_path):
    from stationlens.plans.jobs import land_observations, read_observations

    rows = [gsod_line(f"{i:05d}", "2025-01-01", "1.5", "20.0", "0.0", "0.10", "5.0", "9.0", "000000") for i in range(6000)]
    src = write_files(str(tmp_path / "in"), {f"{k}.csv": rows[k::6] for k in range(6)})
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB", "spark.sql.files.maxPartitionBytes": "200KB"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        land_observations(spark, src, str(tmp_path / "landed"))
    finally:
        for k in settings:
            spark.conf.unset(k)
    files = [f for _, _, names in os.walk(tmp_path / "landed" / "data") for f in names if f.startswith("part-") and f.endswith(".parquet")]
    assert len(files) > 3
    assert read_observations(spark, str(tmp_path / "landed")).count() == 6000


def test_landed_parquet_gives_the_same_results(spark, tmp_path):
    from stationlens.plans.jobs import climate_from_observations, land_observations, read_observations
    src = str(tmp_path / "in")
    build_input(src)
    land_observations(spark, src, str(tmp_path / "landed"))
    rep = climate_from_observations(spark, read_observations(spark, str(tmp_path / "landed")), str(tmp_path / "out"))
    assert rep["kept_rows"] > 0
    out = str(tmp_path / "out")
    _close(_read(f"{out}/monthly_avg_temp"), EXPECTED_MONTHLY)
    _close(_read(f"{out}/seasonal_prcp"), EXPECTED_SEASONAL)
    assert sorted(_read(f"{out}/extreme_events")) == sorted(EXPECTED_EVENTS.splitlines())
    assert _read(f"{out}/summary") == EXPECTED_SUMMARY.splitlines()


def test_landing_adds_days_and_replaces_only_files_landed_again(spark, tmp_path):
    from gsod_fixture import gsod_line, write_files
    from stationlens.plans.jobs import land_observations, read_observations

    def day(d: int, temp: str = "1.125") -> str:
        return gsod_line("01", f"2025-01-{d:02d}", temp, "20.0", "0.0", "0.10", "5.0", "9.0", "000000")

    out = str(tmp_path / "landed")
    land_observations(spark, write_files(str(tmp_path / "a"), {"a.csv": [day(d) for d in range(1, 11)]}), out)
    land_observations(spark, write_files(str(tmp_path / "b"), {"b.csv": [day(11)]}), out)
    assert read_observations(spark, out).count() == 11
    land_observations(spark, write_files(str(tmp_path / "a"), {"a.csv": [day(d, "2.5") for d in range(1, 4)]}), out)
    rows = read_observations(spark, out).collect()
    assert sorted((r.date, r.temp) for r in rows) == [
        ("2025-01-01", 2.5), ("2025-01-02", 2.5), ("2025-01-03", 2.5), ("2025-01-11", 1.125)]


def test_parquet_sink_typed_results(spark, tmp_path):
    src = str(tmp_path / "in")
    build_input(src)
    out = str(tmp_path / "out")
    rep = run_climate_job(spark, src, out, fmt="parquet")
    assert "error" not in rep
    monthly = spark.read.parquet(f"{out}/monthly_avg_temp")
    assert monthly.dtypes == [("station", "string"), ("year", "int"), ("month", "int"), ("avg_temp", "double")]
    got = [f"{r.station},{r.year},{r.month},{r.avg_temp!r}" for r in monthly.collect()]
    _close(got, EXPECTED_MONTHLY)
    s = spark.read.parquet(f"{out}/summary").first()
    assert (s.hottest_year, s.wettest_station, s.gust_station) == (2025, "01001499999", "01001099999")
    assert round(s.wettest_station_prcp, 2) == 4399.56 and s.highest_gust == 58.5
