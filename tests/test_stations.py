"""Station dimension from files."""

from __future__ import annotations

import json
import os

import pytest

from stationlens.operators.stations import report_from_rows, station_dimension, station_rows
from stationlens.plans.jobs import run_station_job
from stationlens.sources.text import NoInputError, count_input_files, first_row_per_file, read_lines

from gsod_fixture import HEADER_PADDED, gsod_line, write_files

ROW1 = gsod_line("90010000001", "2024-07-09", "55.1", "61.2", "48.3", "0.11", "7.5", "18.4", "010000",
                 name="LOW MEADOW, QA", lat="12.3456789", lon="-98.7654321", elev="431.5")
ROW2 = gsod_line("90010000002", "2024-07-09", "58.4", "66.0", "51.9", "0.00", "6.1", "14.2", "000000",
                 name="HARBOUR POINT, QA", lat="-7.0615243", lon="33.4455667", elev="2.0")
ROW3 = gsod_line("90010000003", "2024-07-09", "49.9", "57.3", "41.6", "1.27", "11.8", "29.5", "110010",
                 name="UPPER RIDGE, QB", lat="41.2718281", lon="77.1618033", elev="1820.0")


def dim_of(spark, path):
    return {r.station: r for r in station_dimension(read_lines(spark, path)).collect()}


def test_first_row_only(spark, tmp_path):
    d = write_files(str(tmp_path), {"only.csv": [HEADER_PADDED, ROW1, ROW2]})
    dim = dim_of(spark, d)
    assert list(dim) == ["90010000001"]
    s = dim["90010000001"]
    assert s.name == "LOW MEADOW, QA"
    assert s.latitude == pytest.approx(12.3456789, abs=1e-6)
    assert s.longitude == pytest.approx(-98.7654321, abs=1e-6)
    assert s.elevation == pytest.approx(431.5)


def test_compact_layout_name(spark, tmp_path):
    row = ROW1.replace(", ", ",").replace('"LOW MEADOW,QA"', '"LOW MEADOW, QA"')
    d = write_files(str(tmp_path), {"a.csv": [HEADER_PADDED.replace(", ", ","), row]})
    assert dim_of(spark, d)["90010000001"].name == "LOW MEADOW, QA"


def test_header_only_and_empty_files(spark, tmp_path):
    d = write_files(str(tmp_path), {"empty.csv": [HEADER_PADDED], "zero.csv": []})
    assert dim_of(spark, d) == {}
    rep = report_from_rows(station_rows(read_lines(spark, d)), count_input_files(spark, d)).first()
    assert (rep.files, rep.stations, rep.failed_files) == (2, 0, 2)


def test_missing_file(spark, tmp_path):
    with pytest.raises(NoInputError):
        read_lines(spark, str(tmp_path / "nonexistent.csv"))


def test_two_files_and_first_file_wins(spark, tmp_path):
    dup = ROW1.replace("LOW MEADOW, QA", "ELSEWHERE, QC")
    d = write_files(str(tmp_path), {"a.csv": [HEADER_PADDED, ROW1], "b.csv": [HEADER_PADDED, ROW3],
                                    "c.csv": [HEADER_PADDED, dup], "d.csv": [HEADER_PADDED, '"x","y"']})
    dim = dim_of(spark, d)
    assert sorted(dim) == ["90010000001", "90010000003"]
    assert dim["90010000001"].name == "LOW MEADOW, QA"
    rep = report_from_rows(station_rows(read_lines(spark, d)), count_input_files(spark, d)).first()
    assert (rep.files, rep.stations, rep.failed_files) == (4, 2, 1)


def test_first_row_per_file_survives_many_splits(spark, tmp_path):
    rows = [HEADER_PADDED, ROW2] + [ROW1] * 3000
    d = write_files(str(tmp_path), {"big.csv": rows})
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = read_lines(spark, d)
        assert lines.rdd.getNumPartitions() > 1
        first = first_row_per_file(lines).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.value for r in first] == [ROW2]


def test_station_job_writes_markers(spark, tmp_path):
    d = write_files(str(tmp_path / "in"), {"a.csv": [HEADER_PADDED, ROW1], "b.csv": [HEADER_PADDED, ROW3]})
    rep = run_station_job(spark, d, str(tmp_path / "out"))
    assert rep["stations"] == 2 and rep["failed_files"] == 0
    assert rep["centre_latitude"] == pytest.approx((12.3456789 + 41.2718281) / 2)
    files = [f for f in os.listdir(tmp_path / "out" / "markers") if f.startswith("part-")]
    markers = [json.loads(line) for f in files for line in open(tmp_path / "out" / "markers" / f)]
    by_id = {m["station"]: m for m in markers}
    assert by_id["90010000001"]["tooltip"] == "LOW MEADOW, QA (90010000001)"
    assert by_id["90010000001"]["latitude_text"] == f"{12.3456789:.4f}°"
    assert by_id["90010000003"]["elevation_text"] == "1820.0 m"


def test_station_job_no_station(spark, tmp_path):
    d = write_files(str(tmp_path / "in"), {"a.csv": [HEADER_PADDED]})
    rep = run_station_job(spark, d, str(tmp_path / "out"))
    assert "error" in rep
    assert not os.path.exists(tmp_path / "out" / "markers")
