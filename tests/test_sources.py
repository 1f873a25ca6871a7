"""Text sources: preview (S5), header drop (S6), directory vs glob loading."""

from __future__ import annotations

from stationlens.operators.stations import extraction_report
from stationlens.sources import tables, text
from stationlens.sources.text import InputFiles, count_input_files, drop_header, first_row_of_each_file, preview, read_lines

from gsod_fixture import HEADER_COMPACT, HEADER_PADDED, gsod_line, write_files

ROW = gsod_line("01001099999", "2025-01-01", "17.4", "24.4", "9.7", "0.05", "20.9", "39.4", "001000")


def test_preview_first_lines_cut(spark, tmp_path):
    long_line = "x" * 500
    d = write_files(str(tmp_path), {"a.csv": [long_line, ROW, ROW, ROW]})
    got = [r.line for r in preview(read_lines(spark, d)).collect()]
    assert got == [long_line[:200], ROW[:200], ROW[:200]]


def test_drop_header_both_spellings(spark, tmp_path):
    d = write_files(str(tmp_path), {"a.csv": [HEADER_PADDED, ROW], "b.csv": [HEADER_COMPACT, ROW]})
    kept = [r.value for r in drop_header(read_lines(spark, d)).collect()]
    assert kept == [ROW, ROW]


def test_directory_reads_only_csv_files_glob_reads_matches(spark, tmp_path):
    d = write_files(str(tmp_path), {"a.csv": [HEADER_PADDED, ROW], "notes.txt": ["ignored"]})
    assert read_lines(spark, d).count() == 2
    assert count_input_files(spark, d) == 1
    assert read_lines(spark, f"{d}/*.txt").count() == 1
    assert read_lines(spark, f"{d}/a.csv").count() == 2


def odd_files(tmp_path):
    d = write_files(str(tmp_path), {"a.csv": [HEADER_PADDED, ROW], "b.csv": [HEADER_PADDED], "c.csv": [],
                                    "d e%20.csv": ["x" * 40_000, "y" * 50_000, ROW], "f.csv": ["é", "ü", ROW]})
    (tmp_path / "g.csv").write_bytes(b"one\r\ntwo\r\nthree")
    (tmp_path / "h.csv").write_bytes(b"one\rtwo")
    return d, sorted([ROW, "y" * 50_000, "ü", "two", "two"])


def is_python(df):
    return "MapInArrow" in df._jdf.queryExecution().toString()


def test_first_row_by_heads_equals_the_scan(spark, tmp_path, monkeypatch):
    d, want = odd_files(tmp_path)
    scan = first_row_of_each_file(InputFiles(spark, d))
    assert not is_python(scan) and sorted(r.value for r in scan.collect()) == want
    monkeypatch.setattr(text, "SCANNED_BYTES", 1000)
    heads = first_row_of_each_file(InputFiles(spark, d))
    assert is_python(heads) and sorted(r.value for r in heads.collect()) == want


def test_heads_that_cannot_be_read_are_scanned(spark, tmp_path, monkeypatch):
    """As with a scheme or credentials that Arrow doesn't have in the tasks."""
    def refused(path):
        raise OSError("no credentials")

    d, want = odd_files(tmp_path)
    monkeypatch.setattr(text, "SCANNED_BYTES", 1000)
    monkeypatch.setattr(text, "_second_line", refused)
    got = first_row_of_each_file(InputFiles(spark, d))
    assert not is_python(got) and sorted(r.value for r in got.collect()) == want


def test_input_files_are_listed_once(spark, tmp_path):
    d, _ = odd_files(tmp_path)
    files = InputFiles(spark, d)
    assert files.count == 7
    assert files.bytes_each() == sum(f.stat().st_size for f in tmp_path.iterdir() if f.suffix == ".csv") / 7


def test_report_reads_the_lines_once(spark, lines_of):
    lines = lines_of({"a.csv": [HEADER_COMPACT, ROW], "b.csv": [HEADER_COMPACT], "c.csv": [HEADER_COMPACT, "x,y"]})
    assert extraction_report(lines).first().asDict() == {"files": 3, "stations": 1, "failed_files": 2}
    plan = extraction_report(spark.read.text(str(tmp_dir(spark, lines))).selectExpr(
        "value", "'f' as file_path", "0L as line_pos"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def tmp_dir(spark, lines):
    import tempfile
    d = tempfile.mkdtemp()
    lines.select("value").write.mode("overwrite").text(d)
    return d


def test_a_large_station_is_rendered_as_many_files(spark, tmp_path, monkeypatch):
    import duckdb
    monkeypatch.setattr(tables, "FILE_LINES", 500)
    duckdb.sql("COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey) "
               f"FROM '/root/testdata/sf0.001/lineitem.parquet') TO '{tmp_path}/lineitem.parquet'")
    for name in ("supplier", "nation"):
        (tmp_path / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    out = str(tmp_path / "out")
    glob = tables.render_files(spark, str(tmp_path), out)
    lines = read_lines(spark, glob).selectExpr(
        "value", "regexp_extract(file_path, 'name=([^/]*)', 1) as name", "cast(regexp_extract(file_path, 'part=([0-9]+)', 1) as int) as part")
    sizes = {(r.name, r.part): r["count"] for r in lines.groupBy("name", "part").count().collect()}
    hot = [n for (name, _), n in sizes.items() if name.endswith("01") and n > 100]
    assert len(hot) > 3 and max(sizes.values()) < 800
    want = tables.gsod_lines(spark, str(tmp_path)).select("value")
    assert sorted(r.value for r in want.collect()) == sorted(r.value for r in lines.select("value").collect())
    # The first file of each station begins with the header and the first reading.
    first = [r.value for r in first_row_of_each_file(InputFiles(spark, glob.replace("part=*/", "part=0/"))).collect()]
    whole = tables.gsod_lines(spark, str(tmp_path)).where("line_pos >= 0").groupBy("file_path").agg({"line_pos": "min"})
    want = tables.gsod_lines(spark, str(tmp_path)).join(whole.toDF("file_path", "line_pos"), ["file_path", "line_pos"])
    assert len(first) == whole.count() and set(first) <= {r.value for r in want.collect()}  # positions may tie
