"""The streaming cube equals the batch cube, also when files arrive in two waves."""

from __future__ import annotations

from stationlens.operators import cube, parse
from stationlens.sources.text import read_lines
from stationlens.streaming.climate_stream import read_cube, start_cube_stream

from gsod_fixture import HEADER_PADDED, gsod_line, write_files


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_cube_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    a = [HEADER_PADDED] + [gsod_line("01", f"2025-0{m}-0{d}", f"{m}.{d}", "20.0", "0.0", "0.10", "5.0",
                                     "9.0", "110000") for m in (1, 2) for d in (1, 2, 3)]
    b = [HEADER_PADDED] + [gsod_line("02", f"2025-12-0{d}", f"-{d}.5", "20.0", "0.0", "99.99", "5.0",
                                     "9.0", "000010") for d in (1, 2)]
    write_files(src, {"a.csv": a})
    out = str(tmp_path / "cube")
    ckpt = str(tmp_path / "ckpt")
    q = start_cube_stream(spark, src, out, checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    write_files(src, {"b.csv": b})
    q = start_cube_stream(spark, src, out, checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    got = read_cube(spark, out)
    want = cube.station_month_cube(parse.observations(read_lines(spark, src)))
    assert _rows(got.select(*want.columns)) == _rows(want)
