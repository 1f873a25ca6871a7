"""Unit tests of the column functions."""

from __future__ import annotations

import csv

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlens.functions.dates import parse_date, season
from stationlens.functions.events import decode_events
from stationlens.functions.text import PY_WHITESPACE, clean_field, number_text, tokenize
from stationlens.functions.values import parse_float
from stationlens.operators.parse import MEASURE_COLUMNS, validity


def one(spark, expr, value, schema="string"):
    return spark.createDataFrame([(value,)], f"x {schema}").select(expr(F.col("x")).alias("r")).first()["r"]


def test_parse_date_valid(spark):
    df = spark.createDataFrame([("2019-02-27",)], "d string").select(parse_date(F.col("d")).alias("d"))
    r = df.select(F.year("d").alias("y"), F.month("d").alias("m"), season(F.month("d")).alias("s")).first()
    assert (r.y, r.m, r.s) == (2019, 2, "Winter")


@pytest.mark.parametrize("text,expected", [
    ("invalid", None), ("2025-1-5", "2025-01-05"), ("2025-01- 5", "2025-01-05"), ("2025-02-30", None),
    ("2025-13-01", None), ("2025-01-01 ", None), ("2025-01-01\u2028", None), ("0000-01-01", None), ("25-01-01", None), ("2025-001-01", None),
])
def test_parse_date_edges(spark, text, expected):
    got = one(spark, lambda c: parse_date(c).cast("string"), text)
    assert got == expected


@pytest.mark.parametrize("month,expected", [(12, "Winter"), (1, "Winter"), (2, "Winter"), (3, "Spring"),
                                            (5, "Spring"), (6, "Summer"), (8, "Summer"), (9, "Autumn"),
                                            (11, "Autumn"), (None, None)])
def test_season(spark, month, expected):
    assert one(spark, season, month, "int") == expected


def test_decode_events(spark):
    assert one(spark, decode_events, "010011") == {"Fog": False, "Rain": True, "Snow": False, "Hail": False,
                                                   "Thunder": True, "Tornado": True}
    assert one(spark, decode_events, "123") == {}
    assert one(spark, decode_events, "1000") == {}
    assert one(spark, decode_events, "0000001") == {}


@pytest.mark.parametrize("text", ["20.5", " 17.4 ", "-3", "1e3", "1E-2", ".5", "5.", "+1.5", "inf", "-Infinity",
                                  "nan", "1_000.5", "", "abc", "1.0d", "1.0f", "0x1p3", "1__0", "_1", "1e", ".",
                                  "--1", "1.2.3", "\t9.0\n", "\xa012.5　"])
def test_parse_float_matches_python(spark, text):
    try:
        expected = float(text.strip())
    except ValueError:
        expected = None
    got = one(spark, parse_float, text)
    if expected is None or got is None:
        assert got == expected
    elif expected != expected:  # NaN
        assert got != got
    else:
        assert got == expected


def _valid(spark, record):
    df = spark.createDataFrame([tuple(float(v) if v is not None else None for v in record)],
                               ", ".join(f"{c} double" for c in MEASURE_COLUMNS))
    return df.select(validity().alias("ok")).first()["ok"]


def test_validity(spark):
    assert _valid(spark, (31.7, 38.2, 27.9, 0.0, 5.0, 10.0)) is True
    assert _valid(spark, (9999.9, 38.2, 27.9, 0.0, 5.0, 10.0)) is False


@pytest.mark.parametrize("record,ok", [
    ((31.7, 38.2, 27.9, 99.99, 5.0, 10.0), True),      # GSOD's PRCP missing code is kept
    ((31.7, 38.2, 27.9, -5.0, 5.0, 10.0), True),       # negative PRCP passes (no abs)
    ((-999.9, 38.2, 27.9, 0.0, 5.0, 10.0), False),
    ((31.7, 38.2, 27.9, 0.0, 5.0, 999.9), False),
    ((999.0, 38.2, 27.9, 0.0, 5.0, 10.0), False),
    ((float("nan"), 38.2, 27.9, 0.0, 5.0, 10.0), False),
    ((float("inf"), 38.2, 27.9, 0.0, 5.0, 10.0), False),
    ((31.7, 38.2, 27.9, float("-inf"), 5.0, 10.0), True),
    ((None, 38.2, 27.9, 0.0, 5.0, 10.0), False),
])
def test_validity_edges(spark, record, ok):
    assert _valid(spark, record) is ok


def test_python_whitespace_set():
    assert len(PY_WHITESPACE) == 29 and all(c.isspace() for c in PY_WHITESPACE)


def _py_fields(line):
    return next(csv.reader([line]), [])


def _py_clean(tok):
    return tok.strip().strip('"')


ALPHABET = st.sampled_from(list('ab ,"\t1.-') + ["\xa0", "　", "\u2028", "\x85"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=25))
def test_tokenize_and_clean_match_csv_reader(spark, lines):
    df = spark.createDataFrame([(ln,) for ln in lines], "v string")
    rows = df.select(tokenize(F.col("v")).alias("t")).select(
        "t", F.transform("t", lambda x: clean_field(x)).alias("c"),
        F.transform("t", lambda x: number_text(x)).alias("n")).collect()
    for ln, row in zip(lines, rows):
        ref = _py_fields(ln)
        if ln == "":
            assert len(row.t) == 1  # one empty token; both layouts reject it
            continue
        assert [_py_clean(f) for f in ref] == row.c, (ln, row.t)
        assert [_py_clean(f).strip() for f in ref] == row.n, (ln, row.t)


def test_padded_header_and_quoted_name(spark):
    line = '"90010000001", "2024-07-09", "12.3", "-98.7", "431.5", "LOW MEADOW, QA", "  17.4"'
    t = one(spark, lambda c: F.transform(tokenize(c), lambda x: clean_field(x)), line)
    assert t == [_py_clean(f) for f in _py_fields(line)]
    assert len(t) == 8


from stationlens.functions.text import csv_value, split_fields  # noqa: E402

FIELD = st.text(alphabet=st.sampled_from(list('ab ,"1.') + ["\x01", "\u2028"]), max_size=6)


@st.composite
def shaped_lines(draw):
    fields = draw(st.lists(FIELD, min_size=1, max_size=6))
    shape = draw(st.sampled_from(["compact", "padded", "free"]))
    if shape == "compact":
        return ",".join(f'"{f}"' for f in fields)
    if shape == "padded":
        return ", ".join(f'"{f}"' for f in fields)
    return ",".join(fields)


@settings(max_examples=80, deadline=None)
@given(st.lists(shaped_lines(), min_size=1, max_size=20))
def test_split_fields_match_csv_reader(spark, lines):
    df = spark.createDataFrame([(ln,) for ln in lines], "v string").select(split_fields(F.col("v")).alias("f"))
    vals = df.select(
        F.when(F.col("f.kind") == 0, F.col("f.v"))
        .when(F.col("f.kind") == 1, F.concat(F.array(csv_value(F.col("f.v")[0])), F.slice("f.v", 2, 1 << 20)))
        .otherwise(F.transform("f.v", lambda x: csv_value(x))).alias("vals")).collect()
    for ln, row in zip(lines, vals):
        ref = _py_fields(ln)
        if ln == "":
            continue  # the reader yields no field; every path yields one empty field (both rejected later)
        assert row.vals == ref, (ln, row.vals)


def test_split_fields_match_csv_reader_on_all_short_lines(spark):
    from itertools import product
    lines = ["".join(t) for n in range(1, 8) for t in product('a,"', repeat=n)]
    df = spark.createDataFrame([(ln,) for ln in lines], "v string").select("v", split_fields(F.col("v")).alias("f"))
    vals = F.when(F.col("f.kind") == 0, F.col("f.v")).when(
        F.col("f.kind") == 1, F.concat(F.array(csv_value(F.col("f.v")[0])), F.slice("f.v", 2, 1 << 20))
    ).otherwise(F.transform("f.v", lambda x: csv_value(x)))
    wrong = [(r.v, r.vals) for r in df.select("v", vals.alias("vals")).collect() if r.vals != _py_fields(r.v)]
    assert not wrong


@pytest.mark.parametrize("x", [0.0, -0.0, 1.0, -12.5, 0.001, 0.00012, 1.5e-5, 9999999.0, 12345678.9, -3.25e9,
                               1e15, 1e16, 2e21, float("inf"), float("-inf"), float("nan")])
def test_py_str_matches_python(spark, x):
    from stationlens.functions.format import py_str
    assert one(spark, py_str, x, "double") == str(x)


def test_sums_keep_every_reading(spark):
    from stationlens.functions.values import exact_sum
    def total(*xs):
        return spark.createDataFrame([(float(x),) for x in xs], "x double").agg(exact_sum(F.col("x"))).first()[0]
    assert total(20.125, 20.125) == 40.25
    assert total(0.004, 0.004) == 0.008
    assert total(-1e20, 5.0) == -1e20 + 5.0
    assert total(1e-9, 2.0) == pytest.approx(2.000000001, abs=1e-15)
    assert total(float("-inf"), 1.0) == float("-inf")
