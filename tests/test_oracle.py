"""Every registered query equals its DuckDB oracle (sf0.001, exact values)."""

from __future__ import annotations

import importlib.util
import math
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)


from stationlens.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("supplier", "nation", "lineitem", "customer", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else repr(x)
    return sorted("|".join(v(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["station", "year", "month", "avg_temp"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, res.fetchall())
