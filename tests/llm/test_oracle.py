"""Queries of this subpackage that SQL can express, against DuckDB (sf0.001, exact values)."""

import duckdb
import pytest

from stationlens.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_oracles_are_of_registered_queries():
    assert set(oracle.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(oracle.ORACLE_SQL[name])
    columns = sorted(df.columns)
    names = [d[0] for d in res.description]
    assert columns == sorted(names)
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in res.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in df.collect()) == want
