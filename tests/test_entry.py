"""The driver contract: entry smoke run, and every query against its DuckDB
twin on the smallest driver tables (row count, columns, rounded values)."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _key(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["var", "n", "r", "slope"]
    assert df.count() == 5


def test_every_query_has_oracle_or_is_listed(spark):
    qs, oracle = se.queries(), se.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(qs) - set(oracle) == se.NO_ORACLE


@pytest.mark.parametrize("name", sorted(set(se.queries())))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    sql = se.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    exp = res.fetchall()
    idx = [cols.index(c) for c in df.columns]
    assert _key(got) == _key([tuple(r[i] for i in idx) for r in exp])
