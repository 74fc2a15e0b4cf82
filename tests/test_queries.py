"""Every registered query runs on the smallest tables and matches its
DuckDB oracle (row count, columns, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from shoptrail.plans import catalog
from tests.conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def _key(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_date", "event_type", "event_count", "unique_customers", "unique_sessions"]


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n in catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert got, "a query without an oracle must at least return rows"
        return
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _key(got) == _key(want)
