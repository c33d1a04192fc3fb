"""Every star-schema query against its DuckDB oracle on sf0.001."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from callstar.plans import catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = {n: q for n, q in E.queries().items() if n in catalog.REGISTRY}
SQL = {n: q for n, q in E.oracle_sql().items() if n in catalog.REGISTRY}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["wait_bucket", "n_tickets", "n_rated", "avg_csat"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(SQL[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(res.columns, orows)
