"""Every registered query against its DuckDB oracle on the smallest test tables."""

import decimal

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tidewater.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == want


def test_full_transform_reads_every_customer(spark, con):
    got = sorted(r.id for r in E.queries()["full_transform_all"](spark, SF_SMALL).select("id").distinct().collect())
    assert got == [k for (k,) in con.sql("SELECT c_custkey FROM customer ORDER BY 1").fetchall()]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["etl_key", "id"]
