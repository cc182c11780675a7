"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from strandloom.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
    rel = db.execute(ORACLES[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, D).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
