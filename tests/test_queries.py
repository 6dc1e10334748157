"""Every query with SQL gives the rows DuckDB gives; every other one gives rows."""

import duckdb
import pytest

import __spark_entry__ as contract

ROOT = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    yield con
    con.close()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["date", "portfolio_return", "benchmark_return", "strategy_cum", "benchmark_cum"]
    assert df.limit(1).count() == 1


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows(spark, db, key):
    df = QUERIES[key](spark, ROOT)
    names = sorted(df.columns)
    mine = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
    found = db.execute(ORACLES[key])
    order = [d[0] for d in found.description]
    assert sorted(order) == names
    theirs = sorted(repr(tuple(dict(zip(order, row))[c] for c in names)) for row in found.fetchall())
    assert mine and mine == theirs


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, ROOT).limit(1).count() == 1
