"""Each query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from quillmark import queries as core

DATA = "/root/testdata/sf0.001"
SQL = core.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"create view {name.partition('.')[0]} as select * from '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, db, name):
    df = core.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    want = db.sql(SQL[name])
    assert sorted(want.columns) == columns
    rows = [tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall()]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, rows))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
