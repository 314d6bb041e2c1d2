"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry

DIR = os.environ.get("TEST_SF_DIR", entry.SMOKE_DIR)
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return con


def test_every_query_has_sql():
    assert entry.own_queries().keys() == entry.own_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["instruction"] and df.count() > 0


@pytest.mark.filterwarnings("ignore:.*read as empty")
@pytest.mark.parametrize("name", entry.own_queries())
def test_query_agrees_with_sql(spark, duck, name):
    got = entry.own_queries()[name](spark, DIR)
    want = duck.sql(entry.own_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    got_rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    want_rows = sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    assert got_rows == want_rows and got_rows
