"""The driver's contract over the smallest data, if it is there."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names():
    queries = entry.queries()
    assert set(entry.oracle_sql()) <= set(queries) and "p1_found" in queries


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    got = entry.queries()[name](spark, DATA)
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
