"""The entry module: names, stable schema, and every query against its DuckDB form on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom import plans

SMALL = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, con, name):
    out = plans.queries()[name](spark, SMALL)
    got = out.collect()
    if name in plans.oracle_sql():
        want = con.sql(plans.oracle_sql()[name])
        cols = sorted(out.columns)
        assert cols == sorted(want.columns)
        order = [want.columns.index(c) for c in cols]
        key = lambda r, at: repr(tuple(plain(r[i]) for i in at))
        assert sorted(key(r, [out.columns.index(c) for c in cols]) for r in got) == sorted(key(r, order) for r in want.fetchall())
