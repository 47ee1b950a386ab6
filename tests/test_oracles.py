"""Core queries with SQL against DuckDB on the smallest tables; all others must run."""

import glob
import os

import duckdb
import pytest

import oracle_check
from gavelbase.plans import geo_units_packed, landed, listings, streams

D = "/root/testdata/sf0.001"
QUERIES = {n: f for m in (geo_units_packed, listings, landed, streams) for n, f in m.QUERIES.items()}
SQL = {n: f for m in (geo_units_packed, listings, landed, streams) for n, f in m.ORACLE.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{D}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    cols, got = oracle_check.rows_of(QUERIES[name](spark, D).toArrow())
    if name in SQL:
        assert (cols, got) == oracle_check.rows_of(con.execute(SQL[name]).to_arrow_table())
