"""Registered queries against their SQL in DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from ribolake.registry import load
from ribolake.registry.inputs import BASE_TABLES
from tools.check import canonical

SF = "/root/testdata/sf0.001"
# The queries of the training-data operators have their own tests.
QUICK = [n for n in sorted(load()) if load()[n].sql is not None]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, SF).toPandas()
    want = duck.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
