"""Every registered query against its DuckDB statement ($SF_DIR, default sf0.001)."""

import os

import pytest

import __spark_entry__ as entry
from gearlog import catalog
from oracle import all_sql
from tests.compare import check, connect

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    assert check(spark, duck, name, QUERIES[name], SQL[name], FOLDER) is None


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "machineID"
    assert df.count() > 0
