"""Registered corpus queries: their statements, their plans, and the entry without them."""

import pytest

import __spark_entry__ as entry
from gearlog.llm import registry
from tests.compare import check, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert check(spark, connect(FOLDER), name, QUERIES[name], SQL[name], FOLDER) is None


def test_one_query_for_each_operator():
    assert set(QUERIES) <= set(entry.queries())
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", ["op7_line_chunks", "op8_license_scan"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"))
