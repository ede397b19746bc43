"""Physical plans: pushdown, no pair products, no Python where Spark has the operator."""

import pytest

from gearlog import catalog
from gearlog.operators import health, labels
from gearlog.params import FIXTURE
from gearlog.sources.bindings import bind

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
PYTHON = {"spectral", "build_features"}
EAGER = {n for n in QUERIES if n.startswith("stream_") or n.endswith("_predictions")} | {
    "feature_importance",
    "parquet_roundtrip",
    "csv_roundtrip",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_products_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_as_of_and_columns_reach_the_scan(spark):
    t = bind(spark, FOLDER)
    as_of = str(t.telemetry.agg({"datetime": "max"}).first()[0])
    plan = plan_of(health.spike_detection(t, FIXTURE.__class__(**{**FIXTURE.__dict__, "as_of": as_of})))
    assert "GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,value:double,props:string>" in plan


def test_chained_passes_read_the_source_linearly(spark):
    """Two passes over readings and marks read telemetry once for the rows and
    once per pass for the span totals."""
    t = bind(spark, FOLDER)
    one = plan_of(labels.maintenance_features(t, FIXTURE)).count("FileScan parquet")
    two = plan_of(labels.failure_labels(t, FIXTURE)).count("FileScan parquet")
    assert two <= 2 * one


def test_sources_are_not_scanned_for_unused_columns(spark):
    t = bind(spark, FOLDER)
    plan = plan_of(health.operating_hours(t, FIXTURE))
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint>" in plan


def test_quartiles_are_compiled(spark):
    """No lambda that is interpreted for each row, no method the JVM leaves uncompiled."""
    df = QUERIES["rolling_quantiles"](spark, FOLDER)
    assert "transform(" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_feature_table_numbers_rows_once_and_calls_python_per_batch(spark):
    plan = plan_of(QUERIES["build_features"](spark, FOLDER))
    assert "FlatMapGroupsInArrow" not in plan
    assert plan.count("MapInArrow") == 2
