"""Training, scoring, saving and the feature table."""

import pytest
from pyspark.sql import functions as F

from gearlog.operators import labels, modeling, smoothing
from gearlog.params import FEATURE_SENSORS, Params
from gearlog.plans.feature_table import build_features, feature_names
from gearlog.sources.shared import shared_path
from gearlog.sources.sinks import write_features
from gearlog.sources.tables import standardise
from tests.fixtures import hours, noisy, tables

pytestmark = pytest.mark.slow


@pytest.fixture(scope="module")
def labelled(spark):
    df = standardise(tables(spark, telemetry=noisy(4, 150)).telemetry)
    label = (F.col("vibration") > 45).cast("int")
    path = shared_path(spark, "labelled")
    df.withColumn("failure_label", label).write.parquet(path)
    return modeling.three_way_split(spark.read.parquet(path))


def test_split_is_in_time_order(labelled):
    ends = {
        r["split"]: (r["a"], r["b"])
        for r in labelled.groupBy("split").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).collect()
    }
    assert ends["train"][1] < ends["validation"][0] <= ends["validation"][1] < ends["test"][0]


@pytest.mark.parametrize("train", [modeling.train_gbt, modeling.train_forest])
def test_models_learn_and_reload(spark, labelled, train):
    names = list(FEATURE_SENSORS)
    model = train(labelled, names, trees=5, depth=3)
    scored = modeling.predict(model, labelled.filter("split = 'test'"))
    wrong = scored.filter("prediction != failure_label").count()
    assert wrong <= 0.05 * scored.count()
    assert scored.filter("probability < 0 or probability > 1").count() == 0
    importance = modeling.feature_importance(spark, model, names)
    assert importance.first()["feature"] == "vibration"
    path = shared_path(spark, "model")
    modeling.save_model(model, 0.42, importance, path)
    again, threshold, kept = modeling.load_model(spark, path)
    assert threshold == 0.42 and kept.count() == 4
    assert modeling.predict(again, labelled).exceptAll(modeling.predict(model, labelled)).count() == 0


def test_feature_table(spark):
    t = tables(
        spark,
        telemetry=noisy(3, 130),
        maint=[(hours(3), m, "comp1") for m in (1, 2, 3)],
        failures=[(hours(120), 1, "comp2")],
        machines=[(m, "model1", m) for m in (1, 2, 3)],
    )
    wide = build_features(t, Params(), drop_null=False)
    path = shared_path(spark, "wide")
    write_features(wide, path)
    back = spark.read.parquet(path)
    assert back.count() == t.telemetry.count()
    assert len(feature_names(wide)) >= 364
    parts = smoothing.ewma(standardise(t.telemetry)).select(
        "machine_id", "timestamp", F.col("pressure_ewma_alpha01").alias("p")
    )
    same = back.join(parts, ["machine_id", "timestamp"])
    assert same.filter(F.abs(F.col("pressure_ewma_alpha01") - F.col("p")) > 1e-9).count() == 0
    # whole rows exist once the 168-row windows are half full
    assert 0 < back.drop("date").na.drop().count() < back.count()


def test_training_reads_no_name_lists_and_looks_cuts_up_once(spark):
    t = tables(
        spark,
        telemetry=noisy(3, 40),
        errors=[(hours(5), 1, "error1"), (hours(5), 1, "error2")],
        maint=[(hours(3), m, "comp1") for m in (1, 2, 3)],
        failures=[(hours(30), 1, "comp2")],
        machines=[(m, "model1", m) for m in (1, 2, 3)],
    )
    whole = labels.master_table(t, Params())
    lists = ["error_types_1h", "maint_components_replaced", "failure_components"]
    plain = labels.master_table(t, Params(), names=False)
    assert plain.columns == [c for c in whole.columns if c not in lists]
    assert plain.exceptAll(whole.drop(*lists)).count() == 0 == whole.drop(*lists).exceptAll(plain).count()
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan
    split = modeling.three_way_split(plain)
    assert "scalar-subquery" not in split._jdf.queryExecution().optimizedPlan().toString()
