"""Trailing windows in Arrow batches: the cut of batches doesn't matter."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearlog.functions.spans import numbered
from gearlog.operators import features
from gearlog.params import FEATURE_SENSORS
from tests.fixtures import hours

SCHEMA = T.StructType(
    [T.StructField("machine_id", T.LongType()), T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(s, T.DoubleType()) for s in FEATURE_SENSORS]
)


@pytest.fixture
def odd(spark):
    """Gaps, missing readings, NaN, a constant sensor, equal times, large and tiny machines."""
    rows = []
    for m, n in ((1, 400), (2, 30), (3, 1), (4, 2), (None, 40)):
        for i in range(n):
            at = hours(i * (1 if i % 50 < 40 else 3))
            x = math.sin(i * 1.7 + (m or 9)) * 10 + 50
            rows.append((m, at, x, None if i % 7 == 3 else x * x, 7.25, math.nan if i == 25 else float(i % 5)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(params=[7, 10000])
def batch(spark, request):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(request.param))
    yield request.param
    spark.conf.set(name, before)


def same(got, want):
    keys = ["machine_id", "timestamp"]
    names = sorted(set(want.columns) - set(keys))
    a = {tuple(r[k] for k in keys): r for r in got.collect()}
    b = {tuple(r[k] for k in keys): r for r in want.collect()}
    assert a.keys() == b.keys()
    for k, r in b.items():
        for n in names:
            x, y = a[k][n], r[n]
            if x is None or y is None or x != x or y != y:
                assert repr(x) == repr(y), (k, n)
            else:
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9), (k, n)


def test_statistics_are_those_of_window_functions(odd, batch):
    got = features.rolling_statistics(odd, (6, 24, 168))
    for part in (features.rolling_moments, features.rolling_quantiles):
        same(got, part(odd, (6, 24, 168)))
    real = odd.filter("vibration is null or not isnan(vibration)")  # power sums keep a NaN for longer
    same(features.rolling_statistics(real, (6, 24, 168)), features.rolling_shape(real, (6, 24, 168)))


def test_equal_times_see_each_other(spark, batch):
    rows = [(1, hours(k // 20), float(k), 1.0, 1.0, 1.0) for k in range(60)]
    out = features.rolling_statistics(spark.createDataFrame(rows, SCHEMA), (6,))
    got = {r["timestamp"]: set() for r in out.collect()}
    for r in out.collect():
        got[r["timestamp"]].add((r["voltage_min_6h"], r["voltage_max_6h"]))
    assert got == {hours(k): {(0.0, 20.0 * k + 19)} for k in range(3)}


def test_correlations_are_those_of_window_functions(odd, batch):
    rows = numbered(odd.withColumn("_us", F.unix_micros("timestamp")), ["machine_id"], "_us")
    got = features.spectral_and_corr(rows.drop("_us"))
    same(got, features.rolling_corr(odd).drop(*FEATURE_SENSORS))
    same(got, features.spectral(odd).drop(*FEATURE_SENSORS))
