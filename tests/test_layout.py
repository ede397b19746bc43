"""Steps that stay inside blocks dealt out once give what they give on their own."""

import pytest
from pyspark.sql import functions as F

from gearlog.functions.spans import HOUR_US
from gearlog.operators import features
from gearlog.operators.smoothing import block_rows, ewma
from gearlog.params import FEATURE_SENSORS, Params
from gearlog.plans.feature_table import build_features
from gearlog.sources.tables import standardise
from tests.fixtures import hours, noisy, tables

HOURS = (6, 12)


@pytest.fixture(scope="module")
def dense(spark):
    """Readings every six minutes: twelve hours are more rows than the halo has."""
    return standardise(tables(spark, telemetry=noisy(3, 150, step=0.1)).telemetry).cache()


def dealt(df, rows, size):
    numbered = features.cumulative_deviation(df, number=True, reach=max(HOURS) * HOUR_US)
    blocks = features.laid_out(numbered, rows, size)
    return blocks.sortWithinPartitions("machine_id", "_block", "_rn")


def differ(a, b, names):
    both = a.join(b.select("machine_id", "timestamp", *[F.col(n).alias(f"b_{n}") for n in names]), ["machine_id", "timestamp"])
    unlike = [~(F.col(n).eqNullSafe(F.col(f"b_{n}")) | F.coalesce(F.abs(F.col(n) - F.col(f"b_{n}")) < 1e-7, F.lit(False))) for n in names]
    wrong = F.exists(F.array(*unlike), lambda x: x)
    return both.count() - a.count(), both.filter(wrong).count()


def test_time_windows_in_blocks(dense):
    plain = features.rolling_statistics(dense, HOURS)
    found = features.rolling_statistics(dealt(dense, 5, 40), HOURS)
    assert found.count() == dense.count()
    names = [c for c in plain.columns if c.endswith(("_6h", "_12h"))]
    assert differ(plain, found, names) == (0, 0)


def test_a_row_without_a_time_has_no_windows(spark):
    t = tables(spark, telemetry=[*noisy(2, 30), (None, 1, 1.0, 2.0, 3.0, 4.0)])
    df = standardise(t.telemetry)
    found = features.rolling_statistics(dealt(df, 5, 40), HOURS)
    assert found.count() == features.rolling_statistics(df, HOURS).count() == 60


def test_spectra_and_correlations_in_blocks(dense):
    laid = dealt(dense, 64, 80)
    found = features.spectral_and_corr(laid).filter("_own")
    for plain in (features.spectral(dense), features.rolling_corr(dense)):
        names = [c for c in plain.columns if c not in ("machine_id", "timestamp", *FEATURE_SENSORS)]
        assert differ(plain, found, names) == (0, 0)


def test_exponential_means_leave_the_halo_out(spark):
    rows = standardise(tables(spark, telemetry=noisy(2, 2 * block_rows() + 50)).telemetry)
    means = ewma(dealt(rows, 168, block_rows()), base=rows).filter("_own")
    names = [c for c in means.columns if "_ewma_" in c]
    assert differ(ewma(rows), means, names) == (0, 0)


def test_a_machine_listed_twice(spark):
    """Each listing gets the readings; time windows hold the copies, as on their own."""
    t = tables(spark, telemetry=noisy(2, 40, step=0.5), machines=[(1, "a", 1), (1, "b", 2), (2, "a", 3)])
    wide = build_features(t, Params(), drop_null=False)
    listed = standardise(t.telemetry.join(t.machines, "machineID")).select("machine_id", "timestamp", *FEATURE_SENSORS)
    plain = features.rolling_statistics(listed, HOURS).distinct()
    names = [c for c in plain.columns if c.endswith(("_6h", "_12h")) and "skew" not in c and "kurt" not in c]
    again = wide.select("machine_id", "timestamp", *[n for n in names if "delta" not in n and "pct" not in n]).distinct()
    assert wide.count() == listed.count() and again.count() == plain.count()
    assert differ(plain, again, [n for n in again.columns if n not in ("machine_id", "timestamp")]) == (0, 0)


def test_wide_rows_of_the_feature_table_are_not_shuffled(spark):
    t = tables(
        spark,
        telemetry=noisy(3, 20),
        maint=[(hours(3), 1, "comp1")],
        failures=[(hours(30), 1, "comp2")],
        machines=[(m, "model1", m) for m in (1, 2, 3)],
    )
    plan = build_features(t, Params(), drop_null=False)._jdf.queryExecution().executedPlan().toString()
    widened = plan[: plan.rindex("MapInArrow")]
    assert widened.count("MapInArrow") == 1 and "Exchange" not in widened
