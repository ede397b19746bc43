"""Split windows equal plain windows, whatever the span or block size."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gearlog.functions.ranges import cumulative, exact_quantiles
from gearlog.functions.spans import (
    HOUR_US,
    block_window,
    numbered,
    row_blocks,
    running,
    span_of,
    with_halo,
)
from gearlog.functions.stats import interval_join, per_key_join, safe_corr
from tests.fixtures import noisy, rows, tables


@pytest.fixture(scope="module")
def readings(spark):
    t = tables(spark, telemetry=noisy(4, 60)).telemetry
    return t.withColumn("_us", F.unix_micros("datetime")).cache()


@pytest.mark.parametrize("span_hours", [1, 7, 24, 1000])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_equals_whole_window(readings, span_hours, reverse, inclusive):
    order = F.desc("_us") if reverse else F.asc("_us")
    frame = (
        Window.partitionBy("machineID")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    out = running(
        readings,
        ["machineID"],
        [order],
        {"s": ("sum", F.col("volt")), "m": ("max", F.col("volt")), "l": ("min", F.col("_us"))},
        span_of("_us", span_hours * HOUR_US),
        reverse=reverse,
        inclusive=inclusive,
    )
    want = readings.select(
        "machineID",
        "_us",
        F.sum("volt").over(frame).alias("s"),
        F.max("volt").over(frame).alias("m"),
        F.min("_us").over(frame).alias("l"),
    )
    got = rows(out.withColumn("s", F.round("s", 6)).fillna(-1), "machineID", "_us", "s", "m", "l")
    assert got == rows(
        want.withColumn("s", F.round("s", 6)).fillna(-1), "machineID", "_us", "s", "m", "l"
    )


@pytest.mark.parametrize("span_hours", [5, 24, 500])
def test_halo_keeps_time_frames_whole(readings, span_hours):
    frame = [-(12 * HOUR_US) + 1, 6 * HOUR_US]
    whole = Window.partitionBy("machineID").orderBy("_us").rangeBetween(*frame)
    split = Window.partitionBy("machineID", "_span").orderBy("_us").rangeBetween(*frame)
    out = (
        with_halo(readings, "_us", span_hours * HOUR_US, 12 * HOUR_US, 6 * HOUR_US)
        .withColumn("n", F.count("*").over(split))
        .filter("_own")
    )
    want = readings.withColumn("n", F.count("*").over(whole))
    assert rows(out, "machineID", "_us", "n") == rows(want, "machineID", "_us", "n")


@pytest.mark.parametrize("size", [1, 10, 64, 5000])
def test_row_blocks_keep_row_frames_whole(readings, size):
    named = numbered(readings, ["machineID"], "_us", 24 * HOUR_US)
    out = (
        row_blocks(named, 9, size)
        .withColumn("m", F.max("volt").over(block_window(["machineID"]).rowsBetween(-9, 0)))
        .filter("_own")
    )
    whole = Window.partitionBy("machineID").orderBy("_us")
    want = readings.withColumns(
        {
            "_rn": F.row_number().over(whole),
            "m": F.max("volt").over(whole.rowsBetween(-9, 0)),
        }
    )
    assert rows(out, "machineID", "_us", "_rn", "m") == rows(want, "machineID", "_us", "_rn", "m")


def test_block_sizes_are_bounded_for_a_busy_machine(readings):
    blocks = row_blocks(numbered(readings, ["machineID"], "_us"), 9, 20)
    biggest = blocks.groupBy("machineID", "_block").count().agg(F.max("count")).first()[0]
    assert biggest <= 29


def test_exact_quantiles(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 2, 2, 10]] + [("b", 5.0)], "g string, x double")
    out = exact_quantiles(df, "x", {"q25": 0.25, "q50": 0.5, "q90": 0.9}, ["g"])
    assert rows(out, "g", "q25", "q50", "q90") == [("a", 2.0, 2.0, pytest.approx(6.8)), ("b", 5.0, 5.0, 5.0)]


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, "x", {"m": 0.5}, []).collect() == []


@pytest.mark.parametrize("descending", [False, True])
def test_cumulative_many_values(spark, descending):
    df = spark.range(5000).select((F.col("id") % 997).cast("double").alias("v"))
    counted = df.groupBy("v").agg(F.count("*").alias("n")).withColumn("g", F.lit(1))
    out = cumulative(counted, "v", ["n"], ["g"], descending)
    w = Window.partitionBy("g").orderBy(F.desc("v") if descending else F.asc("v"))
    want = counted.withColumn("cum_n", F.sum("n").over(w))
    assert rows(out, "v", "cum_n") == rows(want, "v", "cum_n")


def test_interval_join_ends_and_no_repeats(spark):
    points = spark.createDataFrame([(1, t) for t in (0, 5, 10, 11)], "k int, at long")
    bands = spark.createDataFrame([(1, 0, 10, "x")], "k int, lo long, hi long, name string")
    for width in (1, 3, 100):
        closed = interval_join(points, bands, "k", "at", "lo", "hi", width)
        opened = interval_join(points, bands, "k", "at", "lo", "hi", width, low_open=True)
        assert rows(closed, "at") == [(0,), (5,), (10,)]
        assert rows(opened, "at") == [(5,), (10,)]


def test_per_key_join_keeps_every_fact_once(readings):
    means = readings.groupBy("machineID").agg(F.avg("volt").alias("m")).filter("machineID != 2")
    assert per_key_join(readings, means).count() == readings.filter("machineID != 2").count()
    assert per_key_join(readings, means, how="left").count() == readings.count()


def test_per_key_join_does_not_broadcast_the_copies(readings):
    means = readings.groupBy("machineID").agg(F.avg("volt").alias("m"))
    for how in ("inner", "left"):
        plan = per_key_join(readings, means, how=how)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "ShuffledHashJoin" in plan


def test_safe_corr_constant_and_null(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0), (1, 2.0, 5.0), (2, 1.0, 2.0), (2, 2.0, 4.0), (2, 9.0, None)],
        "g int, a double, b double",
    )
    out = df.groupBy("g").agg(safe_corr(F.col("a"), F.col("b")).alias("c"))
    assert rows(out, "g", "c") == [(1, None), (2, pytest.approx(1.0))]
