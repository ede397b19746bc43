"""Stateful streams go on after a restart; roll-ups merge to what the readings give."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearlog.params import SENSORS
from gearlog.sources.shared import shared_path
from gearlog.sources.tables import SCHEMAS
from gearlog.streaming import jobs, rollups, state
from tests.fixtures import hours, noisy, reading, rows, tables


def _write(spark, folder, name, data):
    tables(spark, telemetry=data).telemetry.coalesce(1).write.parquet(os.path.join(folder, name))


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMAS["telemetry"]).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="gearlog-state-")


def _states(spark, folder, path, **settings):
    with state.rocksdb(spark):
        return jobs.append_to(state.machine_state(_stream(spark, folder), **settings), path)


def test_state_goes_on_after_a_restart(spark, folder):
    data = noisy(3, 30)
    cut = sorted(r[0] for r in data)[45]
    path, whole = shared_path(spark, "state"), tempfile.mkdtemp(prefix="gearlog-state-")
    _write(spark, folder, "a", [r for r in data if r[0] < cut])
    first = _states(spark, folder, path).count()
    _write(spark, folder, "b", [r for r in data if r[0] >= cut])
    out = _states(spark, folder, path)
    assert out.count() == len(data) > first
    _write(spark, whole, "all", data)
    once = _states(spark, whole, shared_path(spark, "state"))
    same = out.exceptAll(once).count() + once.exceptAll(out).count()
    assert same == 0


def test_state_expires_and_late_readings_are_left_out(spark, folder):
    path = shared_path(spark, "state")
    _write(spark, folder, "a", [reading(0), reading(2)])
    _states(spark, folder, path, expiry_hours=10)
    _write(spark, folder, "b", [reading(1), reading(12), reading(30)])
    out = _states(spark, folder, path, expiry_hours=10)
    # 1 h is older than the last reading taken; 12 h is just in time, 30 h begins anew
    got = rows(out, "datetime", "readings", "hours_since_last")
    assert got == [(hours(0), 1, None), (hours(2), 2, 2.0), (hours(12), 3, 10.0), (hours(30), 1, None)]


def test_alerts_are_raised_once_and_time_out(spark, folder):
    """Scores as vibration: 4 raises, 2.5 holds, 1 clears; then 5 is never cleared."""
    path = shared_path(spark, "alerts")
    scores = [(1, 1.0), (2, 4.0), (3, 4.5), (4, 2.5), (5, 1.0), (6, 2.5), (7, -5.0), (40, 2.5)]
    for name, part in (("a", scores[:3]), ("b", scores[3:7]), ("c", scores[7:])):
        _write(spark, folder, name, [reading(h, vibration=v) for h, v in part])
        scored = _stream(spark, folder).withWatermark("datetime", "1 hour").withColumn("zscore", F.col("vibration"))
        with state.rocksdb(spark):
            out = jobs.append_to(state.alert_states(scored, 3.0, 2.0, quiet_hours=24), path)
    assert rows(out, "at", "event", "readings", "peak") == [
        (hours(2), "raised", 1, 4.0),
        (hours(5), "cleared", 4, 4.5),
        (hours(7), "raised", 1, 5.0),
        (hours(31), "timeout", 1, 5.0),
    ]


def test_rollups_merge_like_the_readings(spark):
    t = tables(spark, telemetry=noisy(4, 24 * 40)).telemetry
    hourly = rollups.partial_states(t)
    days = rollups.merged(hourly, "day")
    months = rollups.merged(days, "month")
    for states, unit in ((days, "day"), (months, "month")):
        got = {(r["machineID"], r["window_start"]): r for r in rollups.statistics(states).collect()}
        aggs = [f(s).alias(f"{s}_{n}") for s in SENSORS for n, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max))]
        want = t.groupBy("machineID", F.date_trunc(unit, "datetime").alias("w")).agg(F.count("*").alias("n"), *aggs)
        for r in want.collect():
            g = got.pop((r["machineID"], r["w"]))
            assert g["readings"] == r["n"]
            for s in SENSORS:
                for n in ("mean", "std", "max"):
                    assert (g[f"{s}_{n}"] or 0) == pytest.approx(r[f"{s}_{n}"] or 0, rel=1e-9)
        assert not got


def test_sketch_ranks_stay_near(spark):
    """Merged sketches of a month: ranks off by less than 2 %."""
    t = tables(spark, telemetry=noisy(2, 24 * 28)).telemetry
    months = rollups.merged(rollups.merged(rollups.partial_states(t), "day"), "month")
    probs = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    for r in rollups.quantiles(months, probs).collect():
        own = t.filter(F.col("machineID") == r["machineID"]).filter(F.date_trunc("month", "datetime") == r["window_start"])
        xs = np.sort([x[0] for x in own.select("vibration").collect()])
        for n, p in probs.items():
            rank = np.searchsorted(xs, r[f"vibration_{n}"], "right") / len(xs)
            assert abs(rank - p) <= 0.02 + 1 / len(xs)


def test_states_go_to_python_in_batches(spark, folder):
    """One call to the state store for each machine costs more than its readings."""
    _write(spark, folder, "a", [reading(0)])
    plan = state.machine_state(_stream(spark, folder))._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandasWithState" in plan and "TransformWithState" not in plan


def test_readings_of_equal_times_in_the_order_asked_for(spark, folder):
    """Ranks of one time as pressure; a missing one comes last."""
    data = [(hours(1), 1, v, 1.0, rank, 1.0) for v, rank in ((30.0, None), (20.0, 2.0), (10.0, 1.0))]
    _write(spark, folder, "a", data)
    out = _states(spark, folder, shared_path(spark, "state"), alpha=0.5, order=("datetime", "pressure"))
    assert rows(out, "readings", "volt_ewma") == [(1, 10.0), (2, 15.0), (3, 22.5)]
