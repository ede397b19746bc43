"""Written counts: quantiles and running totals over several ranges, few reads."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gearlog.functions import ranges
from gearlog.operators import advanced, evaluate, prepare, quality
from gearlog.params import FIXTURE
from gearlog.sources.bindings import bind
from tests.fixtures import tables


def source_scans(df) -> int:
    """Scans in a plan, but for those of written counts (they all read the range)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line.split("Batched:")[0] for line in plan.splitlines() if "FileScan parquet" in line]
    return sum("_part#" not in line for line in scans)


@pytest.fixture
def many_ranges(spark):
    """So small tables are cut into several ranges, too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_quantiles_over_several_ranges(spark, many_ranges):
    rng = random.Random(1)
    data = [(g, float(rng.randrange(50)) if rng.random() > 0.05 else None) for g in "abc" for _ in range(400)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r.asDict() for r in ranges.exact_quantiles(df, "x", {"lo": 0.0, "q": 0.37, "hi": 1.0}, ["g"]).collect()}
    for g in "abc":
        xs = sorted(x for k, x in data if k == g and x is not None)
        for name, p in (("lo", 0.0), ("q", 0.37), ("hi", 1.0)):
            h = (len(xs) - 1) * p
            want = xs[math.floor(h)] + (h - math.floor(h)) * (xs[math.ceil(h)] - xs[math.floor(h)])
            assert got[g][name] == pytest.approx(want, abs=1e-12)
    assert ranges.exact_quantiles(df.filter("false"), "x", {"m": 0.5}, []).collect() == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_several_ranges(spark, many_ranges, descending):
    rows = [(g, float(v), (v * 7) % 5) for g in ("a", "b") for v in range(100)]
    out = ranges.cumulative(spark.createDataFrame(rows, "g string, v double, n long"), "v", ["n"], ["g"], descending)
    assert out.columns == ["g", "v", "n", "cum_n"]
    total = {}
    for r in out.orderBy("g", F.desc("v") if descending else "v").collect():
        total[r["g"]] = total.get(r["g"], 0) + r["n"]
        assert r["cum_n"] == total[r["g"]]


def test_ranked_operators_read_their_input_twice_at_most(spark, tmp_path, monkeypatch):
    """Scans of the input: in the counts that are written, and in what is left to run."""
    scores = [("m", i % 13 / 13, i % 3 == 0, i % 2, float(i)) for i in range(200)]
    path = f"{tmp_path}/scored_rows"
    spark.createDataFrame(scores, "model string, probability double, l boolean, prediction int, t double").selectExpr(
        "model", "probability", "int(l) AS label", "prediction", "t AS time_to_failure_hours", "1L AS machine_id"
    ).write.parquet(path)
    seen = []
    plain = ranges.written_counts

    def written(counted, *rest):
        seen.append(source_scans(counted))
        return plain(counted, *rest)

    monkeypatch.setattr(ranges, "written_counts", written)
    df = spark.read.parquet(path)
    t = bind(spark, "/root/testdata/sf0.001").telemetry
    readings = t.selectExpr("machineID AS machine_id", "datetime AS timestamp", "volt", "vibration")
    for most, fn in (
        (1, lambda: evaluate.roc_auc(df)),
        (1, lambda: evaluate.average_precision(df)),
        (2, lambda: evaluate.compare_models(df)),
        (2, lambda: quality.ks_drift(t, t)),  # one of each side
        # one for the cut, one for the quartiles, one for the rows themselves
        (3, lambda: prepare.robust_scaled(readings, columns=("volt", "vibration"))),
    ):
        seen.clear()
        assert 1 <= source_scans(fn()) + sum(seen) <= most


def test_survival_curve_by_hand(spark):
    """Failures at 24 h (two of four) and 48 h, one machine never fails."""
    from tests.fixtures import hours

    start = FIXTURE.__class__(**{**FIXTURE.__dict__, "observation_start": str(hours(0)), "horizon_hours": 100.0})
    t = tables(
        spark,
        failures=[(hours(24), 1, "comp1"), (hours(24), 2, "comp1"), (hours(48), 3, "comp2"), (hours(60), 3, "comp2")],
        machines=[(1, "a", 1), (2, "a", 1), (3, "a", 1), (4, "b", 1)],
    )
    got = {(r["model"], r["time_hours"]): r for r in advanced.survival_curve(t, start).collect()}
    a = [got["a", 24.0], got["a", 48.0]]
    assert [(r["at_risk"], r["events"], r["censored"]) for r in a] == [(3, 2, 0), (1, 1, 0)]
    assert a[0]["survival"] == pytest.approx(1 / 3)
    assert a[0]["variance"] == pytest.approx((1 / 9) * (2 / 3))
    assert (a[1]["survival"], a[1]["variance"]) == (0.0, None)
    assert got["b", 100.0]["survival"] == 1.0 and got["b", 100.0]["censored"] == 1
    fleet = [got["fleet", x] for x in (24.0, 48.0, 100.0)]
    assert [r["survival"] for r in fleet] == pytest.approx([0.5, 0.25, 0.25])


def test_survival_curve_agrees_with_the_summary(spark):
    t = bind(spark, "/root/testdata/sf0.01")
    curve = [r for r in advanced.survival_curve(t, FIXTURE).collect() if r["model"] == "fleet"]
    summary = advanced.survival_summary(t, FIXTURE).first()
    for hours in FIXTURE.survival_hours:
        alive = [r["survival"] for r in curve if r["time_hours"] <= hours]
        assert 100 * (alive[-1] if alive else 1.0) == pytest.approx(summary[f"pct_survive_{hours}hr"])
    below = [r["time_hours"] for r in curve if r["survival"] <= 0.5]
    median = summary["median_survival_hours"]
    assert (below[0] >= median - 1e-9) if below else median == pytest.approx(FIXTURE.horizon_hours)
