"""Survival, forecasting and what precedes a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ranges import cumulative, exact_quantiles
from ..functions.spans import (
    DAY_US,
    HOUR_US,
    active_marks,
    beside,
    last_time,
    running,
    span_of,
)
from ..functions.stats import interval_join, per_key_join, safe_corr, ts
from ..params import SENSORS, Params
from ..sources.tables import Tables
from .failures import gaps, timed


def survival_times(t: Tables, p: Params) -> DataFrame:
    """Hours to first failure per machine, the horizon where there is none."""
    start = F.unix_micros(ts(p.observation_start))
    first = t.failures.groupBy("machineID").agg(
        ((F.unix_micros(F.min("datetime")) - start) / F.lit(3.6e9)).alias("h")
    )
    return t.machines.join(first, "machineID", "left").select(
        "machineID",
        "model",
        F.coalesce("h", F.lit(p.horizon_hours)).alias("survival_hours"),
        F.col("h").isNull().alias("censored"),
    )


def survival_summary(t: Tables, p: Params) -> DataFrame:
    """Percent of machines alive past each horizon, mean and median survival."""
    lives = survival_times(t, p)
    h = F.col("survival_hours")
    shares = {
        f"pct_survive_{c}hr": F.lit(100.0) * F.avg((h > c).cast("double"))
        for c in p.survival_hours
    }
    median = exact_quantiles(lives, "survival_hours", {"m": 0.5}, []).select("m").scalar()
    return lives.agg(
        *[e.alias(n) for n, e in shares.items()],
        F.avg(h).alias("mean_survival_hours"),
    ).withColumn("median_survival_hours", median)


def survival_curve(t: Tables, p: Params, fleet: str = "fleet") -> DataFrame:
    """Product-limit survival of each model and of the whole fleet, step by step.

    One row per group and distinct time: machines at risk just before it, failures and
    machines lost from sight at it, the share that survives it, and the variance of
    that share (Greenwood). The last step may take all machines left; the share is 0
    from there on and has no variance. Machines without a model are group ''.
    Products are sums of logarithms, which run over written ranges of (group, time).
    """
    groups = F.array(F.coalesce("model", F.lit("")), F.lit(fleet))
    counted = (
        survival_times(t, p)
        .withColumn("model", F.explode(groups))
        .groupBy("model", F.col("survival_hours").alias("time_hours"))
        .agg(F.count("*").alias("lives"), F.count_if(~F.col("censored")).alias("events"))
    )
    n, d = F.col("at_risk"), F.col("events")
    steps = (
        cumulative(counted, "time_hours", ["lives"], ["model"], descending=True)
        .withColumnRenamed("cum_lives", "at_risk")
        .withColumns(
            {
                "_log": F.when(n > d, F.log((n - d) / n)).otherwise(0.0),
                "_var": F.when(n > d, d / (n.cast("double") * (n - d))).otherwise(0.0),
                "_out": (n == d).cast("long"),
            }
        )
    )
    out = cumulative(steps, "time_hours", ["_log", "_var", "_out"], ["model"])
    alive = F.col("cum__out") == 0
    share = F.when(alive, F.exp("cum__log")).otherwise(0.0)
    return out.select(
        "model",
        "time_hours",
        "at_risk",
        "events",
        (F.col("lives") - d).alias("censored"),
        share.alias("survival"),
        F.when(alive, F.exp(F.col("cum__log") * 2) * F.col("cum__var")).alias("variance"),
    ).orderBy("model", "time_hours")


def maintenance_forecast(t: Tables, p: Params) -> DataFrame:
    """Interval between maintenance of one component, with a 95 % band."""
    mean, std = F.col("avg_interval_hours"), F.col("std_interval_hours")
    return (
        gaps(t.maint, ["machineID", "comp"], "comp")
        .filter("hours_since is not null")
        .groupBy(F.col("comp").alias("component"))
        .agg(
            F.count("*").alias("sample_size"),
            F.avg("hours_since").alias("avg_interval_hours"),
            F.stddev("hours_since").alias("std_interval_hours"),
        )
        .withColumns({"lower_95ci": mean - 1.96 * std, "upper_95ci": mean + 1.96 * std})
        .orderBy("avg_interval_hours")
    )


def _before_failures(t: Tables, hours_from: int, hours_to: int) -> DataFrame:
    """Distinct failures with the band of readings ``hours_from`` .. ``hours_to`` before."""
    at = F.unix_micros("datetime")
    return t.failures.groupBy("machineID", "datetime", "failure").agg(
        F.count("*").alias("_times")
    ).select(
        "machineID",
        "failure",
        "_times",
        at.alias("_fail"),
        (at - hours_from * HOUR_US).alias("_from"),
        (at - hours_to * HOUR_US).alias("_to"),
    )


def prefailure_profile(
    t: Tables, p: Params, hours: int = 72, rows: int = 72, shared: bool = False
) -> DataFrame:
    """Mean sensors in the hours before failures of each type.

    At most ``rows`` latest readings count per failure. ``shared=True`` lets the
    components that fail at one moment share that limit.

    Readings are numbered per machine and each failure knows the number of the
    last reading before it, so the join is on row numbers and never meets more
    than ``rows`` readings per failure, however dense they are.
    """
    bands = _before_failures(t, hours, 0)
    marks = active_marks(
        bands, F.col("_from"), F.col("_fail") + 1, {"_near": F.lit(1).cast("long")}
    )
    readings = timed(t.telemetry.select("machineID", "datetime", *SENSORS))
    keys = readings.select("machineID", "_us")
    order, span = [F.col("_us"), F.col("_kind")], span_of("_us", DAY_US)
    is_row = (F.col("_kind") == 1).cast("long")
    near = running(
        beside(readings, marks),
        ["machineID"],
        order,
        {"_rn": ("sum", is_row), "_active": ("sum", F.col("_near"))},
        span,
    ).filter("_kind = 1 and _active > 0")
    ends = running(
        beside(bands.withColumn("_us", F.col("_fail")), keys),
        ["machineID"],
        order,
        {"_last": ("sum", 1 - is_row)},
        span,
    ).filter("_kind = 1").drop("_kind", "_us")
    # several failures of one moment: how many there are and how many come first
    moment = Window.partitionBy("machineID", "_fail")
    ends = ends.withColumns(
        {
            "_all": F.sum("_times").over(moment),
            "_first": F.sum("_times").over(moment.orderBy("failure")) - F.col("_times"),
            "_low": F.col("_last") - (rows - 1),
        }
    )
    found = interval_join(
        near.select("machineID", "_us", "_rn", *SENSORS),
        ends,
        "machineID",
        "_rn",
        "_low",
        "_last",
        rows,
    ).filter(F.col("_us") >= F.col("_from"))
    # failures logged twice at one moment count each reading twice
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times")))
    if shared:
        place = (F.col("_last") - F.col("_rn")) * F.col("_all") + F.col("_first")
        found = found.filter(place + F.col("_copy") <= rows)
    return (
        found.groupBy("failure")
        .agg(
            F.count("*").alias("sample_count"),
            F.avg("volt").alias("avg_prefailure_voltage"),
            F.avg("vibration").alias("avg_prefailure_vibration"),
            F.avg("rotate").alias("avg_prefailure_rotation"),
            F.avg("pressure").alias("avg_prefailure_pressure"),
            F.stddev("vibration").alias("std_prefailure_vibration"),
        )
        .orderBy(F.desc("sample_count"), "failure")
    )


def prognostic_horizon(t: Tables, p: Params, sigmas: float = 2.0) -> DataFrame:
    """How long before failures vibration leaves its reference band, per type.

    Only the readings outside the band are joined to failures. That a type has
    readings at all comes from one look at the last reading before each band end.
    """
    base = (
        t.telemetry.filter(F.col("datetime") < ts(p.reference_before))
        .groupBy("machineID")
        .agg(F.avg("vibration").alias("m"), F.stddev("vibration").alias("s"))
    )
    z = (F.col("vibration") - F.col("m")) / F.nullif(F.col("s"), F.lit(0.0))
    readings = timed(t.telemetry.select("machineID", "datetime", "vibration"))
    odd = per_key_join(readings, base).filter(F.abs(z) > sigmas).select("machineID", "_us")
    bands = _before_failures(t, 168, 1)
    hits = (
        interval_join(odd, bands, "machineID", "_us", "_from", "_to", 7 * DAY_US)
        .groupBy("failure")
        .agg(
            F.sum("_times").alias("detectable_events"),
            F.sum((F.col("_fail") - F.col("_us")) / F.lit(3.6e9) * F.col("_times")).alias("_h"),
            F.max((F.col("_fail") - F.col("_us")) / F.lit(3.6e9)).alias(
                "max_detection_horizon_hours"
            ),
        )
    )
    ends = bands.withColumn("_us", F.col("_to"))
    seen = last_time(ends, {"_last": readings.select("machineID", "_us")}, 7 * DAY_US)
    kinds = (
        seen.filter(F.col("_last") >= F.col("_from"))
        .join(base.select("machineID"), "machineID", "left_semi")
        .select("failure")
        .distinct()
    )
    return (
        kinds.join(hits, "failure", "left")
        .select(
            "failure",
            (F.col("_h") / F.col("detectable_events")).alias("avg_detection_horizon_hours"),
            "max_detection_horizon_hours",
            F.coalesce("detectable_events", F.lit(0)).alias("detectable_events"),
        )
        .orderBy(F.desc("avg_detection_horizon_hours"))
    )


def failure_correlation(
    t: Tables, p: Params, hours: int = 24, once: bool = False
) -> DataFrame:
    """Correlation of each sensor with a failure within the next ``hours``.

    A reading counts once per failure that follows, as a left join yields;
    ``once=True`` counts every reading once.
    """
    failures = timed(t.failures)
    marks = active_marks(
        failures, F.col("_us") - hours * HOUR_US, F.col("_us"), {"_n": F.lit(1)}
    )
    labelled = running(
        beside(timed(t.telemetry.select("machineID", "datetime", *SENSORS)), marks),
        ["machineID"],
        [F.col("_us"), F.col("_kind")],
        {"_active": ("sum", F.col("_n"))},
        span_of("_us", DAY_US),
    ).filter("_kind = 1")
    fails = (F.coalesce("_active", F.lit(0)) > 0).cast("double")
    rows = labelled.select(*SENSORS, fails.alias("y"), "_active")
    if not once:
        copies = F.sequence(F.lit(1).cast("long"), F.greatest("_active", F.lit(1).cast("long")))
        rows = rows.withColumn("_copy", F.explode(copies))
    # The sensors' names in this report.
    names = {"volt": "voltage", "rotate": "rotation", "pressure": "pressure", "vibration": "vibration"}
    wide = rows.agg(*[safe_corr(F.col(s), F.col("y")).alias(n) for s, n in names.items()])
    return wide.unpivot([], list(names.values()), "sensor", "correlation_with_failure").orderBy(
        F.desc(F.abs("correlation_with_failure")), "sensor"
    )
