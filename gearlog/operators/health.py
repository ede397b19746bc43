"""Asset-health queries: z-scores, drift, anomalies, thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import (
    one_row,
    per_key_join,
    safe_corr,
    share,
    ts,
    whole_days,
    zscore,
)
from ..params import Params
from ..sources.tables import Tables


def _between(period: tuple[str, str]):
    return F.col("datetime").between(ts(period[0]), ts(period[1]))


def _days(n: int):
    return F.expr(f"interval {n} days")


def health_scores(t: Tables, p: Params) -> DataFrame:
    """Latest reading (7 days) against the machine's last 30 days, one row each.

    One scan and one shuffle: the look-backs are conditional aggregates.
    """
    as_of = t.as_of(p)
    new = F.col("datetime") >= as_of - _days(7)
    per = (
        t.telemetry.filter(F.col("datetime") >= as_of - _days(30))
        .groupBy("machineID")
        .agg(
            F.avg("volt").alias("avg_volt"),
            F.stddev("volt").alias("std_volt"),
            F.avg("vibration").alias("avg_vib"),
            F.stddev("vibration").alias("std_vib"),
            F.max(F.when(new, F.col("datetime"))).alias("last_reading"),
            F.max_by("volt", "datetime").alias("current_voltage"),
            F.max_by("vibration", "datetime").alias("current_vibration"),
        )
        .filter("last_reading is not null")
    )
    z = per.withColumns(
        {
            "volt_zscore": F.abs(
                zscore(F.col("current_voltage"), F.col("avg_volt"), F.col("std_volt"))
            ),
            "vib_zscore": F.abs(
                zscore(F.col("current_vibration"), F.col("avg_vib"), F.col("std_vib"))
            ),
        }
    )
    # greatest() skips nulls, so one usable sensor is enough for a status
    worst = F.greatest("volt_zscore", "vib_zscore")
    status = (
        F.when(worst > 3, "CRITICAL").when(worst > 2, "WARNING").otherwise("HEALTHY")
    )
    return z.withColumns({"health_status": status, "worst_zscore": worst})


def health_score(t: Tables, p: Params) -> DataFrame:
    """Current health of every machine, worst first."""
    return (
        health_scores(t, p)
        .orderBy(F.desc_nulls_first("worst_zscore"), "machineID")
        .select(
            "machineID",
            "last_reading",
            "current_voltage",
            "current_vibration",
            "volt_zscore",
            "vib_zscore",
            "health_status",
        )
    )


def vibration_drift(t: Tables, p: Params, top: int | None = 15) -> DataFrame:
    """Mean vibration now against the baseline period, strongest increase first."""
    old = _between(p.baseline)
    new = F.col("datetime") >= ts(p.recent_from)
    per = (
        t.telemetry.filter(old | new)
        .groupBy("machineID")
        .agg(
            F.avg(F.when(old, F.col("vibration"))).alias("baseline_vibration"),
            F.avg(F.when(new, F.col("vibration"))).alias("recent_vibration"),
        )
    )
    drift = F.col("recent_vibration") - F.col("baseline_vibration")
    out = (
        per.filter(drift > 0)
        .withColumns(
            {
                "vibration_drift": drift,
                "pct_increase": F.lit(100.0)
                * drift
                / F.nullif(F.col("baseline_vibration"), F.lit(0.0)),
            }
        )
        .orderBy(F.desc("vibration_drift"), "machineID")
    )
    return out if top is None else out.limit(top)


def degradation_rate(t: Tables, p: Params) -> DataFrame:
    """Slope of vibration per hour and per year of every machine."""
    hours = F.unix_micros("datetime") / F.lit(3.6e9)
    slope = F.col("vib_degradation_per_hour")
    return (
        t.telemetry.groupBy("machineID")
        .agg(
            F.count("*").alias("data_points"),
            F.regr_slope("vibration", hours).alias("vib_degradation_per_hour"),
        )
        .filter(F.col("data_points") > p.slope_min_points)
        .withColumn("vib_degradation_per_year", slope * 8760)
        .orderBy(F.desc("vib_degradation_per_hour"), "machineID")
    )


def weekly_anomalies(t: Tables, p: Params) -> DataFrame:
    """Readings over 3 deviations off their own day's mean, per machine and week."""
    readings = t.telemetry.select(
        "machineID",
        "vibration",
        "datetime",
        F.date_trunc("day", "datetime").alias("day"),
    )
    days = readings.groupBy("machineID", "day").agg(
        F.avg("vibration").alias("m"), F.stddev("vibration").alias("s")
    )
    odd = F.abs(F.col("vibration") - F.col("m")) > 3 * F.nullif(F.col("s"), F.lit(0.0))
    return (
        readings.join(days, ["machineID", "day"])
        .groupBy("machineID", F.date_trunc("week", "datetime").alias("week"))
        .agg(F.count_if(odd).alias("anomaly_count"))
        .orderBy("machineID", "week")
    )


def never_failed(t: Tables, p: Params) -> DataFrame:
    """Machines with telemetry and no failure, oldest first."""
    counts = t.telemetry.groupBy("machineID").agg(F.count("*").alias("telemetry_records"))
    failed = t.failures.select("machineID").distinct()
    return (
        t.machines.join(failed, "machineID", "left_anti")
        .join(counts, "machineID")
        .select("machineID", "model", "age", "telemetry_records")
        .orderBy(F.desc("age"), "machineID")
    )


def _anomaly_counts(t: Tables, when, guard: bool) -> DataFrame:
    base = (
        t.telemetry.filter(when)
        .groupBy("machineID")
        .agg(F.avg("vibration").alias("m"), F.stddev("vibration").alias("s"))
    )
    limit = F.nullif(F.col("s"), F.lit(0.0)) if guard else F.col("s")
    odd = F.abs(F.col("vibration") - F.col("m")) > 3 * limit
    return (
        per_key_join(t.telemetry.select("machineID", "datetime", "vibration"), base)
        .groupBy("machineID")
        .agg(F.count_if(odd).alias("anomaly_count"), F.count("*").alias("readings"))
        .filter("anomaly_count > 0")
    )


def anomaly_leaders(t: Tables, p: Params, top: int | None = 10) -> DataFrame:
    """Machines with most readings over 3 deviations off their baseline period."""
    rate = F.lit(100.0) * F.col("anomaly_count") / F.col("readings")
    out = (
        _anomaly_counts(t, _between(p.baseline), guard=True)
        .select("machineID", "anomaly_count", rate.alias("anomaly_rate_pct"))
        .orderBy(F.desc("anomaly_count"), "machineID")
    )
    return out if top is None else out.limit(top)


def anomaly_leaders_global(t: Tables, p: Params, top: int | None = 10) -> DataFrame:
    """The same against the reference period, as a share of all fleet readings."""
    total = t.telemetry.agg(F.count("*")).scalar()
    rate = F.lit(100.0) * F.col("anomaly_count") / total
    out = (
        _anomaly_counts(t, F.col("datetime") < ts(p.reference_before), guard=False)
        .select("machineID", "anomaly_count", rate.alias("anomaly_rate_pct"))
        .orderBy(F.desc("anomaly_count"), "machineID")
    )
    return out if top is None else out.limit(top)


def rolling_daily_trend(t: Tables, p: Params, days: int = 7) -> DataFrame:
    """Daily mean vibration and its moving mean over the last ``days`` days with data."""
    daily = t.telemetry.groupBy(
        "machineID", F.date_trunc("day", "datetime").alias("day")
    ).agg(F.avg("vibration").alias("daily_avg_vibration"))
    # one row per machine and day: a year of history is 365 rows per key
    moving = Window.partitionBy("machineID").orderBy("day").rowsBetween(1 - days, 0)
    return daily.withColumn(
        "rolling_7day_avg", F.avg("daily_avg_vibration").over(moving)
    ).orderBy("machineID", "day")


def sensor_correlation(t: Tables, p: Params) -> DataFrame:
    """Pairwise sensor correlations per machine, strongest volt-vibration first."""
    pairs = {
        "volt_vib_correlation": ("volt", "vibration"),
        "rotate_vib_correlation": ("rotate", "vibration"),
        "pressure_vib_correlation": ("pressure", "vibration"),
        "volt_pressure_correlation": ("volt", "pressure"),
    }
    return (
        t.telemetry.groupBy("machineID")
        .agg(*[safe_corr(F.col(a), F.col(b)).alias(n) for n, (a, b) in pairs.items()])
        .filter("volt_vib_correlation is not null")
        .orderBy(F.desc(F.abs("volt_vib_correlation")), "machineID")
    )


def threshold_exceedance(t: Tables, p: Params, hours: int = 24) -> DataFrame:
    """Readings of the last ``hours`` over the machine's own upper vibration limit."""
    limits = (
        t.telemetry.filter(_between(p.threshold_period))
        .groupBy("machineID")
        .agg((F.avg("vibration") + 3 * F.stddev("vibration")).alias("threshold"))
    )
    recent = t.telemetry.filter(
        F.col("datetime") >= t.as_of(p) - F.expr(f"interval {hours} hours")
    ).select("machineID", "datetime", "vibration")
    return (
        per_key_join(recent, limits)
        .filter("vibration > threshold")
        .groupBy("machineID")
        .agg(
            F.count("*").alias("exceedances"),
            F.max("vibration").alias("max_vibration"),
            F.max("threshold").alias("threshold"),
        )
        .orderBy(F.desc("exceedances"), "machineID")
    )


def health_mix(t: Tables, p: Params) -> DataFrame:
    """Share of machines per health level at their latest reading."""
    old = F.when(F.col("datetime") < ts(p.reference_before), F.col("vibration"))
    per = t.telemetry.groupBy("machineID").agg(
        F.avg(old).alias("m"),
        F.stddev(old).alias("s"),
        F.max_by("vibration", "datetime").alias("now"),
    )
    level = (
        F.when(F.col("now") > F.col("m") + 3 * F.col("s"), "Critical")
        .when(F.col("now") > F.col("m") + 2 * F.col("s"), "Warning")
        .otherwise("Healthy")
    )
    rank = (
        F.when(F.col("health_status") == "Critical", 1)
        .when(F.col("health_status") == "Warning", 2)
        .otherwise(3)
    )
    return (
        per.filter("m is not null")
        .groupBy(level.alias("health_status"))
        .agg(F.count("*").alias("machine_count"))
        .withColumn("pct", share(F.col("machine_count")))
        .orderBy(rank)
    )


def spike_detection(t: Tables, p: Params, factor: float = 2.0) -> DataFrame:
    """Last-day readings over ``factor`` times the machine's 30-day mean."""
    as_of = t.as_of(p)
    means = (
        t.telemetry.filter(F.col("datetime") >= as_of - _days(30))
        .groupBy("machineID")
        .agg(F.avg("vibration").alias("running_avg"))
    )
    recent = t.telemetry.filter(
        F.col("datetime") >= as_of - F.expr("interval 24 hours")
    ).select("machineID", "datetime", F.col("vibration").alias("current_vib"))
    ratio = F.col("current_vib") / F.nullif(F.col("running_avg"), F.lit(0.0))
    return (
        per_key_join(recent, means)
        .filter(F.col("current_vib") > factor * F.col("running_avg"))
        .withColumn("spike_ratio", ratio)
        .orderBy(F.desc("spike_ratio"), "machineID", "datetime")
    )


def operating_hours(t: Tables, p: Params) -> DataFrame:
    """Readings, first and last reading and complete days in service."""
    return (
        t.telemetry.groupBy("machineID")
        .agg(
            F.count("*").alias("total_hours_operated"),
            F.min("datetime").alias("first_recorded"),
            F.max("datetime").alias("last_recorded"),
        )
        .withColumn(
            "days_in_service", whole_days(F.col("last_recorded"), F.col("first_recorded"))
        )
        .orderBy(F.desc("total_hours_operated"), "machineID")
    )
