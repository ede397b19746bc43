"""Tables behind a fleet dashboard: scores, risk bands, cards, alerts, costs.

A health score maps the worst of a reading's voltage and vibration z-scores
(against the machine's last 30 days) to 1 (at the mean) .. 0 (five deviations
away), so the bands below 0.6 and 0.3 start at 2 and 3.5 deviations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import DAY_US, HOUR_US, numbered
from ..functions.stats import interval_join, is_reactive, per_key_join, share, zscore
from ..params import SENSORS, Params
from ..sources.tables import Tables
from . import failures as failure_queries
from . import health, maintenance

# Score bands, alternative probability bands and card limits.
HIGH_RISK, MEDIUM_RISK = 0.3, 0.6
PROBABILITY_BANDS = (0.2, 0.5, 0.7)
ZERO_SCORE_SIGMAS = 5.0
CARD_LIMITS = {
    "availability": 0.95,
    "mtbf_hours": 1200.0,
    "maintenance_cost_mtd": 200000.0,
    "active_alarms": 10.0,
    "machines_at_risk": 15.0,
}


def score_of(worst: Column) -> Column:
    """Health score of a z-score; a reading without one is healthy."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.coalesce(worst, F.lit(0.0)) / ZERO_SCORE_SIGMAS)


def risk_band(score: Column) -> Column:
    return F.when(score < HIGH_RISK, "High").when(score < MEDIUM_RISK, "Medium").otherwise("Low")


def probability_band(p: Column) -> Column:
    """Bands of a failure probability in place of a health score."""
    low, medium, high = PROBABILITY_BANDS
    return (
        F.when(p >= high, "High")
        .when(p >= medium, "Medium")
        .when(p >= low, "Low")
        .otherwise("Minimal")
    )


def machine_scores(t: Tables, p: Params) -> DataFrame:
    """Current health score of every machine that reported in the last 7 days."""
    return health.health_scores(t, p).select(
        "machineID", "last_reading", score_of(F.col("worst_zscore")).alias("health_score")
    )


def reading_scores(t: Tables, p: Params) -> DataFrame:
    """Health score of every reading of the last 30 days."""
    recent = t.telemetry.filter(
        F.col("datetime") >= t.as_of(p) - F.expr("interval 30 days")
    ).select("machineID", "datetime", "volt", "vibration")
    stats = recent.groupBy("machineID").agg(
        *[F.avg(s).alias(f"_m_{s}") for s in ("volt", "vibration")],
        *[F.stddev(s).alias(f"_s_{s}") for s in ("volt", "vibration")],
    )
    z = [
        F.abs(zscore(F.col(s), F.col(f"_m_{s}"), F.col(f"_s_{s}"))) for s in ("volt", "vibration")
    ]
    return per_key_join(recent, stats).select(
        "machineID", "datetime", score_of(F.greatest(*z)).alias("health_score")
    )


def risk_bands(t: Tables, p: Params) -> DataFrame:
    """Score and band of every machine."""
    return machine_scores(t, p).withColumn("risk_level", risk_band(F.col("health_score")))


def risk_counts(t: Tables, p: Params) -> DataFrame:
    """Machines per band and their share."""
    return (
        risk_bands(t, p)
        .groupBy("risk_level")
        .agg(F.count("*").alias("machines"))
        .withColumn("pct", share(F.col("machines")))
        .orderBy("risk_level")
    )


def at_risk_topk(t: Tables, p: Params, top: int | None = 10) -> DataFrame:
    """Machines with the lowest scores."""
    out = machine_scores(t, p).orderBy("health_score", "machineID")
    return (out if top is None else out.limit(top)).select("machineID", "health_score")


def machine_card(t: Tables, p: Params) -> DataFrame:
    """Score, band, days since the last failure and anomalies of 7 days per machine.

    An anomaly is a reading scored below the medium band.
    """
    as_of = t.as_of(p)
    week = F.col("datetime") >= as_of - F.expr("interval 7 days")
    odd = (
        reading_scores(t, p)
        .filter(week & (F.col("health_score") < MEDIUM_RISK))
        .groupBy("machineID")
        .agg(F.count("*").alias("sensor_anomalies_7d"))
    )
    last = t.failures.groupBy("machineID").agg(F.max("datetime").alias("_last"))
    days = (F.unix_micros(as_of) - F.unix_micros("_last")) / F.lit(8.64e10)
    return (
        risk_bands(t, p)
        .join(last, "machineID", "left")
        .join(odd, "machineID", "left")
        .fillna(0, ["sensor_anomalies_7d"])
        .select(
            "machineID",
            "health_score",
            "risk_level",
            days.alias("days_since_failure"),
            "sensor_anomalies_7d",
        )
        .orderBy("machineID")
    )


def health_pivot(t: Tables, p: Params) -> DataFrame:
    """Machines by days: mean score per cell; the days become columns."""
    return (
        reading_scores(t, p)
        .withColumn("day", F.date_format("datetime", "yyyy-MM-dd"))
        .groupBy("machineID")
        .pivot("day")
        .agg(F.avg("health_score"))
    )


def health_timeline(t: Tables, p: Params, per_machine: bool = False) -> DataFrame:
    """Mean score per day with its band, for the fleet or each machine."""
    key = ["machineID"] if per_machine else []
    return (
        reading_scores(t, p)
        .groupBy(*key, F.date_trunc("day", "datetime").alias("day"))
        .agg(F.avg("health_score").alias("health_score"))
        .withColumn("risk_level", risk_band(F.col("health_score")))
        .orderBy(*key, "day")
    )


def score_histogram(t: Tables, p: Params, bins: int = 30) -> DataFrame:
    """Machines per score bin and band; the last bin includes score 1."""
    bin_of = F.least(F.floor(F.col("health_score") * bins), F.lit(bins - 1)).cast("long")
    return (
        risk_bands(t, p)
        .groupBy(bin_of.alias("bin"), "risk_level")
        .agg(F.count("*").alias("machines"))
        .withColumn("bin_start", F.col("bin") / float(bins))
        .orderBy("bin", "risk_level")
    )


def machine_groups(t: Tables, p: Params) -> DataFrame:
    """Mean score per group of ten machine numbers, highest group first."""
    label = F.format_string("M-%03d", "machineID")
    number = F.regexp_extract(label, r"(\d+)", 1).cast("long")
    return (
        machine_scores(t, p)
        .groupBy((F.floor(number / 10) * 10).alias("machine_group"))
        .agg(F.avg("health_score").alias("health_score"))
        .orderBy(F.desc("machine_group"))
    )


def event_slice(t: Tables, machine: int, at: str, hours: int = 168) -> DataFrame:
    """One machine's readings in the hours up to a moment."""
    end = F.lit(at).cast("timestamp")
    start = end - F.expr(f"interval {hours} hours")
    return t.telemetry.filter(
        (F.col("machineID") == machine) & F.col("datetime").between(start, end)
    ).orderBy("datetime")


def event_slice_trends(
    t: Tables, p: Params, hours: int = 168, min_points: int = 10
) -> DataFrame:
    """Linear trend of each sensor in the hours before every failure.

    The trend runs over the position of a reading in the slice, 0 first; slices
    of at most ``min_points`` readings have none.
    """
    at = F.unix_micros("datetime")
    bands = t.failures.select("machineID", "datetime").distinct().select(
        "machineID",
        F.col("datetime").alias("failure_time"),
        (at - hours * HOUR_US).alias("_from"),
        at.alias("_to"),
    )
    readings = t.telemetry.select("machineID", F.unix_micros("datetime").alias("_us"), *SENSORS)
    named = numbered(readings, ["machineID"], "_us")
    near = interval_join(named, bands, "machineID", "_us", "_from", "_to", 7 * DAY_US)
    # row numbers of the machine stand in for positions: only the start differs
    long = near.unpivot(["machineID", "failure_time", "_rn"], list(SENSORS), "sensor", "x")
    start = F.avg("x") - F.regr_slope("x", "_rn") * (F.avg("_rn") - F.min("_rn"))
    return (
        long.groupBy("machineID", "failure_time", "sensor")
        .agg(
            F.count("x").alias("points"),
            F.regr_slope("x", "_rn").alias("slope"),
            start.alias("intercept"),
        )
        .filter(F.col("points") > min_points)
    )


def fleet_kpi_cards(t: Tables, p: Params) -> DataFrame:
    """Availability (30 days), time between failures, month-to-date cost, alarms, risk."""
    c = p.costs
    as_of = t.as_of(p)
    lost = t.maint.filter(F.col("datetime") >= as_of - F.expr("interval 30 days")).agg(
        F.coalesce(
            F.sum(F.when(is_reactive(), c.emergency_hours).otherwise(c.planned_hours)), F.lit(0.0)
        )
    )
    month = F.date_trunc("month", F.col("datetime")) == F.date_trunc("month", as_of)
    spent = t.maint.filter(month).agg(
        F.coalesce(
            F.sum(F.when(is_reactive(), c.emergency_event).otherwise(c.planned_event)), F.lit(0.0)
        )
    )
    mtbf = failure_queries.gaps(t.failures, ["machineID"], "failure").agg(F.avg("hours_since"))
    levels = health.health_scores(t, p).agg(
        F.count("*").alias("machines"),
        F.count_if(F.col("health_status") == "CRITICAL").cast("double").alias("alarms"),
        F.count_if(score_of(F.col("worst_zscore")) < MEDIUM_RISK).cast("double").alias("risk"),
    )
    row = levels.select(
        (F.lit(1.0) - lost.scalar() / (F.col("machines") * 720.0)).alias("availability"),
        mtbf.scalar().alias("mtbf_hours"),
        spent.scalar().alias("maintenance_cost_mtd"),
        F.col("alarms").alias("active_alarms"),
        F.col("risk").alias("machines_at_risk"),
    )
    limit = F.create_map(*[F.lit(x) for kv in CARD_LIMITS.items() for x in kv])[F.col("kpi")]
    v = F.col("value")
    status = (
        F.when(F.col("kpi").isin("availability", "mtbf_hours"), F.when(v > limit, "good").otherwise("warning"))
        .when(F.col("kpi") == "maintenance_cost_mtd", F.when(v < limit, "good").otherwise("warning"))
        .when(F.col("kpi") == "active_alarms", F.when(v > limit, "critical").otherwise("good"))
        .otherwise(F.when(v > limit, "critical").otherwise("warning"))
    )
    return row.unpivot([], list(CARD_LIMITS), "kpi", "value").withColumn("status", status)


def alerts(t: Tables, p: Params, drift_pct: float = 15.0) -> DataFrame:
    """Alert rows: deviating, exceeding, drifting and overdue machines."""
    now = health.health_scores(t, p)
    critical = now.filter("health_status = 'CRITICAL'").select(
        F.lit("critical").alias("severity"),
        "machineID",
        F.format_string("Reading %.1f deviations off its 30-day mean", "worst_zscore").alias(
            "message"
        ),
    )
    over = health.threshold_exceedance(t, p).select(
        F.lit("warning").alias("severity"),
        "machineID",
        F.format_string("%d vibration readings over the limit in 24 hours", "exceedances").alias(
            "message"
        ),
    )
    drift = (
        health.vibration_drift(t, p, top=None)
        .filter(F.col("pct_increase") > drift_pct)
        .select(
            F.lit("warning").alias("severity"),
            "machineID",
            F.format_string("Vibration %.1f%% above its baseline period", "pct_increase").alias(
                "message"
            ),
        )
    )
    late = (
        maintenance.overdue(t, p)
        .filter("last_maintenance is not null")
        .select(
            F.lit("info").alias("severity"),
            "machineID",
            F.format_string("Last maintenance %d days ago", "days_since_last").alias("message"),
        )
    )
    return critical.unionByName(over).unionByName(drift).unionByName(late)


def monthly_cost_by_strategy(t: Tables, p: Params) -> DataFrame:
    """Cost of each month's failures under the three strategies."""
    c = p.costs
    machines = t.telemetry.agg(F.countDistinct("machineID")).scalar()
    n = F.col("n").cast("double")
    months = t.failures.groupBy(F.date_trunc("month", "datetime").alias("month")).agg(
        F.count("*").alias("n")
    )
    d = p.detection_rate
    return months.select(
        "month",
        (n * c.emergency_event).alias("reactive"),
        (machines * c.planned_event + n * 0.3 * c.emergency_event).alias("preventive"),
        (n * (d * c.planned_event + (1 - d) * c.emergency_event)).alias("predictive"),
    ).orderBy("month")


def cost_by_component(t: Tables, p: Params) -> DataFrame:
    """Emergency cost of failures and planned cost of maintenance per component."""
    c = p.costs
    counts = t.failures.groupBy(F.col("failure").alias("component")).agg(
        F.count("*").alias("f")
    ).join(
        t.maint.groupBy(F.col("comp").alias("component")).agg(F.count("*").alias("m")),
        "component",
        "full",
    )
    return (
        counts.fillna(0, ["f", "m"])
        .select(
            "component",
            (F.col("f") * c.emergency_event).alias("emergency_cost"),
            (F.col("m") * c.planned_event).alias("planned_cost"),
        )
        .orderBy("component")
    )


def segments(t: Tables, p: Params) -> DataFrame:
    """Machines and yearly failures of each machine model."""
    per = t.failures.groupBy("machineID").agg(F.count("*").alias("n"))
    return (
        t.machines.join(per, "machineID", "left")
        .groupBy(F.col("model").alias("segment"))
        .agg(
            F.count("*").cast("double").alias("machines"),
            (F.coalesce(F.sum("n"), F.lit(0)) * (12.0 / p.months_observed)).alias("failures"),
        )
    )


def _yearly_costs(p: Params, recall: Column, precision: Column, years: int) -> dict[str, Column]:
    """Yearly cost per strategy from columns ``machines`` and ``failures``."""
    c = p.costs
    n, f = F.col("machines"), F.col("failures")
    visits = n * float(int(8760 / 720))
    caught = f * recall
    alarms = f * (F.lit(1.0) - precision) / precision * recall
    upkeep = n * c.hardware_per_machine / years + c.platform_per_year + c.personnel_per_year
    return {
        "reactive": f * c.emergency_event,
        "preventive": visits * c.planned_event + f * 0.3 * c.emergency_event,
        "predictive": caught * c.planned_event
        + (f - caught) * c.emergency_event
        + alarms * c.inspection
        + upkeep,
    }


def strategy_costs(
    seg: DataFrame, p: Params, recall: Column, precision: Column, years: int = 3
) -> DataFrame:
    """Cost and downtime of each strategy per segment (machines, failures a year)."""
    c = p.costs
    n, f = F.col("machines"), F.col("failures")
    cost = _yearly_costs(p, recall, precision, years)
    visits = n * float(int(8760 / 720))
    hours = {
        "reactive": f * c.emergency_hours,
        "preventive": visits * c.planned_hours + f * 0.3 * c.emergency_hours,
        "predictive": f * recall * c.planned_hours + f * (F.lit(1.0) - recall) * c.emergency_hours,
    }
    rows = [
        F.struct(
            F.lit(s).alias("strategy"),
            cost[s].alias("annual_cost"),
            (cost[s] * years).alias("total_cost"),
            hours[s].alias("downtime_hours_per_year"),
        )
        for s in cost
    ]
    return seg.select("segment", F.inline(F.array(*rows)))


def strategy_roi_summary(
    seg: DataFrame, p: Params, recall: Column, precision: Column, years: int = 3
) -> DataFrame:
    """Savings of the predictive strategy, return on its investment and payback."""
    c = p.costs
    cost = _yearly_costs(p, recall, precision, years)
    hardware = F.col("machines") * c.hardware_per_machine
    invested = hardware + (c.platform_per_year + c.personnel_per_year) * years
    saved = F.col("savings_vs_reactive")
    back = F.lit(12.0) * (hardware + c.platform_per_year) / (F.col("reactive") - F.col("predictive"))
    return (
        seg.withColumns(cost)
        .withColumns(
            {
                "savings_vs_reactive": (F.col("reactive") - F.col("predictive")) * years,
                "savings_vs_preventive": (F.col("preventive") - F.col("predictive")) * years,
            }
        )
        .select(
            "segment",
            "savings_vs_reactive",
            "savings_vs_preventive",
            (saved / invested * 100).alias("roi_percentage"),
            F.when(F.col("reactive") > F.col("predictive"), back).otherwise(0.0).alias(
                "payback_months"
            ),
        )
    )


def roi_grid(seg: DataFrame, p: Params, years: int = 3) -> DataFrame:
    """Return on investment for recall and precision .50 to .95 (100 cells a segment)."""
    steps = F.array(*[F.lit(round(0.5 + 0.05 * i, 2)) for i in range(10)])
    grid = seg.withColumn("recall", F.explode(steps)).withColumn("precision", F.explode(steps))
    c = p.costs
    cost = _yearly_costs(p, F.col("recall"), F.col("precision"), years)
    invested = (
        F.col("machines") * c.hardware_per_machine
        + (c.platform_per_year + c.personnel_per_year) * years
    )
    return grid.select(
        "segment",
        "recall",
        "precision",
        ((cost["reactive"] - cost["predictive"]) * years / invested * 100).alias("roi_percentage"),
    )
