"""Failure-analysis queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import DAY_US, running, span_of
from ..functions.stats import age_band, interval_join, share, whole_days
from ..params import Params
from ..sources.tables import Tables


def timed(df: DataFrame) -> DataFrame:
    """Add the microsecond stamp the ordered helpers work on."""
    return df.withColumn("_us", F.unix_micros("datetime"))


def failures_by_component(t: Tables, p: Params) -> DataFrame:
    """Failures and share per component."""
    return (
        t.failures.groupBy("failure")
        .agg(F.count("*").alias("failure_count"))
        .withColumn("pct_of_total", share(F.col("failure_count")))
        .orderBy(F.desc("failure_count"), "failure")
    )


def monthly_failures(t: Tables, p: Params) -> DataFrame:
    """Failures per month and component."""
    return (
        t.failures.groupBy(F.date_trunc("month", "datetime").alias("month"), "failure")
        .agg(F.count("*").alias("failure_count"))
        .orderBy("month", "failure")
    )


def gaps(events: DataFrame, key: list[str], what: str) -> DataFrame:
    """Add ``hours_since``: hours since the previous event of the key, null for the first.

    Events at one moment follow each other by the name in column ``what``.
    """
    out = running(
        timed(events),
        key,
        [F.col("_us"), F.col(what)],
        {"_prev": ("max", F.col("_us"))},
        span_of("_us", 7 * DAY_US),
        inclusive=False,
    )
    return out.withColumn("hours_since", (F.col("_us") - F.col("_prev")) / F.lit(3.6e9))


def mtbf(t: Tables, p: Params, top: int | None = 15) -> DataFrame:
    """Mean, shortest and longest time between failures, shortest mean first."""
    out = (
        gaps(t.failures, ["machineID"], "failure")
        .filter("hours_since is not null")
        .groupBy("machineID")
        .agg(
            F.count("*").alias("total_failures"),
            F.avg("hours_since").alias("mtbf_hours"),
            (F.avg("hours_since") / 24).alias("mtbf_days"),
            F.min("hours_since").alias("min_time_between"),
            F.max("hours_since").alias("max_time_between"),
        )
        .orderBy("mtbf_hours", "machineID")
    )
    return out if top is None else out.limit(top)


def weibull_fit(t: Tables, p: Params) -> DataFrame:
    """Weibull shape and scale from a line through ln-ln ranks.

    Ranks count the failures of one machine, while the plotting position divides
    by all usable failures of the fleet.
    """
    f = timed(t.failures)
    ranked = running(
        f,
        ["machineID"],
        [F.col("_us"), F.col("failure")],
        {"rank": ("sum", F.lit(1).cast("long")), "first": ("min", F.col("_us"))},
        span_of("_us", 7 * DAY_US),
    ).select("rank", ((F.col("_us") - F.col("first")) / F.lit(3.6e9)).alias("hours"))
    usable = ranked.filter("hours > 0")
    n = usable.agg(F.count("*")).scalar()
    survival = F.lit(1.0) - F.col("rank") / (n + F.lit(1.0))
    points = usable.select(
        F.ln("hours").alias("x"), F.ln(F.ln(F.lit(1.0) / survival)).alias("y")
    )
    fit = points.agg(
        F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a")
    )
    return fit.select(
        F.col("b").alias("weibull_shape_beta"),
        F.exp(-F.col("a") / F.nullif(F.col("b"), F.lit(0.0))).alias(
            "weibull_scale_eta_hours"
        ),
    )


def _failures_per_machine(t: Tables) -> DataFrame:
    return t.failures.groupBy("machineID").agg(F.count("*").alias("n"))


def failure_rate_by_model(t: Tables, p: Params) -> DataFrame:
    """Failures per machine and per machine-month of each model."""
    per = t.machines.join(_failures_per_machine(t), "machineID", "left")
    rate = F.col("total_failures") / F.col("machine_count")
    return (
        per.groupBy("model")
        .agg(
            F.count("*").alias("machine_count"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_failures"),
        )
        .withColumns(
            {
                "failures_per_machine": rate,
                "failures_per_machine_per_month": rate / p.months_observed,
            }
        )
        .orderBy(F.desc("failures_per_machine"), "model")
    )


def failure_sequences(t: Tables, p: Params, top: int | None = 20) -> DataFrame:
    """Each failure with the one after it on the same machine, soonest first."""
    following = running(
        timed(t.failures),
        ["machineID"],
        [F.desc("_us"), F.desc("failure")],
        {"_next": ("min", F.struct("_us", "failure"))},
        span_of("_us", 7 * DAY_US),
        reverse=True,
        inclusive=False,
    )
    out = (
        following.filter("_next is not null")
        .select(
            "machineID",
            F.col("datetime").alias("failure_time"),
            F.col("failure").alias("current_failure"),
            F.col("_next.failure").alias("next_failure"),
            ((F.col("_next._us") - F.col("_us")) / F.lit(3.6e9)).alias("hours_until_next"),
        )
        .orderBy(
            "hours_until_next", "machineID", "failure_time", "current_failure", "next_failure"
        )
    )
    return out if top is None else out.limit(top)


def problem_machines(t: Tables, p: Params, top: int | None = 10) -> DataFrame:
    """Machines with most failures."""
    per = t.failures.groupBy("machineID").agg(
        F.count("*").alias("failure_count"),
        F.min("datetime").alias("first_failure"),
        F.max("datetime").alias("last_failure"),
    )
    most = per.join(t.machines, "machineID").orderBy(F.desc("failure_count"), "machineID")
    return (
        (most if top is None else most.limit(top))
        .select(
            "machineID",
            "model",
            "age",
            "failure_count",
            "first_failure",
            "last_failure",
            whole_days(F.col("last_failure"), F.col("first_failure")).alias(
                "days_between_first_last"
            ),
        )
    )


def failure_cascade(t: Tables, p: Params, within: bool = False, hours: int = 24) -> DataFrame:
    """Moments at which several components of a machine fail together.

    By default only failures at the same moment count. ``within=True`` counts the
    components that fail up to ``hours`` before or after each failure.
    """
    moments = t.failures.select("machineID", "datetime", "failure").distinct()
    names = "failed_components", "components_affected"
    if not within:
        listed = moments.groupBy("machineID", "datetime").agg(
            F.array_sort(F.collect_set("failure")).alias("c")
        )
    else:
        # failures near each other meet in buckets of the band's width
        f, band = timed(t.failures), hours * DAY_US // 24
        near = f.select(
            "machineID",
            (F.col("_us") - band).alias("_low"),
            (F.col("_us") + band).alias("_high"),
            F.col("failure").alias("_name"),
        ).distinct()
        points = timed(moments.select("machineID", "datetime").distinct())
        pairs = interval_join(points, near, "machineID", "_us", "_low", "_high", 2 * band + 1)
        listed = pairs.groupBy("machineID", "datetime").agg(
            F.array_sort(F.collect_set("_name")).alias("c")
        )
    return (
        listed.filter(F.size("c") > 1)
        .select(
            "machineID",
            F.col("datetime").alias("failure_time"),
            F.array_join("c", ", ").alias(names[0]),
            F.size("c").cast("long").alias(names[1]),
        )
        .orderBy(F.desc(names[1]), "machineID", "failure_time")
    )


def failures_by_age(t: Tables, p: Params, fanout: bool = False) -> DataFrame:
    """Failures by machine age. ``fanout=True`` counts a machine without failures as
    one event, as a row count over the left join does."""
    per = t.machines.join(_failures_per_machine(t), "machineID", "left")
    events = F.coalesce(F.col("n"), F.lit(1 if fanout else 0))
    return (
        per.groupBy(age_band(F.col("age"), "0 years").alias("age_group"))
        .agg(
            F.count("*").alias("total_machines"),
            F.count("n").alias("machines_with_failures"),
            F.sum(events).alias("total_failure_events"),
            F.min("age").alias("youngest"),
        )
        .withColumn(
            "failures_per_machine", F.col("total_failure_events") / F.col("total_machines")
        )
        .orderBy("youngest")
        .drop("youngest")
    )


def failures_by_weekday(t: Tables, p: Params) -> DataFrame:
    """Failures per weekday, 0 is Sunday."""
    day = (F.dayofweek("datetime") - 1).cast("long")
    return (
        t.failures.groupBy(day.alias("day_of_week"), F.date_format("datetime", "EEEE").alias("day_name"))
        .agg(F.count("*").alias("failure_count"))
        .orderBy("day_of_week")
    )
