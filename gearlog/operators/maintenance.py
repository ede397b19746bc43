"""Maintenance queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import DAY_US, HOUR_US, active_marks, beside, next_time, running, span_of
from ..functions.stats import interval_join, is_reactive, share, whole_days
from ..params import Params
from ..sources.tables import Tables
from .failures import gaps, timed


def reactive_ratio(t: Tables, p: Params) -> DataFrame:
    """Unscheduled against scheduled maintenance."""
    kind = F.when(is_reactive(), "Reactive (Unscheduled)").otherwise("Planned (Scheduled)")
    return (
        t.maint.groupBy(kind.alias("maintenance_type"))
        .agg(F.count("*").alias("event_count"))
        .withColumn("pct", share(F.col("event_count")))
        .orderBy("maintenance_type")
    )


def error_outcomes(t: Tables, p: Params, hours: int = 168) -> DataFrame:
    """Every error with the failures that follow within ``hours`` and the next failure.

    One row per error, whatever follows it: counts are running sums over +1/-1 marks
    and the next failure is one reverse pass, so busy machines make no pairs.
    """
    errors = timed(t.errors)
    failures = timed(t.failures)
    marks = active_marks(failures, F.col("_us") - hours * HOUR_US, F.col("_us"), {"_n": F.lit(1)})
    counted = running(
        beside(errors, marks),
        ["machineID"],
        [F.col("_us"), F.col("_kind")],
        {"_active": ("sum", F.col("_n"))},
        span_of("_us", 7 * DAY_US),
    ).filter("_kind = 1")
    found = next_time(
        counted.drop("_kind", "_n"), failures, "_next", 7 * DAY_US, base=errors.select("machineID", "_us")
    )
    wait = (F.col("_next") - F.col("_us")) / F.lit(3.6e9)
    return found.select(
        "machineID",
        F.col("datetime").alias("error_time"),
        "errorID",
        F.coalesce("_active", F.lit(0)).alias("failures_within"),
        F.timestamp_micros("_next").alias("next_failure"),
        wait.alias("hours_to_failure"),
        F.coalesce(wait <= hours, F.lit(False)).alias("is_precursor"),
    )


def error_to_failure(t: Tables, p: Params, hours: int = 168, machine: int | None = None) -> DataFrame:
    """Every error with each failure that follows within ``hours``, for one machine or
    for all. The list has a row per pair; ``error_outcomes`` has one per error."""
    if machine is not None:
        mine = F.col("machineID") == machine
        t = replace(t, errors=t.errors.filter(mine), failures=t.failures.filter(mine))
    errors = t.errors.select(
        "machineID",
        F.unix_micros("datetime").alias("_from"),
        (F.unix_micros("datetime") + hours * HOUR_US).alias("_to"),
        F.col("datetime").alias("error_time"),
        "errorID",
    )
    failures = timed(t.failures).select(
        "machineID", "_us", F.col("datetime").alias("failure_time"), "failure"
    )
    return (
        interval_join(
            failures, errors, "machineID", "_us", "_from", "_to", 7 * DAY_US, low_open=True
        )
        .select(
            "machineID",
            "error_time",
            "failure_time",
            ((F.col("_us") - F.col("_from")) / F.lit(3.6e9)).alias("hours_error_to_failure"),
            "errorID",
            "failure",
        )
        .orderBy("hours_error_to_failure")
    )


def maintenance_effectiveness(t: Tables, p: Params) -> DataFrame:
    """Failures soon after each maintenance, and the first of them.

    Counts come from running sums and the next failure from one reverse pass, so
    no (maintenance, failure) pairs are built.
    """
    span = p.effect_days * DAY_US
    visits = timed(
        t.maint.groupBy("machineID", "datetime", "comp").agg(F.count("*").alias("_visits"))
    )
    failures = timed(t.failures)
    marks = active_marks(
        failures, F.col("_us") - span, F.col("_us"), {"_n": F.lit(1)}
    )
    counted = running(
        beside(visits, marks),
        ["machineID"],
        [F.col("_us"), F.col("_kind")],
        {"_active": ("sum", F.col("_n"))},
        span_of("_us", 7 * DAY_US),
    ).filter("_kind = 1")
    found = next_time(
        counted.filter("_active > 0").drop("_kind", "_n"),
        failures,
        "_next",
        7 * DAY_US,
        base=visits.select("machineID", "_us"),
    )
    return found.select(
        "machineID",
        F.col("datetime").alias("maintenance_date"),
        F.col("comp").alias("maintained_component"),
        # repeated visits at one moment join every failure once each
        (F.col("_active") * F.col("_visits")).alias("failures_within"),
        F.timestamp_micros("_next").alias("first_subsequent_failure"),
        ((F.col("_next") - F.col("_us")) / F.lit(3.6e9)).alias("hours_to_failure"),
    ).orderBy("hours_to_failure", "machineID", "maintenance_date", "maintained_component")


def replacement_cost(t: Tables, p: Params) -> DataFrame:
    """Replacements with total and mean estimated cost per component."""
    c = p.costs
    cost = F.when(is_reactive(), c.emergency_event).otherwise(c.planned_event)
    return (
        t.maint.groupBy("comp")
        .agg(
            F.count("*").alias("replacements"),
            F.sum(cost).alias("total_cost"),
            F.avg(cost).alias("avg_cost_per_replacement"),
        )
        .orderBy(F.desc("total_cost"), "comp")
    )


def maintenance_intervals(t: Tables, p: Params, top: int | None = 20) -> DataFrame:
    """Hours since the machine's previous maintenance, by machine and component."""
    out = (
        gaps(t.maint, ["machineID"], "comp")
        .filter("hours_since is not null")
        .groupBy("machineID", "comp")
        .agg(
            F.count("*").alias("maintenance_count"),
            F.avg("hours_since").alias("avg_hours_between"),
            F.min("hours_since").alias("min_hours_between"),
            F.max("hours_since").alias("max_hours_between"),
        )
        .orderBy("avg_hours_between", "machineID", "comp")
    )
    return out if top is None else out.limit(top)


def replacement_frequency(t: Tables, p: Params) -> DataFrame:
    """Replacements, machines and mean days between replacements per component."""
    first, last = F.min("datetime"), F.max("datetime")
    days = (F.unix_micros(last) - F.unix_micros(first)) / F.lit(8.64e10)
    return (
        t.maint.groupBy(F.col("comp").alias("component"))
        .agg(
            F.count("*").alias("replacement_count"),
            F.countDistinct("machineID").alias("machines_affected"),
            F.try_divide(days, F.count("*") - 1).alias("avg_days_between_replacements"),
        )
        .orderBy(F.desc("replacement_count"), "component")
    )


def overdue(t: Tables, p: Params) -> DataFrame:
    """Last maintenance per machine, for machines over the limit or never maintained."""
    as_of = t.as_of(p)
    last = t.maint.groupBy("machineID").agg(F.max("datetime").alias("last_maintenance"))
    late = F.col("last_maintenance") < as_of - F.expr(f"interval {p.overdue_days} days")
    return (
        t.machines.join(last, "machineID", "left")
        .filter(late | F.col("last_maintenance").isNull())
        .withColumn("days_since_last", whole_days(as_of, F.col("last_maintenance")))
    )


def overdue_maintenance(t: Tables, p: Params) -> DataFrame:
    """Machines overdue for maintenance, never maintained ones first."""
    return (
        overdue(t, p)
        .select("machineID", "last_maintenance", "days_since_last", "model", "age")
        .orderBy(F.desc_nulls_first("days_since_last"), "machineID")
    )


def monthly_downtime(t: Tables, p: Params) -> DataFrame:
    """Maintenance events and downtime hours per month."""
    c = p.costs
    hours = F.when(is_reactive(), c.emergency_hours).otherwise(c.planned_hours)
    return (
        t.maint.groupBy(F.date_trunc("month", "datetime").alias("month"))
        .agg(
            F.count("*").alias("maintenance_events"),
            (F.count("*") * c.planned_hours).alias("planned_downtime_hours"),
            F.sum(hours).alias("estimated_downtime_hours"),
        )
        .orderBy("month")
    )
