"""Fleet-wide rankings and summaries.

Each log is aggregated before it is joined. ``fanout=True`` returns the numbers
of a direct join of the raw logs, worked out from the same aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import cumulative
from ..functions.stats import safe_corr
from ..params import Params
from ..sources.shared import shared_path
from ..sources.tables import Tables
from .cost import fleet_size


def _since(t: Tables, p: Params, days: int):
    return F.col("datetime") >= t.as_of(p) - F.expr(f"interval {days} days")


def _per_machine(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("machineID").agg(F.count("*").alias(name))


def risk_ranking(
    t: Tables, p: Params, fanout: bool = False, top: int | None = 20
) -> DataFrame:
    """Risk from failures, vibration against the fleet and overdue maintenance."""
    late = t.as_of(p) - F.expr(f"interval {p.overdue_days} days")
    fleet_mean = t.telemetry.agg(F.avg("vibration")).scalar()
    per = (
        t.telemetry.filter(_since(t, p, 30))
        .groupBy("machineID")
        .agg(F.avg("vibration").alias("avg_vibration"), F.count("*").alias("n"))
        .join(_per_machine(t.failures, "f"), "machineID", "left")
        .join(
            t.maint.groupBy("machineID").agg(
                F.max("datetime").alias("last"), F.count("*").alias("m")
            ),
            "machineID",
            "left",
        )
        .fillna(0, ["f", "m"])
    )
    fails = F.col("f") * F.col("n") * F.greatest("m", F.lit(1)) if fanout else F.col("f")
    scored = per.select(
        "machineID",
        fails.alias("historical_failures"),
        "avg_vibration",
        # a machine without any maintenance compares as null and scores 0
        F.when(F.col("last") < late, 1).otherwise(0).alias("overdue_maintenance"),
    ).withColumn(
        "risk_score",
        F.col("historical_failures") * 0.4
        + F.col("avg_vibration") / fleet_mean * 0.3
        + F.col("overdue_maintenance") * 0.3,
    )
    out = scored.orderBy(F.desc("risk_score"), "machineID")
    return out if top is None else out.limit(top)


def _hourly_vibration(t: Tables) -> DataFrame:
    return t.telemetry.groupBy(
        "machineID", F.date_trunc("hour", "datetime").alias("hour")
    ).agg(F.avg("vibration").alias("v"))


def machine_similarity(t: Tables, p: Params) -> DataFrame:
    """How closely each machine moves with the others that share a failure type.

    Per machine and failure type: the correlation of its hourly mean vibration
    with the mean of all its peers in the same hours. Peer means are hourly sums
    less the machine's own value, so the work grows with the readings and not
    with the number of machine pairs.
    """
    kinds = t.failures.select("machineID", "failure").distinct()
    series = _hourly_vibration(t).join(kinds, "machineID")
    hours = series.groupBy("failure", "hour").agg(
        F.sum("v").alias("s"), F.count("*").alias("n")
    )
    peers = kinds.groupBy("failure").agg((F.count("*") - 1).alias("peer_machines"))
    other = (F.col("s") - F.col("v")) / (F.col("n") - 1)
    return (
        series.join(hours.filter("n > 1"), ["failure", "hour"])
        .withColumn("other", other)
        .groupBy("machineID", "failure")
        .agg(
            F.count("*").alias("shared_hours"),
            safe_corr(F.col("v"), F.col("other")).alias("vibration_correlation"),
        )
        .join(peers, "failure")
        .join(t.machines.select("machineID", "model"), "machineID")
        .select(
            "machineID",
            "model",
            "failure",
            "peer_machines",
            "shared_hours",
            "vibration_correlation",
        )
        .orderBy(F.desc("vibration_correlation"), "machineID", "failure")
    )


def similar_machines(t: Tables, p: Params, machine: int) -> DataFrame:
    """One machine against every machine with a failure type in common."""
    kinds = t.failures.select("machineID", "failure").distinct()
    own = F.col("machineID") == machine
    shared = kinds.filter(own).select("failure")
    others = (
        kinds.filter(~own).join(shared, "failure", "left_semi").select("machineID").distinct()
    )
    hourly = _hourly_vibration(t)
    mine = hourly.filter(own).select("hour", F.col("v").alias("mine"))
    corr = (
        hourly.join(others, "machineID")
        .join(mine, "hour")
        .groupBy("machineID")
        .agg(safe_corr(F.col("v"), F.col("mine")).alias("vibration_correlation"))
    )
    model = t.machines.filter(own).select("model").scalar()
    return (
        others.join(corr, "machineID", "left")
        .join(t.machines.select("machineID", "model"), "machineID")
        .select(
            F.lit(machine).cast("long").alias("machine_a"),
            F.col("machineID").alias("machine_b"),
            model.alias("model_a"),
            F.col("model").alias("model_b"),
            "vibration_correlation",
        )
        .orderBy(F.desc("vibration_correlation"), "machine_b")
    )


def utilisation(t: Tables, p: Params) -> DataFrame:
    """Machines reporting per hour, and their share of the fleet."""
    pairs = t.telemetry.select(F.date_trunc("hour", "datetime").alias("hour"), "machineID")
    n = F.col("machines_reporting")
    return (
        pairs.distinct()
        .groupBy("hour")
        .agg(F.count("*").alias("machines_reporting"))
        .withColumn("pct_fleet_reporting", F.lit(100.0) * n / fleet_size(t, p))
        .orderBy("hour")
    )


def monthly_fleet_summary(t: Tables, p: Params, fanout: bool = False) -> DataFrame:
    """Per month: machines active, failing and erring, vibration mean and deviation.

    ``fanout=True`` gives the sample deviation over readings repeated for every
    failure and error of the month, which is slightly smaller.
    """
    month = F.date_trunc("month", "datetime").alias("month")
    active = t.telemetry.groupBy(month).agg(
        F.countDistinct("machineID").alias("active_machines"),
        F.avg("vibration").alias("avg_vibration"),
        F.stddev("vibration").alias("std_vibration"),
        F.count("vibration").alias("n"),
    )

    def events(df, name, rows):
        return df.groupBy(month).agg(
            F.countDistinct("machineID").alias(name), F.count("*").alias(rows)
        )

    out = (
        active.join(events(t.failures, "machines_with_failures", "f"), "month", "left")
        .join(events(t.errors, "machines_with_errors", "e"), "month", "left")
        .fillna(0)
    )
    std = F.col("std_vibration")
    if fanout:
        k = F.greatest("f", F.lit(1)).cast("double") * F.greatest("e", F.lit(1))
        std = std * F.sqrt(k * (F.col("n") - 1) / (k * F.col("n") - 1))
    return (
        out.withColumn("std_vibration", std)
        .withColumn("failure_rate", F.col("machines_with_failures") / fleet_size(t, p))
        .drop("n", "f", "e")
        .orderBy("month")
    )


def replacement_priority(
    t: Tables, p: Params, fanout: bool = False, top: int | None = 10
) -> DataFrame:
    """Replacement score from failures, age and recent vibration (60 days).

    ``fanout=True`` counts a machine's failures as 0 or 1.
    """
    recent = (
        t.telemetry.filter(_since(t, p, 60))
        .groupBy("machineID")
        .agg(F.avg("vibration").alias("recent_avg_vibration"))
    )
    fails = t.failures.groupBy("machineID").agg(
        F.count("*").alias("f"), F.max("datetime").alias("last_failure")
    )
    total = F.least("f", F.lit(1)) if fanout else F.col("f")
    out = (
        t.machines.join(recent, "machineID")
        .join(fails, "machineID", "left")
        .fillna(0, ["f"])
        .select(
            "machineID",
            "model",
            "age",
            total.alias("total_failures"),
            "recent_avg_vibration",
            "last_failure",
        )
        .withColumn(
            "replacement_priority_score",
            F.col("total_failures") * 0.5
            + F.col("age") * 0.3
            + F.col("recent_avg_vibration") / 50.0 * 0.2,
        )
        .orderBy(F.desc("replacement_priority_score"), "machineID")
    )
    return out if top is None else out.limit(top)


def fleet_kpis(t: Tables, p: Params, fanout: bool = False) -> DataFrame:
    """One row: machines, mean voltage and vibration (7 days), failing and erring (30).

    ``fanout=True`` weights the means by each machine's failures and errors.
    """
    month = _since(t, p, 30)
    per = (
        t.telemetry.filter(_since(t, p, 7))
        .groupBy("machineID")
        .agg(
            F.count("*").alias("n"),
            F.sum("volt").alias("sv"),
            F.sum("vibration").alias("sx"),
        )
        .join(_per_machine(t.failures.filter(month), "f"), "machineID", "left")
        .join(_per_machine(t.errors.filter(month), "e"), "machineID", "left")
        .fillna(0, ["f", "e"])
    )
    w = F.greatest("f", F.lit(1)) * F.greatest("e", F.lit(1)) if fanout else F.lit(1)
    rows = F.sum(F.col("n") * w)
    return per.agg(
        F.count("*").alias("total_machines"),
        (F.sum(F.col("sv") * w) / rows).alias("fleet_avg_voltage"),
        (F.sum(F.col("sx") * w) / rows).alias("fleet_avg_vibration"),
        F.count_if(F.col("f") > 0).alias("machines_with_failures_30d"),
        F.count_if(F.col("e") > 0).alias("machines_with_errors_30d"),
        (F.lit(100.0) * F.count_if(F.col("f") > 0) / F.count("*")).alias("pct_failed_30d"),
    )


def _rank_in_model(base: DataFrame, value: str, name: str) -> DataFrame:
    """Rank of each distinct value inside its model, the largest first: one more than
    the machines above it, counted over ranges of (model, value)."""
    counted = base.groupBy("_model", value).agg(F.count("*").alias("_n"))
    above = cumulative(counted, value, ["_n"], ["_model"], descending=True)
    return above.select("_model", value, (F.col("cum__n") - F.col("_n") + 1).alias(name))


def _steady_means(df: DataFrame, value: str, name: str) -> DataFrame:
    """Mean of ``value`` and rows ``n`` per machine, the same whatever order rows come in.

    Sums of doubles differ in their last digits with the order, which splits the ranks
    of machines with the same readings. Here a day is summed in order of its values and
    a machine in order of its days, so no list holds more than a machine's day.
    """

    def total(values) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    day = F.date_trunc("day", "datetime").alias("_day")
    days = df.groupBy("machineID", day).agg(
        F.count("*").alias("_rows"),
        F.count(value).alias("_n"),
        total(F.array_sort(F.collect_list(value))).alias("_sum"),
    )
    listed = F.array_sort(F.collect_list(F.struct("_day", "_sum")))
    return days.groupBy("machineID").agg(
        F.try_divide(total(F.transform(listed, lambda d: d["_sum"])), F.sum("_n")).alias(name),
        F.sum("_rows").alias("n"),
    )


def peer_ranking(t: Tables, p: Params, fanout: bool = False) -> DataFrame:
    """Rank of each machine inside its model by vibration and by failures.

    No window holds a model: ranks come from counts per distinct value. ``fanout=True``
    counts each failure once per reading. Machines with the same readings share a rank.
    """
    recent = _steady_means(t.telemetry.filter(_since(t, p, 30)), "vibration", "avg_vibration")
    fails = F.col("f") * F.col("n") if fanout else F.col("f")
    base = (
        t.machines.join(recent, "machineID")
        .join(_per_machine(t.failures, "f"), "machineID", "left")
        .fillna(0, ["f"])
        .select("model", "machineID", "age", "avg_vibration", fails.alias("failure_count"))
        .withColumn("_model", F.coalesce("model", F.lit("\x00")))
    )
    spark = base.sparkSession
    path = shared_path(spark, "peers")  # one row per machine, read four times
    base.write.parquet(path)
    base = spark.read.schema(base.schema).parquet(path)
    return (
        base.join(_rank_in_model(base, "avg_vibration", "vibration_rank_in_model"), ["_model", "avg_vibration"])
        .join(_rank_in_model(base, "failure_count", "failure_rank_in_model"), ["_model", "failure_count"])
        .select(
            "model",
            "machineID",
            "age",
            "avg_vibration",
            "failure_count",
            "vibration_rank_in_model",
            "failure_rank_in_model",
        )
        .orderBy("model", "vibration_rank_in_model", "machineID")
    )
