"""Cost queries over failures and maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import is_reactive, share
from ..params import COMPONENTS, Params
from ..sources.tables import Tables


def _month(c: str = "datetime"):
    return F.date_trunc("month", c).alias("month")


def monthly_tco(t: Tables, p: Params, fanout: bool = False) -> DataFrame:
    """Emergency and planned repairs and their cost per month.

    ``fanout=True`` counts a maintenance once per failure of its machine in that
    month, as joining the two logs before counting does.
    """
    visits = t.maint.groupBy("machineID", _month()).agg(
        F.count_if(is_reactive()).alias("e"), F.count_if(~is_reactive()).alias("n")
    )
    if fanout:
        fails = t.failures.groupBy("machineID", _month()).agg(F.count("*").alias("w"))
        visits = visits.join(fails, ["machineID", "month"], "left").fillna(1, ["w"])
    else:
        visits = visits.withColumn("w", F.lit(1))
    c = p.costs
    e, n = F.col("emergency_repairs"), F.col("planned_repairs")
    return (
        visits.groupBy("month")
        .agg(
            F.sum(F.col("e") * F.col("w")).alias("emergency_repairs"),
            F.sum(F.col("n") * F.col("w")).alias("planned_repairs"),
        )
        .select(
            F.date_format("month", "yyyy-MM").alias("month"),
            e,
            n,
            (e * c.emergency_event).alias("emergency_cost"),
            (n * c.planned_event).alias("planned_cost"),
            (e * c.emergency_event + n * c.planned_event).alias("total_monthly_cost"),
        )
        .orderBy("month")
    )


def cost_per_failure_type(t: Tables, p: Params) -> DataFrame:
    """Repair, downtime and total cost per failing component."""
    c = p.costs
    n = F.col("occurrences")
    return (
        t.failures.groupBy("failure")
        .agg(F.count("*").alias("occurrences"))
        .withColumns(
            {
                "emergency_repair_cost": n * c.emergency,
                "downtime_cost": n * (c.emergency_hours * c.downtime_hour),
                "total_cost": n * c.emergency_event,
            }
        )
        .withColumn("pct_of_total_cost", share(F.col("total_cost")))
        .orderBy(F.desc("total_cost"), "failure")
    )


def strategy_roi(t: Tables, p: Params) -> DataFrame:
    """Run to failure against catching a share of failures early."""
    c = p.costs
    n = F.col("n").cast("double")
    caught, missed = n * p.detection_rate, n * (1 - p.detection_rate)
    reactive = n * c.emergency_event
    predictive = caught * c.planned_event + missed * c.emergency_event

    def row(name, events, cost, savings):
        return F.struct(
            F.lit(name).alias("strategy"),
            events.alias("failure_events"),
            cost.alias("annual_cost"),
            savings.alias("savings"),
        )

    rows = F.array(
        row("Reactive (Current)", n, reactive, F.lit(0.0)),
        row("Predictive (ML-Driven)", missed, predictive, reactive - predictive),
    )
    return (
        t.failures.agg(F.count("*").alias("n")).select(rows.alias("r")).select(F.inline("r"))
    )


def fleet_size(t: Tables, p: Params):
    """The configured fleet size, or the machines that report telemetry."""
    if p.fleet_size is not None:
        return F.lit(p.fleet_size).cast("long")
    return t.telemetry.agg(F.countDistinct("machineID")).scalar()


def sensor_investment(t: Tables, p: Params) -> DataFrame:
    """Yearly cost of sensors against the failures they would catch."""
    c = p.costs
    saving = p.detection_rate * (c.emergency_event - c.planned_event)
    yearly = (
        F.col("total_hardware_cost") / 3
        + F.col("annual_software_cost")
        + F.col("annual_personnel_cost")
    )
    return (
        t.failures.agg(F.count("*").alias("n"))
        .withColumn("n_machines", fleet_size(t, p))
        .withColumns(
            {
                "total_hardware_cost": F.col("n_machines") * c.hardware_per_machine,
                "annual_software_cost": F.lit(c.platform_per_year),
                "annual_personnel_cost": F.lit(c.personnel_per_year),
            }
        )
        .withColumns(
            {"annualized_cost": yearly, "gross_savings": F.col("n") * saving}
        )
        .withColumn("net_savings_year1", F.col("gross_savings") - F.col("annualized_cost"))
        .drop("n")
    )


def cumulative_downtime_cost(t: Tables, p: Params) -> DataFrame:
    """Downtime cost per month and its running total (one row per month)."""
    c = p.costs
    n = F.col("failures")
    return (
        t.failures.groupBy(_month())
        .agg(F.count("*").alias("failures"))
        .withColumns(
            {
                "downtime_hours": n * c.emergency_hours,
                "downtime_cost": n * (c.emergency_hours * c.downtime_hour),
            }
        )
        .withColumn(
            "cumulative_cost",
            F.sum("downtime_cost").over(Window.partitionBy().orderBy("month")),
        )
        .orderBy("month")
    )


def cost_per_machine(
    t: Tables, p: Params, fanout: bool = False, top: int | None = 15
) -> DataFrame:
    """Failure and maintenance cost of each failing machine, dearest first.

    ``fanout=True`` gives the counts a direct join of the two logs yields.
    """
    c = p.costs
    fails = t.failures.groupBy("machineID").agg(F.count("*").alias("f"))
    visits = t.maint.groupBy("machineID").agg(F.count("*").alias("m"))
    per = fails.join(visits, "machineID", "left").fillna(0, ["m"])
    if fanout:
        f, m = F.col("f") * F.greatest("m", F.lit(1)), F.col("f") * F.col("m")
    else:
        f, m = F.col("f"), F.col("m")
    out = (
        per.select("machineID", f.alias("failures"), m.alias("maintenance_events"))
        .withColumns(
            {
                "annual_failure_cost": F.col("failures") * c.emergency_event,
                "annual_planned_cost": F.col("maintenance_events") * c.planned,
            }
        )
        .withColumn(
            "total_annual_cost", F.col("annual_failure_cost") + F.col("annual_planned_cost")
        )
        .orderBy(F.desc("total_annual_cost"), "machineID")
    )
    return out if top is None else out.limit(top)


def conversion_savings(t: Tables, p: Params) -> DataFrame:
    """Savings from catching failures early, for every component of the model."""
    c = p.costs
    each = p.detection_rate * (c.emergency_event - c.planned_event)
    counts = t.failures.agg(
        *[F.count_if(F.col("failure") == comp).alias(comp) for comp in COMPONENTS]
    )
    return counts.unpivot([], list(COMPONENTS), "component", "failures").withColumn(
        "potential_savings", F.col("failures") * each
    )
