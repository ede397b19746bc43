"""Data exploration and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import HOUR_US
from ..functions.stats import age_band, one_row, share
from ..params import SENSORS, Params
from ..sources.tables import Tables


def table_counts(t: Tables, p: Params) -> DataFrame:
    """Row count of each table, largest first."""
    named = {
        "telemetry": t.telemetry,
        "errors": t.errors,
        "maintenance": t.maint,
        "failures": t.failures,
        "machines": t.machines,
    }
    out = None
    for name, df in named.items():
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out.orderBy(F.desc("row_count"), "table_name")


def coverage(t: Tables, p: Params) -> DataFrame:
    """Date range, days and machines covered, readings per machine."""
    # distinct (machine, day) pairs first, so both distinct counts run on few rows
    pairs = t.telemetry.groupBy("machineID", F.date_trunc("day", "datetime").alias("day")).agg(
        F.count("*").alias("n"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
    )
    return pairs.agg(
        F.min("first").alias("first_reading"),
        F.max("last").alias("last_reading"),
        F.countDistinct("day").alias("days_covered"),
        F.countDistinct("machineID").alias("machines_with_data"),
        F.sum("n").alias("total_readings"),
        (F.sum("n") / F.countDistinct("machineID")).alias("avg_readings_per_machine"),
    )


def missing_hours(t: Tables, p: Params, end: str = "date", top: int | None = 20) -> DataFrame:
    """Machines whose reading count differs from one per hour.

    ``end='date'`` stops the expected hours at midnight of the last day, so a
    machine can have more readings than expected; ``end='ts'`` at its last reading.
    """
    first = F.date_trunc("day", F.min("datetime"))
    last = F.max("datetime")
    if end == "date":
        last = F.date_trunc("day", last)
    per = t.telemetry.groupBy("machineID").agg(
        F.count("*").alias("actual_readings"),
        (
            F.floor((F.unix_micros(last) - F.unix_micros(first)) / F.lit(float(HOUR_US)))
            + 1
        ).alias("expected_readings"),
    )
    missing = F.col("expected_readings") - F.col("actual_readings")
    out = (
        per.filter("expected_readings != actual_readings")
        .select(
            "machineID",
            "expected_readings",
            "actual_readings",
            missing.alias("missing_readings"),
            (F.lit(100.0) * missing / F.col("expected_readings")).alias("pct_missing"),
        )
        .orderBy(F.desc("missing_readings"), "machineID")
    )
    return out if top is None else out.limit(top)


def age_distribution(t: Tables, p: Params) -> DataFrame:
    """Machine count and share by age band, youngest band first."""
    bands = t.machines.groupBy(age_band(F.col("age"), "New (0 years)").alias("age_group"))
    counted = bands.agg(F.count("*").alias("machine_count"), F.min("age").alias("youngest"))
    return (
        counted.withColumn("pct", share(F.col("machine_count")))
        .orderBy("youngest")
        .select("age_group", "machine_count", "pct")
    )


def sensor_summary(t: Tables, p: Params) -> DataFrame:
    """Minimum, maximum, mean and deviation per sensor, in one scan."""
    aggs = []
    for s in SENSORS:
        aggs.append(
            F.struct(
                F.lit(s).alias("sensor"),
                F.min(s).alias("min_val"),
                F.max(s).alias("max_val"),
                F.avg(s).alias("avg_val"),
                F.stddev(s).alias("std_val"),
            )
        )
    return t.telemetry.agg(F.array(*aggs).alias("rows")).select(F.inline("rows"))


def model_distribution(t: Tables, p: Params) -> DataFrame:
    """Machines and mean age per model."""
    return (
        t.machines.groupBy("model")
        .agg(F.count("*").alias("machine_count"), F.avg("age").alias("avg_age_years"))
        .orderBy(F.desc("machine_count"), "model")
    )


def machines_per_model(t: Tables, p: Params) -> DataFrame:
    """Distinct machines per model."""
    return (
        t.machines.groupBy("model")
        .agg(F.countDistinct("machineID").alias("machine_count"))
        .orderBy(F.desc("machine_count"), "model")
    )


# Outlier labels per sensor.
OUTLIER_FLAGS = {
    "volt": ("volt_flag", "VOLTAGE_OUTLIER"),
    "rotate": ("rot_flag", "ROTATION_OUTLIER"),
    "pressure": ("pres_flag", "PRESSURE_OUTLIER"),
    "vibration": ("vib_flag", "VIBRATION_OUTLIER"),
}


def sigma_outliers(t: Tables, p: Params, sigmas: float = 3.0, top: int | None = 100) -> DataFrame:
    """Newest readings where a sensor is over ``sigmas`` deviations off the fleet mean."""
    fleet = one_row(
        t.telemetry.agg(
            *[F.avg(s).alias(f"{s}_mean") for s in SENSORS],
            *[F.stddev(s).alias(f"{s}_std") for s in SENSORS],
        )
    )
    far = {
        s: F.abs(F.col(s) - fleet[f"{s}_mean"]) > sigmas * fleet[f"{s}_std"]
        for s in SENSORS
    }
    flags = t.telemetry.select(
        "machineID",
        "datetime",
        *[F.when(far[s], label).alias(name) for s, (name, label) in OUTLIER_FLAGS.items()],
    )
    some = F.coalesce(*[name for name, _ in OUTLIER_FLAGS.values()]).isNotNull()
    out = flags.filter(some).orderBy(F.desc("datetime"), "machineID")
    return out if top is None else out.limit(top)
