"""Data quality checks and drift, as rows of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import cumulative
from ..functions.spans import DAY_US, HOUR_US, running, span_of
from ..functions.stats import one_row
from ..params import SENSORS

# Accepted column types, by name prefix.
REQUIRED = {
    "machineID": ("int", "bigint"),
    "datetime": ("timestamp",),
    "volt": ("float", "double"),
    "rotate": ("float", "double"),
    "pressure": ("float", "double"),
    "vibration": ("float", "double"),
}


def duplicate_count(df: DataFrame, keys=("machineID", "datetime")) -> Column:
    """Rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("c"))
    return counts.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0))).scalar()


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("_us", F.unix_micros("datetime"))


def out_of_order_count(df: DataFrame, arrival: str | None) -> Column:
    """Rows that arrive after a later reading of their machine.

    Needs a column that tells the order of arrival; without one nothing can be
    out of order.
    """
    if arrival is None:
        return F.lit(0).cast("long")
    seen = running(
        _timed(df).select("machineID", "_us", arrival),
        ["machineID"],
        [F.col(arrival)],
        {"_newest": ("max", F.col("_us"))},
        span_of(arrival, 1_000_000),
        inclusive=False,
    )
    return seen.agg(F.count_if(F.col("_us") < F.col("_newest"))).scalar()


def hourly_shares(df: DataFrame) -> DataFrame:
    """Share of gaps that are exactly one hour, for machines with over two readings."""
    gaps = running(
        _timed(df).select("machineID", "_us"),
        ["machineID"],
        [F.col("_us")],
        {"_prev": ("max", F.col("_us"))},
        span_of("_us", DAY_US),
        inclusive=False,
    ).withColumn("_gap", F.col("_us") - F.col("_prev"))
    return (
        gaps.groupBy("machineID")
        .agg(
            F.count("_gap").alias("gaps"),
            (F.count_if(F.col("_gap") == HOUR_US) / F.nullif(F.count("_gap"), F.lit(0))).alias(
                "hourly_share"
            ),
        )
        .filter("gaps >= 2")
    )


def _check(name: str, passed: Column, measured, bound: float, severity, subject=None) -> Column:
    """One result: what was measured, the bound it is held to, whom it is about."""
    return F.struct(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        (F.lit(measured) if isinstance(measured, int) else measured).cast("double").alias("measured"),
        F.lit(float(bound)).alias("bound"),
        (F.lit(subject) if subject is None or isinstance(subject, str) else subject).cast("string").alias("subject"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
    )


def validate_telemetry(
    df: DataFrame,
    machines: int = 100,
    min_complete: float = 0.95,
    sigmas: float = 5.0,
    max_outliers: float = 0.05,
    min_year: int = 2015,
    max_span_hours: int = 8760,
    min_hourly: float = 0.90,
    arrival: str | None = None,
) -> DataFrame:
    """Run all telemetry checks; one row per check."""
    types = dict(df.dtypes)
    missing = [c for c in REQUIRED if c not in types]
    wrong = [c for c, ok in REQUIRED.items() if c in types and not types[c].startswith(ok)]
    checks = [
        _check("required_columns", F.lit(not missing), len(missing), 0, "error", ",".join(missing) or None),
        _check("column_dtypes", F.lit(not wrong), len(wrong), 0, "error", ",".join(wrong) or None),
    ]
    if missing:
        return df.sparkSession.range(1).select(F.inline(F.array(*checks)))

    nulls = sum((F.avg(F.col(c).isNull().cast("double")) for c in df.columns), F.lit(0.0))
    stats = df.agg(
        (F.lit(1.0) - nulls / len(df.columns)).alias("complete"),
        F.countDistinct("machineID").alias("machines"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
        *[F.count_if(F.col(s) < 0).alias(f"{s}_neg") for s in SENSORS],
        *[F.avg(s).alias(f"{s}_mean") for s in SENSORS],
        *[F.stddev_samp(s).alias(f"{s}_std") for s in SENSORS],
    )
    fleet = one_row(stats)
    off = {
        s: F.abs(F.col(s) - F.col("_fleet")[f"{s}_mean"]) > sigmas * F.col("_fleet")[f"{s}_std"]
        for s in SENSORS
    }
    far = one_row(
        df.withColumn("_fleet", fleet).agg(
            *[
                F.avg(F.coalesce(off[s], F.lit(False)).cast("double")).alias(s)
                for s in SENSORS
            ]
        )
    )
    slow = F.when(F.col("hourly_share") < min_hourly, F.col("machineID"))
    hourly = one_row(
        hourly_shares(df).agg(
            F.min(slow).alias("machine"),
            F.min_by("hourly_share", slow).alias("share"),
        )
    )
    row = (
        stats.withColumn("dupes", duplicate_count(df))
        .withColumn("far", far)
        .withColumn("hourly", hourly)
        .withColumn("late", out_of_order_count(df, arrival))
    )

    dupes, late = F.col("dupes"), F.col("late")
    checks.insert(1, _check("no_duplicates", dupes == 0, dupes, 0, "error"))
    complete, found = F.col("complete"), F.col("machines")
    checks += [
        _check("completeness", complete >= min_complete, complete, min_complete, "error"),
        _check("machine_count", found == machines, found, machines, "error"),
    ]
    for s in SENSORS:
        neg, share = F.col(f"{s}_neg"), F.col("far")[s]
        checks.append(_check(f"positive_values_{s}", neg == 0, neg, 0, "warning", s))
        outliers = _check(f"outlier_check_{s}", share <= max_outliers, share, max_outliers, "warning", s)
        # a sensor that never varies has no outlier check
        checks.append(F.when(F.col(f"{s}_std") != 0, outliers))
    hours = (F.unix_micros("last") - F.unix_micros("first")) / F.lit(3.6e9)
    in_range = (F.year("first") >= min_year) & (hours <= max_span_hours)
    bad, worst = F.col("hourly")["machine"], F.col("hourly")["share"]
    gap = F.when(bad.isNull(), "info").otherwise("warning")
    checks += [
        _check("date_range", in_range, hours, max_span_hours, "info"),
        _check("hourly_frequency", bad.isNull(), worst, min_hourly, gap, bad),
        _check("monotonic_timestamps", late == 0, late, 0, "error"),
    ]
    return row.select(F.inline(F.array_compact(F.array(*checks))))


def loader_checks(df: DataFrame, machines: int = 100, arrival: str | None = None) -> DataFrame:
    """Eight yes/no checks of loaded telemetry."""
    any_null = F.lit(False)
    below = F.lit(False)
    for s in SENSORS:
        any_null = any_null | F.col(s).isNull()
        below = below | (F.col(s) < 0)
    row = (
        df.agg(
            F.count("*").alias("n"),
            F.count_if(F.col("datetime").isNull()).alias("no_ts"),
            F.count_if(F.col("machineID").isNull()).alias("no_id"),
            F.count_if(any_null).alias("nulls"),
            F.count_if(F.coalesce(below, F.lit(True))).alias("below"),
            F.countDistinct("machineID").alias("machines"),
        )
        .withColumn("dupes", duplicate_count(df))
        .withColumn("late", out_of_order_count(df, arrival))
    )
    checks = {
        "has_telemetry": F.col("n") > 0,
        "has_timestamps": F.col("no_ts") == 0,
        "has_machine_ids": F.col("no_id") == 0,
        "no_duplicate_rows": F.col("dupes") == 0,
        "timestamps_monotonic_per_machine": F.col("late") == 0,
        "sensors_no_null": F.col("nulls") == 0,
        "sensors_positive": F.col("below") == 0,
        "machine_count_correct": F.col("machines") == machines,
    }
    rows = [F.struct(F.lit(n).alias("check_name"), c.alias("passed")) for n, c in checks.items()]
    return row.select(F.inline(F.array(*rows)))


def kolmogorov_p(stat: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value: 2 * sum of (-1)^(k-1) exp(-2 k^2 x^2)."""
    x = F.sqrt(n.cast("double") * m / (n + m)) * stat
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * x * x),
    )
    # the series converges too slowly where the value is 1 to ten digits
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def ks_drift(
    reference: DataFrame,
    current: DataFrame,
    columns=SENSORS,
    alpha: float = 0.05,
    min_distance: float = 0.10,
    fraction: float | None = None,
) -> DataFrame:
    """Largest distance between two samples' distributions, per column.

    Exact over all rows: values are counted once per column, then both
    cumulative shares run over value ranges. ``fraction`` samples the inputs.
    """
    sides = []
    for df, now in ((reference, 0), (current, 1)):
        if fraction is not None:
            df = df.sample(fraction, seed=42)
        long = df.unpivot([], list(columns), "sensor", "value").filter("value is not null")
        sides.append(long.withColumn("_now", F.lit(now)))
    counted = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("sensor", "value")
        .agg(F.count_if(F.col("_now") == 0).alias("ref"), F.count_if(F.col("_now") == 1).alias("cur"))
    )
    shares = cumulative(counted, "value", ["ref", "cur"], ["sensor"])
    totals = shares.groupBy("sensor").agg(F.max("cum_ref").alias("n"), F.max("cum_cur").alias("m"))
    gap = F.abs(F.col("cum_ref") / F.col("n") - F.col("cum_cur") / F.col("m"))
    stat = F.col("ks_statistic")
    return (
        shares.join(totals, "sensor")
        .groupBy("sensor", "n", "m")
        .agg(F.max(gap).alias("ks_statistic"))
        .withColumn("p_value", kolmogorov_p(stat, F.col("n"), F.col("m")))
        .withColumn("drifted", (F.col("p_value") < alpha) & (stat > min_distance))
        .select(
            F.concat(F.lit("drift_check_"), "sensor").alias("check_name"),
            (~F.col("drifted")).alias("passed"),
            "ks_statistic",
            "p_value",
            F.when(F.col("drifted"), "warning").otherwise("info").alias("severity"),
        )
    )
