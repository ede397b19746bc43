"""Roll-ups that merge: hourly states become days and months without the readings.

A state holds what statistics of a larger window need: counts, means, sums of squared
differences from the mean, extremes, and a quantile sketch for each sensor. Merging
adds the differences between the parts' means, so moments are those of the readings
themselves. The sketch is of bounded size and merges too; its ranks are off by about
1.7 % at most with ``SKETCH_K`` values a level, however many parts are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import SENSORS
from .readings import WATERMARK

SKETCH_K = 200


def partial_states(readings: DataFrame, width: str = "1 hour", late: str = WATERMARK) -> DataFrame:
    """One state per machine and window of ``width``, on a stream or a batch."""
    parts = []
    for s in SENSORS:
        parts += [
            F.count(s).alias(f"{s}_n"),
            F.avg(s).alias(f"{s}_mean"),
            (F.var_pop(s) * F.count(s)).alias(f"{s}_m2"),
            F.min(s).alias(f"{s}_min"),
            F.max(s).alias(f"{s}_max"),
            F.kll_sketch_agg_double(s, F.lit(SKETCH_K)).alias(f"{s}_sketch"),
        ]
    return (
        readings.withWatermark("datetime", late)
        .groupBy("machineID", F.window("datetime", width).alias("w"))
        .agg(F.count("*").alias("readings"), *parts)
        .withColumn("window_start", F.col("w.start"))
        .drop("w")
    )


def merged(states: DataFrame, unit: str) -> DataFrame:
    """States of a longer ``unit`` ("day", "month", ...) from shorter ones.

    The parts of one machine and unit are the only rows that meet: at most 24 hours a
    day, or 31 days a month when days are merged on.
    """
    start = F.date_trunc(unit, "window_start")
    rows = states.withColumn("window_start", start)
    key = ["machineID", "window_start"]
    whole = Window.partitionBy(*key)
    for s in SENSORS:
        total = F.sum(F.col(f"{s}_n") * F.col(f"{s}_mean")).over(whole)
        rows = rows.withColumn(f"_{s}", F.try_divide(total, F.sum(f"{s}_n").over(whole)))
    parts = []
    for s in SENSORS:
        apart = F.col(f"{s}_mean") - F.col(f"_{s}")
        parts += [
            F.sum(f"{s}_n").alias(f"{s}_n"),
            F.max(f"_{s}").alias(f"{s}_mean"),
            F.sum(F.col(f"{s}_m2") + F.col(f"{s}_n") * apart * apart).alias(f"{s}_m2"),
            F.min(f"{s}_min").alias(f"{s}_min"),
            F.max(f"{s}_max").alias(f"{s}_max"),
            F.kll_merge_agg_double(f"{s}_sketch").alias(f"{s}_sketch"),
        ]
    return rows.groupBy(*key).agg(F.sum("readings").alias("readings"), *parts)


def statistics(states: DataFrame) -> DataFrame:
    """Readings, and mean, deviation, least and greatest value of each sensor."""
    columns: list[Column | str] = ["machineID", "window_start", "readings"]
    for s in SENSORS:
        several = F.col(f"{s}_n") > 1
        columns += [
            f"{s}_mean",
            F.when(several, F.sqrt(F.col(f"{s}_m2") / (F.col(f"{s}_n") - 1))).alias(f"{s}_std"),
            f"{s}_min",
            f"{s}_max",
        ]
    return states.select(*columns)


def quantiles(states: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Approximate quantiles of each sensor, named ``<sensor>_<name>``."""
    return states.select(
        "machineID",
        "window_start",
        *[
            F.when(F.col(f"{s}_n") > 0, F.kll_sketch_get_quantile_double(f"{s}_sketch", F.lit(q))).alias(f"{s}_{n}")
            for s in SENSORS
            for n, q in probs.items()
        ],
    )
