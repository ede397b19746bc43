"""Streaming operators on sensor readings.

Each function takes and returns streaming DataFrames with ``machineID``,
``datetime`` and the raw sensors, so the source can be files, Kafka or a rate
source; ``jobs`` starts them. They also run on batch frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.spans import span_of
from ..functions.stats import per_key_join
from ..params import SENSORS

WATERMARK = "1 hour"


def read_files(spark, folder: str, schema, files: str = "*", per_trigger: int | None = None):
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def read_kafka(spark, servers: str, topic: str, schema: str) -> DataFrame:
    """Readings as JSON values of a Kafka topic (needs Spark's Kafka package)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def _windowed(readings: DataFrame, window, late: str) -> DataFrame:
    stats = []
    for s in SENSORS:
        stats += [
            F.avg(s).alias(f"{s}_mean"),
            F.stddev_samp(s).alias(f"{s}_std"),
            F.min(s).alias(f"{s}_min"),
            F.max(s).alias(f"{s}_max"),
        ]
    out = (
        readings.withWatermark("datetime", late)
        .groupBy("machineID", window.alias("w"))
        .agg(F.count("*").alias("readings"), *stats)
    )
    return out.select(
        "machineID",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "readings",
        *[f"{s}_{k}" for s in SENSORS for k in ("mean", "std", "min", "max")],
    )


def tumbling(readings: DataFrame, width: str = "1 hour", late: str = WATERMARK) -> DataFrame:
    """Statistics per machine and window of ``width``."""
    return _windowed(readings, F.window("datetime", width), late)


def sliding(
    readings: DataFrame, width: str = "24 hours", step: str = "1 hour", late: str = WATERMARK
) -> DataFrame:
    """Statistics over overlapping windows: rolling features on a stream."""
    return _windowed(readings, F.window("datetime", width, step), late)


def panes(readings: DataFrame, step: str) -> DataFrame:
    """What windows need of each machine's readings in one ``step``, on a batch frame."""
    parts = []
    for s in SENSORS:
        parts += [
            F.count(s).alias(f"{s}_n"),
            F.avg(s).alias(f"{s}_mean"),
            (F.var_pop(s) * F.count(s)).alias(f"{s}_m2"),
            F.min(s).alias(f"{s}_min"),
            F.max(s).alias(f"{s}_max"),
        ]
    return (
        readings.groupBy("machineID", F.window("datetime", step).alias("w"))
        .agg(F.count("*").alias("readings"), F.unix_micros(F.max("datetime")).alias("newest"), *parts)
        .withColumn("pane", F.unix_micros("w.start"))
        .drop("w")
    )


def windows_of(panes: DataFrame, width: int, step: int) -> DataFrame:
    """Overlapping windows (``width`` and ``step`` in microseconds) from panes of ``step``.

    ``closed`` of a pane is the watermark it arrived under: it counts for no window that
    had ended by then. Panes are dealt by machine and span of ``7 * width``; each is
    listed under its windows only after that, so the lists are never shuffled. The number
    of tasks is fixed, since adaptive execution would join them by their size before.
    """
    tasks = 4 * int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["machineID", "_span", "_start"]
    whole = Window.partitionBy(*key)
    reach = F.sequence(span_of(F.col("pane") - (width - step), 7 * width), span_of("pane", 7 * width))
    starts = F.sequence(F.col("pane") - (width - step), F.col("pane"), F.lit(step))
    rows = (
        panes.withColumn("_span", F.explode(reach))
        .repartition(tasks, "machineID", "_span")
        .withColumn("_start", F.explode(starts))
        .filter(span_of("_start", 7 * width) == F.col("_span"))
        .filter(F.col("closed").isNull() | (F.col("_start") + width > F.col("closed")))
    )
    means, parts = {}, {"readings": F.sum("readings").over(whole)}
    for s in SENSORS:
        n, mean = F.col(f"{s}_n"), F.col(f"{s}_mean")
        means[f"_n_{s}"] = F.sum(n).over(whole)
        means[f"_mean_{s}"] = F.try_divide(F.sum(n * mean).over(whole), F.sum(n).over(whole))
        apart = mean - F.col(f"_mean_{s}")
        m2 = F.sum(F.col(f"{s}_m2") + n * apart * apart).over(whole)
        several = F.col(f"_n_{s}") > 1
        parts[f"{s}_std"] = F.when(several, F.sqrt(m2 / F.greatest(F.col(f"_n_{s}") - 1, F.lit(1))))
        parts[f"_low_{s}"] = F.min(f"{s}_min").over(whole)
        parts[f"_high_{s}"] = F.max(f"{s}_max").over(whole)
    first = F.row_number().over(whole.orderBy("pane"))
    return (
        rows.withColumns(means)
        .withColumns(parts | {"_nth": first})
        .filter("_nth = 1")
        .select(
            "machineID",
            F.timestamp_micros("_start").alias("window_start"),
            F.timestamp_micros(F.col("_start") + width).alias("window_end"),
            "readings",
            *[
                c
                for s in SENSORS
                for c in (
                    F.col(f"_mean_{s}").alias(f"{s}_mean"),
                    f"{s}_std",
                    F.col(f"_low_{s}").alias(f"{s}_min"),
                    F.col(f"_high_{s}").alias(f"{s}_max"),
                )
            ],
        )
    )


def downsample(readings: DataFrame, late: str = WATERMARK) -> DataFrame:
    """Daily statistics, for data kept longer than the readings themselves."""
    return tumbling(readings, "1 day", late)


def flag_odd(
    readings: DataFrame, baseline: DataFrame, sigmas: float = 3.0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """All readings, flagged where vibration is over ``sigmas`` deviations off the
    machine's baseline.

    ``baseline`` is a static table with ``machineID``, ``mean`` and ``std``; a machine
    without one, or without deviation, has no score and isn't flagged. ``keep`` names
    further columns of the readings to hand on.
    """
    z = (F.col("vibration") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    odd = F.coalesce(F.abs("zscore") > sigmas, F.lit(False))
    return (
        per_key_join(readings, baseline, how="left")
        .withColumn("zscore", z)
        .select(*keep, "machineID", "datetime", "vibration", "zscore", odd.alias("is_odd"))
    )


def prefilter(readings: DataFrame, baseline: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Only the readings that ``flag_odd`` flags."""
    return flag_odd(readings, baseline, sigmas).filter("is_odd").drop("is_odd")


def sessions(readings: DataFrame, gap: str = "2 hours", late: str = WATERMARK) -> DataFrame:
    """Runs of readings of a machine without a pause of ``gap``, once they are over."""
    return (
        readings.withWatermark("datetime", late)
        .groupBy("machineID", F.session_window("datetime", gap).alias("w"))
        .agg(F.count("*").alias("readings"), F.avg("vibration").alias("vibration_mean"))
        .select(
            "machineID",
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "readings",
            "vibration_mean",
        )
    )


def last_events(events: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Newest time of each kind of event per machine; the state is a row per machine.

    ``events`` has ``machineID``, ``datetime`` and ``kind``.
    """
    return events.groupBy("machineID").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("datetime"))).alias(f"last_{k}") for k in kinds]
    )


def quality(readings: DataFrame, late: str = WATERMARK) -> DataFrame:
    """Readings without repeats, flagged for missing and negative sensors."""
    missing, below = F.lit(False), F.lit(False)
    for s in SENSORS:
        missing = missing | F.col(s).isNull()
        below = below | F.coalesce(F.col(s) < 0, F.lit(False))
    return (
        readings.withWatermark("datetime", late)
        .dropDuplicatesWithinWatermark(["machineID", "datetime"])
        .select("machineID", "datetime", missing.alias("has_missing"), below.alias("is_negative"))
    )
