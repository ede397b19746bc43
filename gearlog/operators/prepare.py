"""Scaling, splits and sequences for model input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import exact_quantiles
from ..functions.spans import block_window, numbered, row_blocks
from ..functions.stats import one_row, per_key_join
from ..params import FEATURE_SENSORS, SEQUENCE_ROWS
from .labels import split_cut, temporal_split


def robust_scaled(
    df: DataFrame, columns=FEATURE_SENSORS, test_share: float = 0.2
) -> DataFrame:
    """Scale columns by median and quartile distance of the training rows.

    A column whose quartiles coincide is only centred.
    """
    split = temporal_split(df, test_share)
    long = split.filter("split = 'train'").unpivot([], list(columns), "sensor", "x")
    q = exact_quantiles(long, "x", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["sensor"])
    fit = one_row(
        q.agg(
            *[
                F.max(F.when(F.col("sensor") == c, F.struct("q25", "q50", "q75"))).alias(c)
                for c in columns
            ]
        )
    )
    scaled = {
        f"{c}_scaled": (F.col(c) - fit[c]["q50"])
        / F.coalesce(F.nullif(fit[c]["q75"] - fit[c]["q25"], F.lit(0.0)), F.lit(1.0))
        for c in columns
    }
    return split.withColumns(scaled)


def sequences(
    df: DataFrame, length: int = SEQUENCE_ROWS, step: int = 1, drop_last: bool = False
) -> DataFrame:
    """Windows of ``length`` consecutive readings with the label of the last one.

    One row per window: machine, start and end time, label and ``steps``, an
    array of sensor structs in time order. ``drop_last=True`` leaves out each
    machine's final window.
    """
    timed = df.withColumn("_us", F.unix_micros("timestamp"))
    named = numbered(timed, ["machine_id"], "_us")
    if drop_last:
        size = df.groupBy("machine_id").agg(F.count("*").alias("_size"))
        named = per_key_join(named, size, key="machine_id", spread="timestamp")
    frame = block_window(["machine_id"]).rowsBetween(1 - length, 0)
    step_row = F.struct("timestamp", *FEATURE_SENSORS)
    wide = row_blocks(named, length - 1).withColumn(
        "steps", F.collect_list(step_row).over(frame)
    )
    wanted = (
        F.col("_own")
        & (F.col("_rn") >= length)
        & ((F.col("_rn") - length) % step == 0)
    )
    if drop_last:
        wanted = wanted & (F.col("_rn") < F.col("_size"))
    return wide.filter(wanted).select(
        "machine_id",
        F.col("steps")[0]["timestamp"].alias("start_time"),
        F.col("timestamp").alias("end_time"),
        F.col("failure_label").alias("label"),
        "steps",
    )


def sequence_split(seqs: DataFrame, test_share: float = 0.2) -> DataFrame:
    """Train and test windows by the time they end."""
    train = F.unix_micros("end_time") < split_cut(seqs, test_share, "end_time")
    return seqs.withColumn("split", F.when(train, "train").otherwise("test"))
