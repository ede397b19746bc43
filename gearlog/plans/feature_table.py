"""From the five tables to the wide feature table, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import HOUR_US
from ..operators import features as f
from ..operators.labels import master_table
from ..operators.smoothing import block_rows, ewma
from ..params import FEATURE_SENSORS, ROLLING_HOURS, Params
from ..sources.tables import Tables, standardise


def add_features(df: DataFrame, maint: DataFrame, readings: DataFrame) -> DataFrame:
    """All engineered columns on top of the master table.

    Narrow steps come first, and rows are numbered once, in one of them; then the frame
    is dealt out once, while it is narrow, in blocks that hold all that row and time
    windows look back to. The steps that widen it follow inside the blocks, so no wide
    row is written to a shuffle. ``readings`` is the narrow source (machine, time,
    sensors) of the same rows.
    """
    base = readings.withColumn("_us", F.unix_micros("timestamp"))
    df = f.days_since_maintenance(df, maint, base=base)
    df = f.cumulative_deviation(df, base=base, number=True, reach=max(ROLLING_HOURS) * HOUR_US)
    df = f.baseline_zscore(df, base=base)
    df = f.laid_out(df, size=block_rows())
    df = ewma(df, base=readings)
    df = _row_windows(df)
    df = f.spectral_and_corr(df)
    df = f.rolling_statistics(df)
    return f.calendar_features(f.interactions(df))


def _row_windows(df: DataFrame) -> DataFrame:
    wide = f._with_trends(df)
    wide = f._with_errors(wide.withColumns(f._rate_columns()))
    return wide.sortWithinPartitions(*f.KEY, "_block", "_rn")  # as the windows left it


def build_features(t: Tables, p: Params, drop_null: bool = True) -> DataFrame:
    """The feature table; by default without rows that miss any column."""
    readings = standardise(t.telemetry).select("machine_id", "timestamp", *FEATURE_SENSORS)
    wide = add_features(master_table(t, p), t.maint, readings)
    return wide.na.drop() if drop_null else wide


# Columns of the feature table that describe a reading and are not model inputs.
NOT_FEATURES = (
    "machine_id",
    "timestamp",
    "failure_label",
    "failure_components",
    "failure_comp1",
    "failure_comp2",
    "failure_comp3",
    "failure_comp4",
    "time_to_failure_hours",
    *FEATURE_SENSORS,
)


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]
