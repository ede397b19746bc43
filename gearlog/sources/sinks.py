"""Writers for feature tables and small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMESTAMPS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature table as snappy parquet, partitioned by day so readers can prune.

    Rows of a day are spread over as many files as their size asks for: the
    rebalance hint lets adaptive execution split large days and join small ones.
    """
    dated = df.withColumn("date", F.to_date("timestamp"))
    (
        dated.hint("rebalance", "date")
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy("date")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A table as CSV with a header and timestamps to the microsecond."""
    df.write.mode(mode).option("header", True).option("timestampFormat", TIMESTAMPS).csv(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report of a few rows (such as a model comparison) as one CSV file."""
    write_csv(df.coalesce(1), path, mode)
