"""Cumulative distributions and exact quantiles over large value columns.

An ordered running total over all values needs a sort in one task. Here values are
counted, and the counts are written once, in ranges of (group, value), one for each
task. What earlier ranges hold together is a sum over ranges, so every range continues
alone; a quantile's rank is looked up in that small table first and then in the one
range that holds it. The source is read once, whatever is asked of the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import shared_path


def written_counts(counted: DataFrame, value: str, group: list[str]) -> DataFrame:
    """``counted`` (one row per group and value) as a written table with ``_part``, the
    number of its range; ranges follow the order of (group, value)."""
    spark = counted.sparkSession
    ranged = counted.repartitionByRange(*group, value).withColumn("_part", F.spark_partition_id())
    path = shared_path(spark, "counts")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _before(parts: DataFrame, group: list[str], c: str, descending: bool = False) -> Column:
    """Sum of ``c`` over the earlier ranges of a group."""
    earlier = (
        Window.partitionBy(*group)
        .orderBy(F.desc("_part") if descending else F.asc("_part"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(c).over(earlier), F.lit(0).cast(parts.schema[c].dataType))


def cumulative(
    counted: DataFrame,
    value: str,
    sums: list[str],
    group: list[str],
    descending: bool = False,
) -> DataFrame:
    """Running totals ``cum_<c>`` of ``sums`` in value order, per group.

    ``counted`` has one row per group and value; groups aren't null.
    """
    table = written_counts(counted, value, group)
    parts = table.groupBy(*group, "_part").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = parts.select(
        *group, "_part", *[_before(parts, group, c, descending).alias(f"_off_{c}") for c in sums]
    )
    upto = (
        Window.partitionBy(*group, "_part")
        .orderBy(F.desc(value) if descending else F.asc(value))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        table.join(offsets, [*group, "_part"])
        .withColumns({f"cum_{c}": F.sum(c).over(upto) + F.col(f"_off_{c}") for c in sums})
        .drop("_part", *[f"_off_{c}" for c in sums])
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], group: list[str]
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group (few groups, many values)."""
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count("*").alias("_n"))
    )
    keys = group
    if not group:
        counted, keys = counted.withColumn("_all", F.lit(0)), ["_all"]
    table = written_counts(counted, value, keys)
    parts = table.groupBy(*keys, "_part").agg(F.sum("_n").alias("_in"))
    parts = parts.select(
        *keys,
        "_part",
        "_in",
        _before(parts, keys, "_in").alias("_off"),
        F.sum("_in").over(Window.partitionBy(*keys)).alias("_total"),
    )
    spot = {n: (F.col("_total") - 1) * F.lit(p) for n, p in probs.items()}
    ranks = F.array(
        *[
            F.struct(F.lit(f"{end}_{n}").alias("name"), fn(h).alias("rank"))
            for n, h in spot.items()
            for end, fn in (("lo", F.floor), ("hi", F.ceil))
        ]
    )
    spots = (
        parts.withColumn("_spot", F.explode(ranks))
        .filter((F.col("_spot.rank") >= F.col("_off")) & (F.col("_spot.rank") < F.col("_off") + F.col("_in")))
        .select(*keys, "_part", "_total", "_spot.name", (F.col("_spot.rank") - F.col("_off")).alias("_nth"))
    )
    upto = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        table.join(spots.select(*keys, "_part").distinct(), [*keys, "_part"], "left_semi")
        .withColumn("_cum", F.sum("_n").over(upto))
        .join(spots, [*keys, "_part"])
        .filter((F.col("_cum") > F.col("_nth")) & (F.col("_cum") - F.col("_n") <= F.col("_nth")))
        .groupBy(*keys)
        .agg(
            F.max("_total").alias("_total"),
            *[
                F.max(F.when(F.col("name") == f"{end}_{n}", F.col(value))).alias(f"_{end}_{n}")
                for n in probs
                for end in ("lo", "hi")
            ],
        )
    )
    return ends.select(
        *group,
        *[
            (F.col(f"_lo_{n}") + (h - F.floor(h)) * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
            for n, h in spot.items()
        ],
    )
