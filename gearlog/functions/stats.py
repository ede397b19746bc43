"""Column expressions and joins shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import COMPONENTS
from .spans import span_of


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete days between two timestamps (towards zero)."""
    us = F.unix_micros(later) - F.unix_micros(earlier)
    return (us / F.lit(8.64e10)).cast("long")


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """Signed z-score, null where the deviation is zero."""
    return (x - mean) / F.nullif(std, F.lit(0.0))


def safe_corr(x: Column, y: Column, over=None) -> Column:
    """Correlation that is null, not an error, when either side is constant."""
    parts = [F.covar_samp(x, y), F.stddev_samp(x), F.stddev_samp(y)]
    # a row with either value missing counts for neither side
    parts[1] = F.stddev_samp(F.when(y.isNotNull(), x))
    parts[2] = F.stddev_samp(F.when(x.isNotNull(), y))
    cov, sx, sy = [p.over(over) for p in parts] if over is not None else parts
    return F.try_divide(cov, sx * sy)


def share(count: Column) -> Column:
    """Percent of the total; use only on a small aggregate."""
    return F.lit(100.0) * count / F.sum(count).over(Window.partitionBy())


def is_reactive(comp: str | Column = "comp") -> Column:
    return col(comp).isin(*COMPONENTS)


def age_band(age: Column, zero: str) -> Column:
    """Age groups; the labels are fixed values."""
    return (
        F.when(age == 0, zero)
        .when(age.between(1, 5), "1-5 years")
        .when(age.between(6, 10), "6-10 years")
        .when(age.between(11, 15), "11-15 years")
        .otherwise("15+ years")
    )


def per_key_join(
    facts: DataFrame,
    per_key: DataFrame,
    key: str = "machineID",
    salts: int = 16,
    spread: str = "datetime",
    how: str = "inner",
) -> DataFrame:
    """Join facts (inner or left) to a table with one row per key, splitting busy keys.

    The salt, taken from column ``spread``, divides each key over several tasks.
    Spark's size estimate leaves out the copies, and a table it takes for small
    would go through the driver ``salts`` times over, so the join is hinted to be a
    shuffled one; a task's share of the copies is hashed, and the facts aren't sorted.
    """
    copies = per_key.withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))),
    )
    return (
        facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
        .join(copies.hint("shuffle_hash"), [key, "_salt"], how)
        .drop("_salt")
    )


def one_row(df: DataFrame) -> Column:
    """A one-row aggregate as a scalar subquery; read its columns with ``[...]``."""
    return df.select(F.struct("*")).scalar()


def interval_join(
    points: DataFrame,
    bands: DataFrame,
    key: str,
    at: str,
    low: str,
    high: str,
    width: int,
    low_open: bool = False,
) -> DataFrame:
    """Join points to the bands [low, high] of the same key that contain them.

    Bands are listed under every time bucket they touch, so the shuffle key is
    (key, bucket) and a long history spreads over many tasks. A point has one
    bucket, so no pair appears twice. Columns of both sides must differ but for
    the key.
    """
    listed = bands.withColumn(
        "_bucket", F.explode(F.sequence(span_of(low, width), span_of(high, width)))
    )
    inside = (F.col(at) > F.col(low)) if low_open else (F.col(at) >= F.col(low))
    return (
        points.withColumn("_bucket", span_of(at, width))
        .join(listed, [key, "_bucket"])
        .filter(inside & (F.col(at) <= F.col(high)))
        .drop("_bucket")
    )
