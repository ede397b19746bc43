"""Ordered computations per key that never put a whole key into one task.

A window over ``partitionBy(machine)`` sends all history of a machine to one
task, so one busy machine decides the run time. The helpers here cut each
history into spans and stay exact:

* ``running``: totals over everything up to a row. Each span starts from one
  seed row that carries the total of all earlier spans.
* ``with_halo``: time frames. Each row is copied into the spans whose frames
  can reach it, at most ``1 + frame / width`` copies.
* ``row_blocks``: row frames. Rows are numbered with ``running`` and cut into
  blocks of a fixed row count, with a halo of earlier rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
_REDUCE = {"sum": F.sum, "max": F.max, "min": F.min}


def micros(col: str | Column = "datetime") -> Column:
    return F.unix_micros(F.col(col) if isinstance(col, str) else col)


def span_of(us: str | Column, width: int) -> Column:
    """Index of the time span a microsecond stamp falls into."""
    us = F.col(us) if isinstance(us, str) else us
    return F.floor(us / F.lit(float(width))).cast("long")


def running(
    df: DataFrame,
    key: list[str],
    order: list[Column],
    aggs: dict[str, tuple[str, Column]],
    span: Column,
    reverse: bool = False,
    inclusive: bool = True,
    totals_of: DataFrame | None = None,
    ahead: dict[str, tuple[Column, int]] | None = None,
) -> DataFrame:
    """Add running aggregates over all rows of ``key`` up to each row.

    ``aggs`` maps a new column to ("sum" | "max" | "min", expression). ``order``
    must sort inside a span in the direction of travel; ``span`` must be
    monotone in that order. ``reverse`` travels from the last span to the first.

    The span totals are a second read of the input. Where ``df`` is itself the
    result of earlier passes, give as ``totals_of`` the narrow source with the
    same rows, so a chain of passes reads it once more each and not twice as
    often each.

    ``ahead`` maps a new column to (expression, k): its sum over all rows up to the
    end of the k-th span after the row's own. Spans have to be travelled forwards.
    """
    cols, ahead = df.columns, ahead or {}
    values = {"_span": span, **{f"_v_{n}": e for n, (_, e) in aggs.items()}}
    rows = df.withColumns(values)
    source = rows if totals_of is None else totals_of.withColumns(values)
    totals = source.groupBy(*key, "_span").agg(
        *[_REDUCE[op](f"_v_{n}").alias(f"_v_{n}") for n, (op, _) in aggs.items()],
        *[F.sum(e).alias(f"_a_{n}") for n, (e, _) in ahead.items()],
    )
    direction = F.desc("_span") if reverse else F.asc("_span")
    earlier = (
        Window.partitionBy(*key)
        .orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seeds = totals.select(
        *key,
        "_span",
        F.lit(0).alias("_seed"),
        *[
            _REDUCE[op](f"_v_{n}").over(earlier).alias(f"_v_{n}")
            for n, (op, _) in aggs.items()
        ],
        *[
            F.sum(f"_a_{n}")
            .over(Window.partitionBy(*key).orderBy("_span").rangeBetween(Window.unboundedPreceding, k))
            .alias(f"_a_{n}")
            for n, (_, k) in ahead.items()
        ],
    )
    both = rows.withColumn("_seed", F.lit(1)).unionByName(
        seeds, allowMissingColumns=True
    )
    upto = (
        Window.partitionBy(*key, "_span")
        .orderBy("_seed", *order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        both.withColumns(
            {n: _REDUCE[op](f"_v_{n}").over(upto) for n, (op, _) in aggs.items()}
            | {n: F.max(f"_a_{n}").over(upto) for n in ahead}
        )
        .filter("_seed = 1")
        .select(*cols, *aggs, *ahead)
    )


def with_halo(
    df: DataFrame, us: str, width: int, before: int = 0, after: int = 0
) -> DataFrame:
    """Copy rows into every span whose frames reach back ``before`` or on ``after``.

    Adds ``_span`` (partition windows by key and it) and ``_own``: keep only the
    owned rows after the windows are computed.
    """
    first = span_of(F.col(us) - F.lit(after), width)
    last = span_of(F.col(us) + F.lit(before), width)
    return df.withColumn("_span", F.explode(F.sequence(first, last))).withColumn(
        "_own", F.col("_span") == span_of(us, width)
    )


def numbered(
    df: DataFrame,
    key: list[str],
    us: str,
    width: int = DAY_US,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add ``_rn``, the row number of each row inside its key by time.

    ``base`` is a narrow source of the same rows (see ``running``).
    """
    return running(
        df,
        key,
        [F.col(us)],
        {"_rn": ("sum", F.lit(1).cast("long"))},
        span_of(us, width),
        totals_of=base,
    )


def row_blocks(df: DataFrame, halo: int, size: int = 4096) -> DataFrame:
    """Cut numbered rows into blocks of ``size`` rows, each with ``halo`` rows before.

    Windows over key and ``_block`` ordered by ``_rn`` are exact for owned rows
    as long as their row frames start at most ``halo`` rows back, and time frames
    where rows know in ``_reach`` the last row number that may look back to them.
    """
    seen = F.col("_rn") + halo
    if "_reach" in df.columns:
        seen = F.greatest(seen, "_reach")
    own = F.floor((F.col("_rn") - 1) / F.lit(float(size))).cast("long")
    last = F.floor((seen - 1) / F.lit(float(size))).cast("long")
    return df.withColumn("_block", F.explode(F.sequence(own, last))).withColumn(
        "_own", F.col("_block") == own
    )


def blocked(
    df: DataFrame,
    key: list[str],
    us: str,
    halo: int,
    columns: dict[str, Column],
    width: int = DAY_US,
    size: int = 4096,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add row-frame window ``columns`` that look at most ``halo`` rows back."""
    named = numbered(df, key, us, width, base)
    wide = row_blocks(named, halo, size).withColumns(columns)
    return wide.filter("_own").drop("_block", "_own")


def block_window(key: list[str]) -> Window:
    """Window for expressions given to ``blocked``."""
    return Window.partitionBy(*key, "_block").orderBy("_rn")


def beside(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Union of rows to annotate (``_kind`` 1) and marks that annotate them (0)."""
    return rows.withColumn("_kind", F.lit(1)).unionByName(
        marks.withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )


def active_marks(
    events: DataFrame, start: Column, end: Column, tags: dict[str, Column]
) -> DataFrame:
    """Turn each event into +1 at ``start`` and -1 at ``end`` (half-open span).

    ``tags`` are indicator columns (0/1); a running sum over the marks counts the
    events of each tag that are active at a moment.
    """
    key_and_tags = [F.col("machineID"), *[c.alias(n) for n, c in tags.items()]]
    on = events.select(start.alias("_us"), *key_and_tags)
    off = events.select(end.alias("_us"), *key_and_tags).withColumns(
        {n: -F.col(n) for n in tags}
    )
    return on.unionByName(off)


def next_time(
    rows: DataFrame,
    events: DataFrame,
    name: str,
    width: int = DAY_US,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: microsecond stamp of the first event strictly after each row.

    All inputs carry ``machineID`` and ``_us``.
    """
    marks = events.select("machineID", "_us")
    out = running(
        beside(rows, marks),
        ["machineID"],
        [F.desc("_us"), F.desc("_kind")],
        {name: ("min", F.when(F.col("_kind") == 0, F.col("_us")))},
        span_of("_us", width),
        reverse=True,
        totals_of=None if base is None else beside(base, marks),
    )
    return out.filter("_kind = 1").drop("_kind")


def last_time(
    rows: DataFrame,
    events: dict[str, DataFrame],
    width: int = DAY_US,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add one column per entry: stamp of its last event at or before each row."""
    marks = None
    for name, ev in events.items():
        m = ev.select("machineID", "_us", F.lit(name).alias("_tag"))
        marks = m if marks is None else marks.unionByName(m)
    out = running(
        beside(rows, marks),
        ["machineID"],
        [F.col("_us"), F.col("_kind")],
        {n: ("max", F.when(F.col("_tag") == n, F.col("_us"))) for n in events},
        span_of("_us", width),
        totals_of=None if base is None else beside(base, marks),
    )
    return out.filter("_kind = 1").drop("_kind", "_tag")
