"""Connected components of a large edge list, without collecting any of it.

Large-star and small-star steps (Kiveris et al., 2014) over written tables: each
step joins every node with the smallest node it knows, until every edge points at
the smallest node of its component. Each step is one grouping with partial
aggregation and one join, so a node with a third of all edges is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v -> the same components, closer to stars."""
    if large:  # larger neighbours point at the smallest of u and all its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours and u itself point at the smallest neighbour
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        pairs = edges.join(least, "u").select(F.explode(F.array("u", "v")).alias("x"), "m")
        out = pairs.select(F.col("x").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(scratch: Scratch, edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has (u, v), any order,
    and at most ``rows`` rows, if known."""
    plain = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = scratch.write(plain.filter("u <> v").distinct(), rows)
    mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while mark[0]:
        half = scratch.write(_star(now, large=True), mark[0])
        new = scratch.write(_star(half, large=False), mark[0])
        seen = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now, half)
        now = new
        if seen == mark:
            break
        mark = seen
    # every node points at its component's smallest node
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
