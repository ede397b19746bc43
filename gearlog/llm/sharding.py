"""Balanced shards: longest-processing-time scheduling of groups kept together.

Equal texts form a group. Sorted by size, groups go to the least loaded shard
through a heap. Groups above 1/``items`` of all bytes are scheduled one by one,
and there can be at most ``items`` of them; all smaller groups are first bundled
by hash into ``items`` bundles, which are scheduled like groups. So the heap sees
at most 2 * ``items`` entries at any table size, and no group is ever cut.

Cases: a null text counts 0 bytes plus 1 (as every row counts one more than its
bytes), its checksum is null, and all null texts are one group; an empty table
gives no rows; repeated rows are rows of their own with slots of their own; ties
in size are settled by the item's key, so results repeat exactly. Extra columns
are not read. A null id is kept.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

ITEMS = 16384
#: Rows per counting cell when slots are numbered.
CELL_ROWS = 20000


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Item -> shard for (item, size), longest first to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", items: int = ITEMS
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (0, 1, 2, ... in each shard)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.col(text_col)
    rows = scratch.write(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"")).alias("digest"),
        )
    )
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    # items are numbered: bundles 0..items-1 by hash, large groups after them
    large = [
        (bytes(r[0]), r[1])
        for r in groups.filter(F.col("size") * items > F.lit(total or 0)).orderBy("digest").collect()
    ]
    bundle = F.pmod(F.xxhash64("digest"), F.lit(items)).cast("int")
    names = spark.createDataFrame(
        [(d, items + i) for i, (d, _) in enumerate(large)], "digest binary, big int"
    )
    placed = rows.join(F.broadcast(names), "digest", "left").withColumn(  # at most `items` rows
        "item", F.coalesce("big", bundle)
    )
    sizes = [(r[0], r[1]) for r in placed.groupBy("item").agg(F.sum("size")).collect()]
    plan = spark.createDataFrame(list(schedule(sizes, shards).items()), "item int, shard int")
    cells = max(1, (n_rows or 0) // (CELL_ROWS * shards) + 1)
    key = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    cell = F.pmod(F.xxhash64(*key), F.lit(cells)).cast("int")
    sharded = placed.join(F.broadcast(plan), "item").withColumn("cell", cell)  # at most 2 * items rows
    counts = sharded.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy(*key))
    return (
        sharded.withColumn("_row", inside)
        .join(starts, ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("_row") - 1).alias("slot"))
    )


def sharded_digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The registered form: sizes are near equal (law ``bytes``)."""
    return shard_documents(docs, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
