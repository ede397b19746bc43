"""Prefix trie of rebuilt conversations, by collapsing whole sequences first.

1. Turns get their place in a conversation and a 128-bit hash of (role, text); texts
   themselves are never shuffled.
2. Conversations are rebuilt from the first turns of another one and their own rest.
3. A sequence is known by its length and the exclusive-or of its turns' hashes, which
   hold their place; so are all its prefixes. Equal sequences become one, with a weight
   and a list of the conversations that end there.
4. A node is a distinct prefix. Everything a node needs is a sum, minimum or maximum
   over the distinct sequences through it, added up before the shuffle.
5. Sequences that are proper prefixes of others go by an anti-join; those left end at
   the leaves.

What a subtree saves: a node belongs to the sequence of its smallest member. The nodes
of one sequence are a run down to its end, so a subtree holds, of each sequence through
its top, the nodes from the top or from the first own one on. That is a sum over one
sequence, then one over sequences.

A conversation may hold a third of all turns: places and running hashes are worked out
in spans of ``SPAN`` turns, with what earlier spans bring added, and joins on a
conversation are joins on (conversation, span). A sequence may be that of a third of all
conversations: its list of ends is built in pieces of ``SPAN`` ids and hashed piece by
piece, in order, by one task that holds one piece.

Cases: turns are ordered by turn (null first), equal ones by role, then by the MD5 of
the text; a null role or text is empty; rows without conv_id take no part; repeated
rows are turns of their own; a conversation that is left without turns is a member of
the root; the parent of the root is null; an empty table gives no rows; extra columns
are not read. Hashes stand for turns (two 64-bit hashes over role and MD5): equality of
texts isn't checked again.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Turns of a span, and conversation ids of a piece of an end list.
SPAN = 1024
_FIRST = -(2**62)


def _span(position: Column) -> Column:
    return F.floor(position / SPAN).cast("long")


def _spans(size: Column) -> Column:
    """All spans of positions 0 to ``size``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), _span(size)))


def _before(totals: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """What all earlier spans of a key have together (rows: key, span)."""
    earlier = Window.partitionBy(key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, "span", value.over(earlier).alias(name))


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), two hashes of (role, text) and the bytes of the text."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("body"),
        F.octet_length(text).cast("long").alias("size"),
    )
    turns = turns.withColumn("span", F.coalesce(_span(F.col("turn")), F.lit(_FIRST)))
    inside = Window.partitionBy("conv_id", "span").orderBy(F.asc_nulls_first("turn"), "role", "body")
    counts = turns.groupBy("conv_id", "span").agg(F.count("*").alias("n"))
    offsets = _before(counts, "conv_id", F.sum("n"), "offset").filter("offset IS NOT NULL")
    return (
        turns.withColumn("pos", F.row_number().over(inside).cast("long"))
        .join(offsets, ["conv_id", "span"], "left")
        .select(
            "conv_id",
            (F.col("pos") + F.coalesce("offset", F.lit(0))).alias("pos"),
            F.xxhash64("role", "body").alias("h1"),
            F.xxhash64("body", F.lit(1), "role").alias("h2"),
            "size",
        )
    )


def rebuilt(turns: DataFrame, block: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns of every rebuilt conversation (columns as before), and (conv_id).

    Conversation c has the first h turns of conversation c - c % block, then its own
    ones after the first h; h is the CRC-32 of its decimal number modulo ``most``.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    plan = convs.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % block).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(bases, "base", "left").withColumn("shift", F.least("h", F.coalesce("base_n", F.lit(0))) - F.col("h"))
    rest = [c for c in turns.columns if c not in ("conv_id", "pos")]
    own = turns.withColumn("span", _span(F.col("pos"))).join(
        plan.select("conv_id", "h", "shift", _spans(F.col("n")).alias("span")), ["conv_id", "span"]
    )
    own = own.filter("pos > h").select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), *rest)
    heads = turns.filter(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    heads = heads.join(plan.select("conv_id", "base", "h"), "base").filter("pos <= h")
    return own.unionByName(heads.select("conv_id", "pos", *rest)), plan.select("conv_id")


_KEY = ("depth", "k1", "k2")


def _keyed(turns: DataFrame) -> DataFrame:
    """Hashes of turns that hold their place."""
    return turns.withColumn("e1", F.xxhash64("pos", "h1", "h2")).withColumn("e2", F.xxhash64("h2", "pos", "h1"))


def _end_lists(sequences: DataFrame) -> DataFrame:
    """ends_sha256 of every sequence: its conversations' numbers in order, by pieces."""
    piece = _span(F.col("conv_id")).alias("piece")
    pieces = sequences.groupBy(*_KEY, piece).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, sha256()
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(done)
        if now is not None:
            yield _batch([(*now, state.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[*_KEY, "ends_sha256"]
        )

    ordered = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece")
    return ordered.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _paths(turns: DataFrame, distinct: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence: rep, depth, its key and its parent's,
    bytes of the last turn, weight and length of the sequence."""
    spans = distinct.select(F.col("rep").alias("conv_id"), "weight", "length", _spans(F.col("length")).alias("span"))
    own = turns.withColumn("span", _span(F.col("pos"))).join(spans, ["conv_id", "span"])
    totals = own.filter(F.col("length") >= SPAN).groupBy("conv_id", "span")
    totals = totals.agg(F.bit_xor("e1").alias("t1"), F.bit_xor("e2").alias("t2"))
    one = _before(totals, "conv_id", F.bit_xor("t1"), "b1")
    two = _before(totals, "conv_id", F.bit_xor("t2"), "b2")
    carried = one.join(two, ["conv_id", "span"]).filter("b1 IS NOT NULL")
    so_far = Window.partitionBy("conv_id", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = (
        own.withColumn("r1", F.bit_xor("e1").over(so_far))
        .withColumn("r2", F.bit_xor("e2").over(so_far))
        .join(carried, ["conv_id", "span"], "left")
    )
    k1 = F.col("r1").bitwiseXOR(F.coalesce("b1", F.lit(0).cast("long")))
    k2 = F.col("r2").bitwiseXOR(F.coalesce("b2", F.lit(0).cast("long")))
    zero = F.lit(0).cast("long")
    roots = distinct.select(
        "rep", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"),
        zero.alias("size"), "weight", "length",
    )
    return roots.unionByName(
        own.select(
            F.col("conv_id").alias("rep"),
            F.col("pos").alias("depth"),
            k1.alias("k1"),
            k2.alias("k2"),
            k1.bitwiseXOR(F.col("e1")).alias("p1"),
            k2.bitwiseXOR(F.col("e2")).alias("p2"),
            "size",
            "weight",
            "length",
        )
    )


def _saved_from(nodes: DataFrame) -> DataFrame:
    """Nodes with what the nodes of the same owner save from them downwards (own) and
    whether they are the owner's first."""
    mine = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
    mine = mine.withColumn("span", _span(F.col("depth")))
    totals = mine.groupBy("conv_id", "span").agg(F.sum("saved").alias("total"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    later = totals.select("conv_id", "span", F.sum("total").over(later).alias("later")).filter("later IS NOT NULL")
    below = Window.partitionBy("conv_id", "span").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        mine.withColumn("own", F.sum("saved").over(below))
        .join(later, ["conv_id", "span"], "left")
        .withColumn("own", F.col("own") + F.coalesce("later", F.lit(0).cast("long")))
        .drop("saved", "later", "span")
    )


def prefix_trie(conversations: DataFrame, block: int = 5, most: int = 9) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    places = scratch.write(numbered(conversations))
    turns, convs = rebuilt(places, block, most)
    turns = scratch.write(_keyed(turns).drop("h1", "h2"))
    zero = F.lit(0).cast("long")
    nothing = convs.select("conv_id", zero.alias("pos"), zero.alias("e1"), zero.alias("e2"))
    sequences = scratch.write(  # one row for each conversation
        turns.select("conv_id", "pos", "e1", "e2")
        .unionByName(nothing)
        .groupBy("conv_id")
        .agg(F.max("pos").alias("depth"), F.bit_xor("e1").alias("k1"), F.bit_xor("e2").alias("k2"))
    )
    distinct = sequences.groupBy(*_KEY).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"))
    distinct = scratch.write(distinct.withColumnRenamed("depth", "length"))
    paths = scratch.write(_paths(turns, distinct))
    through = paths.groupBy(*_KEY).agg(
        F.min("rep").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.max("size").alias("size"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max(F.col("length") > F.col("depth")).alias("longer"),
    )
    nodes = scratch.write(_saved_from(through))
    owners = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("first"),
        F.max_by("own", -F.col("depth")).alias("total"),
        F.min_by(F.struct("p1", "p2"), "depth").alias("above"),
    )
    owners = scratch.write(owners.withColumnRenamed("conv_id", "rep"))
    ends = distinct.select("rep", F.col("length").alias("depth"), "k1", "k2")
    leaves = ends.join(nodes.filter("longer").select(*_KEY), list(_KEY), "left_anti").select("rep", F.lit(1).alias("leaf"))
    known = (  # for each distinct sequence: is it a leaf, and what its own nodes save
        distinct.select("rep", "length")
        .join(leaves, "rep", "left")
        .join(owners.select("rep", "first", "total"), "rep", "left")
        .select("rep", "leaf", "first", "total", _spans(F.col("length")).alias("span"))
    )
    passed = (
        paths.select("rep", *_KEY, _span(F.col("depth")).alias("span"))
        .join(known, ["rep", "span"])
        .groupBy(*_KEY)
        .agg(
            F.count("leaf").alias("n_leaves"),
            # sequences without own nodes save nothing
            F.sum(F.when(F.col("depth") < F.col("first"), F.col("total"))).alias("below"),
        )
    )
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count("*").alias("n_children"))
    )
    # an owner's first node hangs on another owner's; all its others on its own
    tops = owners.filter("first > 0").select(
        F.col("rep").alias("conv_id"),
        F.col("first").alias("depth"),
        (F.col("first") - 1).alias("_d"),
        F.col("above.p1").alias("_1"),
        F.col("above.p2").alias("_2"),
    )
    above = nodes.filter("longer").select(
        F.col("depth").alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), F.col("conv_id").alias("above")
    )
    tops = scratch.write(tops.join(above, ["_d", "_1", "_2"]).select("conv_id", "depth", "above"))
    key = list(_KEY)
    return (
        nodes.join(passed, key)
        .join(children, key, "left")
        .join(_end_lists(sequences), key, "left")
        .join(tops, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            (F.col("own") + F.coalesce("below", F.lit(0))).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


#: The same nodes over DuckDB's lists; the CRC-32 is worked out bit by bit.
SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM turns GROUP BY conv_id
), plan AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS base,
         xor(4294967295::BIGINT, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda s, b: list_reduce(
             list_concat([xor(s, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) % 9 AS h
  FROM own
), seqs AS (
  SELECT p.conv_id, list_concat(coalesce(b.turns, [])[1:p.h], p.turns[p.h + 1:]) AS seq
  FROM plan p LEFT JOIN own b ON b.conv_id = p.base
), nodes AS (
  SELECT d AS depth, seq[1:d] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(CASE WHEN d > 0 THEN strlen(seq[d].text) ELSE 0 END) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(seq) = d), '')) AS ends_sha256
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM seqs)
  GROUP BY ALL
), inner_nodes AS (
  SELECT DISTINCT depth - 1 AS depth, prefix[1:depth - 1] AS prefix FROM nodes WHERE depth > 0
), up AS (
  SELECT d AS depth, prefix[1:d] AS prefix, sum((n_convs - 1) * size) AS saved_tokens,
         count(*) FILTER (leaf) AS n_leaves, count(*) FILTER (node_depth = d + 1) AS n_children
  FROM (SELECT n.prefix, n.depth AS node_depth, n.n_convs, n.size, i.depth IS NULL AS leaf,
               unnest(range(0, n.depth + 1)) AS d
        FROM nodes n LEFT JOIN inner_nodes i ON i.depth = n.depth AND i.prefix = n.prefix)
  GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, u.n_children, u.n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN up u ON u.depth = n.depth AND u.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""
