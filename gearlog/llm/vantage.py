"""Nearest vectors through vantage-point trees, one tree for each shard.

Vectors are dealt to shards by a hash of their id. A shard's task builds one tree over
its vectors: a node takes one of them as its vantage point, orders the others by their
distance to it and hands the nearer and the farther half on. Each half keeps the least
and greatest of these distances, so for a query at distance d from the vantage point,
nothing in a half is nearer than low - d or d - high (triangle inequality). A half is
left out where that bound, divided by ``factor``, is beyond the query's k-th best so
far. Factor one is the exact search; below one it leaves out more and may lose some.

A query first goes down to the leaf on its side of every node, which gives it a first
k-th best, then through the tree with pruning; all queries of a batch go together, so
every node is visited once for a batch. All shards answer, and the k best of all their
answers are the result.

Equal vectors: of those beyond the k + 1 smallest ids none can be among the k nearest
(each of the others is as near and has a smaller id), so only these enter the trees. A
vector that a third of all rows share is cut down before the shuffle, by a limit within
each task, then within ``SALTS`` parts of its rows.

Growth: there are about sqrt(n) / 32 shards of n vectors, so a shard's size and the
number of shards a query is sent to both grow with the square root of n, up to
``shard_rows`` vectors a shard. A task holds one shard and one batch of queries.

Cases: vectors that are null, empty, all zeros, or hold a null or non-finite component
take no part, nor do rows without an id; vectors meet those of the same length only;
repeated rows (same id and vector) are one; an id with several vectors searches with
all of them and is found by its nearest, and is no candidate of its own; fewer than k
candidates give them all; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Vectors in a leaf, queries searched together, most vectors of a shard, parts in
#: which the rows of one vector are limited first.
LEAF, BATCH, SHARD_ROWS, SALTS = 48, 512, 1 << 20, 64
#: Components compared at once.
CELLS = 1 << 21
#: Production parameter: measured recall is in the README.
FACTOR = 0.8


@dataclass
class Node:
    """A leaf (rows) or a vantage point with two halves and their distance ranges."""

    rows: np.ndarray | None = None
    point: int = -1
    halves: tuple = ()
    low: tuple = ()
    high: tuple = ()


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from differences."""
    step, out = max(1, CELLS // max(1, points.size)), []
    for i in range(0, len(queries), step):
        gap = queries[i : i + step, None, :] - points[None, :, :]
        out.append(np.sqrt(np.einsum("ijk,ijk->ij", gap, gap)))
    return np.concatenate(out) if len(out) != 1 else out[0]


@dataclass
class Best:
    """The k best (distance, id) of each query so far."""

    k: int
    score: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, n: int, k: int) -> Best:
        return cls(k, np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max))

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Offer candidates (a column each) to the queries ``at``."""
        score = np.concatenate([self.score[at], score], axis=1)
        ids = np.concatenate([self.ids[at], ids], axis=1)
        # ties go to the smaller id; of a point that is met again the nearest stays
        order = np.lexsort((score, ids), axis=1)
        score, ids = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
        score[:, 1:][ids[:, 1:] == ids[:, :-1]] = np.inf
        order = np.argsort(score, axis=1, kind="stable")[:, : self.k]
        self.score[at], self.ids[at] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


@dataclass
class Tree:
    """A vantage-point tree over (ids, vectors); both in a fixed order of rows."""

    ids: np.ndarray
    vectors: np.ndarray
    leaf: int = LEAF
    root: Node = field(init=False)

    def __post_init__(self):
        rng = np.random.default_rng(len(self.ids))
        self.root = Node(rows=np.arange(len(self.ids)))
        todo = [self.root]
        while todo:
            node = todo.pop()
            rows = node.rows
            if len(rows) <= self.leaf:
                continue
            at = int(rng.integers(0, len(rows)))
            node.point, node.rows = int(rows[at]), None
            rest = np.delete(rows, at)
            far = self._from(node.point, rest)
            order = np.argpartition(far, len(rest) // 2)
            cut = order[: len(rest) // 2], order[len(rest) // 2 :]
            node.halves = tuple(Node(rows=rest[c]) for c in cut)
            node.low = tuple(float(far[c].min()) for c in cut)
            node.high = tuple(float(far[c].max()) for c in cut)
            todo += node.halves

    def _from(self, point: int, rows: np.ndarray) -> np.ndarray:
        centre = self.vectors[point : point + 1].astype(np.float64)
        return np.concatenate(
            [distances(centre, self.vectors[rows[i : i + 8192]].astype(np.float64))[0] for i in range(0, len(rows), 8192)]
        )

    def _offer(self, best: Best, queries: np.ndarray, own: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distances of queries ``at`` to points ``rows``, offered to their best."""
        found = distances(queries[at], self.vectors[rows].astype(np.float64))
        ids = self.ids[rows]
        best.add(at, np.where(ids[None, :] == own[at][:, None], np.inf, found), np.broadcast_to(ids, found.shape))
        return found

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, factor: float) -> Best:
        """The k nearest points of each query whose id isn't the query's own."""
        best = Best.of(len(queries), k)
        queries = queries.astype(np.float64)
        todo = [(self.root, np.arange(len(queries)))]
        while todo:  # one way down: a first k-th best
            node, at = todo.pop()
            if node.rows is not None:
                self._offer(best, queries, own, at, node.rows)
                continue
            far = distances(queries[at], self.vectors[node.point : node.point + 1].astype(np.float64))[:, 0]
            inside = far <= (node.high[0] + node.low[1]) / 2
            todo += [(h, at[s]) for h, s in zip(node.halves, (inside, ~inside)) if s.any()]
        todo = [(self.root, np.arange(len(queries)), np.zeros(len(queries)))]
        while todo:
            node, at, bound = todo.pop()
            # the k-th best may have sunk since; rounding must not lose an equal one
            keep = bound <= factor * best.score[at, k - 1] * (1 + 1e-9)
            at = at[keep]
            if not len(at):
                continue
            if node.rows is not None:
                self._offer(best, queries, own, at, node.rows)
                continue
            far = self._offer(best, queries, own, at, np.array([node.point]))[:, 0]
            bounds = [np.maximum(lo - far, far - hi) for lo, hi in zip(node.low, node.high)]
            first = 0 if bounds[0].mean() <= bounds[1].mean() else 1
            for h in (1 - first, first):  # the last one in is the first one out
                todo.append((node.halves[h], at, np.maximum(bounds[h], bound[keep])))
        return best


def _usable(vec: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return F.forall(vec, finite) & F.exists(vec, lambda x: x != 0)


def shards_of(n: int, shard_rows: int = SHARD_ROWS) -> int:
    return max(1, math.ceil(math.sqrt(n) / 32), math.ceil(n / shard_rows))


def nearest(
    table: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    is_query: Column | None = None,
    factor: float = FACTOR,
    shards: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of every query.

    ``is_query`` is a condition on ``id_col``; by default the ids divisible by 100.
    """
    scratch = Scratch(table.sparkSession, "vantage")
    wanted = F.col("vec_id") % 100 == 0 if is_query is None else is_query
    named = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = named.filter("vec_id IS NOT NULL AND vec IS NOT NULL").filter(_usable(F.col("vec"))).distinct()
    points = usable
    for keys in (["vec", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))], ["vec"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        points = points.withColumn("_place", place).filter(F.col("_place") <= k + 1).drop("_place")
    points = scratch.write(points)
    if shards is None:
        shards = shards_of(points.count())
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    dealt = points.select(shard.alias("shard"), F.lit(0).alias("kind"), "vec_id", "vec")
    sent = usable.filter(wanted).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "vec"
    )
    # one shard's points come first, then its queries
    order = ["shard", F.size("vec"), "kind", "vec_id", "vec"]
    rows = dealt.unionByName(sent).repartition(shards, "shard").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, ids, vecs = None, None, [], []
        for shard, kind, own, block in _runs(batches):
            key = shard, block.shape[1]
            if key != now:
                now, tree, ids, vecs = key, None, [], []
            if kind == 0:
                ids.append(own)
                vecs.append(block)
                continue
            if tree is None and ids:
                tree = Tree(np.concatenate(ids), np.concatenate(vecs))
                ids, vecs = [], []
            for i in range(0, len(own) if tree else 0, BATCH):
                part = own[i : i + BATCH]
                best = tree.search(part, block[i : i + BATCH], k, factor)
                known = np.isfinite(best.score)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part, k)[known.ravel()], pa.int64()),
                        pa.array(best.ids[known], pa.int64()),
                        pa.array(best.score[known], pa.float64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    found = rows.mapInArrow(run, "query_id long, vec_id long, score double")
    # an id may have several vectors; one shuffle serves the grouping and the ranking
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(shard, kind, ids, vectors) of rows that belong together and follow on each other."""
    for batch in batches:
        shard, kind, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        lists = batch.column(3)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        begin = np.append(0, np.cumsum(sizes))
        new = np.ones(len(ids), bool)
        new[1:] = (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]) | (sizes[1:] != sizes[:-1])
        cuts = np.append(np.flatnonzero(new), len(ids)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(shard[a]), int(kind[a]), ids[a:b], flat[begin[a] : begin[b]].reshape(b - a, -1)
