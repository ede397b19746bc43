"""Vantage-point trees against all distances."""

import math
import random

import numpy as np
import pytest

from gearlog.llm import vantage

SCHEMA = "vec_id long, embedding array<float>, shard int, kind string, vec long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k, wanted):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        ok.setdefault(i, set()).add(tuple(np.float32(v).tolist()))
    out = []
    for q in filter(wanted, ok):
        best = []
        for i, vs in ok.items():
            d = [math.dist(a, b) for a in ok[q] for b in vs if len(a) == len(b)]
            if i != q and d:
                best.append((min(d), i))
        out += [(q, r, i, d) for r, (d, i) in enumerate(sorted(best)[:k], 1)]
    return out


def check(got, want):
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [w[:3] for w in want]
    assert np.allclose([r["score"] for r in got], [w[3] for w in want], rtol=1e-12, atol=1e-12)


def clustered(seed, n, d=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    return [[x + rng.gauss(0, 0.2) for x in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("shards", [1, 5])
def test_factor_one_is_exact(spark, shards):
    rows = list(enumerate(clustered(1, 900)))
    rows += [(1000 + i, [0.5] * 8) for i in range(150)]  # equal vectors
    rows += [(2000, rows[0][1]), (2000, rows[0][1]), (2100, rows[3][1]), (2100, rows[4][1]), (2101, rows[3][1])]
    rows += [(2200, [1.0, 2.0]), (2201, [1.0, 2.5]), (2300, [3.0])]  # other lengths
    rows += [(2400, None), (2401, []), (2402, [0.0] * 8), (2403, [float("nan")] * 8), (2404, [float("inf")] * 8)]
    rows += [(2405, [None] + [1.0] * 7), (None, rows[5][1])]
    got = vantage.nearest(frame(spark, rows), factor=1.0, shards=shards).orderBy("query_id", "rank").collect()
    check(got, sorted(brute(rows, 10, lambda i: i % 100 == 0)))


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 1.0])]
    check(vantage.nearest(frame(spark, rows)).orderBy("query_id", "rank").collect(), sorted(brute(rows, 10, lambda i: i % 100 == 0)))
    assert vantage.nearest(frame(spark, rows[:1])).collect() == []
    assert vantage.nearest(frame(spark, [])).collect() == []


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(1, 101)]
    got = vantage.nearest(frame(spark, rows), shards=4).orderBy("query_id", "rank").collect()
    check(got, sorted(brute(rows, 10, lambda i: i % 100 == 0)))


def test_recall_of_the_production_factor():
    """Clusters of 64 components, as hard as the given table: at least 0.9."""
    vectors = np.array(clustered(3, 6000, 64), np.float32)
    ids = np.arange(len(vectors))
    tree = vantage.Tree(ids, vectors)
    queries = ids[::100]
    exact = tree.search(queries, vectors[queries], 10, 1.0)
    far = vantage.distances(vectors[queries].astype(float), vectors.astype(float))
    far[np.arange(len(queries)), queries] = np.inf
    assert (np.sort(far, axis=1)[:, :10] == exact.score).all()
    fast = tree.search(queries, vectors[queries], 10, vantage.FACTOR)
    hits = sum(len(set(a) & set(b)) for a, b in zip(exact.ids.tolist(), fast.ids.tolist()))
    assert hits >= 0.9 * 10 * len(queries)


def test_every_point_is_in_the_tree():
    tree = vantage.Tree(np.arange(500), np.ones((500, 3)), leaf=8)
    seen, todo = [], [tree.root]
    while todo:
        node = todo.pop()
        seen += node.rows.tolist() if node.rows is not None else [node.point]
        todo += node.halves
    assert sorted(seen) == list(range(500))
