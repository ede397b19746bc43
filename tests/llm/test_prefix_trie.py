"""The prefix trie against nested loops over all prefixes."""

import collections
import hashlib
import random
import zlib

import pytest

from gearlog.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, span long, k1 string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def brute(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            own[c].append(((turn is not None, turn or 0), role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = collections.defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        size = len(p[-1][1].encode()) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * size + sum(saved[c] for c in children[p])
        ends = ",".join(str(c) for c in sorted(members[p]) if len(whole[c]) == len(p))
        out.append(
            (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
             leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


def same(spark, rows):
    got = [tuple(r) for r in prefix_trie.prefix_trie(frame(spark, rows)).collect()]
    key = lambda r: (r[1], r[0])
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def conversations(seed, n, roles=("user", "bot"), words="ab"):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, roles[t % 2], rng.choice(words)))
    return rows


def test_cases(spark):
    rows = conversations(1, 60)
    rows += [(None, 0, "user", "a"), (100, None, None, None), (100, 1, "user", "é"), (100, 1, "bot", "é"), (100, 1, "bot", "b")]
    rows += [(-7, 0, "user", "a"), (-5, 0, "user", "c"), (-5, 1, "user", "c"), (-5, 1, "user", "c"), (2003, 5, "user", "")]
    same(spark, rows)


def test_hot_conversations(spark, monkeypatch):
    """One conversation with a third of all turns, one sequence that most end with,
    over spans of a few turns and ids."""
    monkeypatch.setattr(prefix_trie, "SPAN", 8)
    rows = conversations(2, 40, words="abcdefgh")
    rows += [(205, t, "user", f"long {t % 7}") for t in range(200)] + [(209, t, "user", f"long {t % 7}") for t in range(190)]
    rows += [(c, t, "user", "hello") for c in range(300, 380) for t in range(12)]
    same(spark, rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(1, 0, "user", "x")], [(3, 0, "user", "x"), (8, 0, "user", "x")]])
def test_small_tables(spark, rows):
    same(spark, rows)
