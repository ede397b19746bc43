"""Operators over the whole corpus: shards, line chunks, licences, leaks, near copies."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearlog.llm import components, decontaminate, licenses, line_dedup, near_dups, sharding
from gearlog.llm.common import Scratch
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "k", 1) for d, t in rows], SCHEMA)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


# --- shards --------------------------------------------------------------------


def test_shards(spark):
    rng = random.Random(2)
    texts = ["big " * 4000, None, "", "é" * 10] + [" ".join(words(rng, rng.randrange(1, 60))) for _ in range(300)]
    rows = [(i, texts[i % len(texts)]) for i in range(700)] + [(5, texts[5]), (None, "x")]
    got = sharding.sharded_digest(frame(spark, rows), 4).collect()
    assert len(got) == len(rows)
    of, slots, load = {}, collections.defaultdict(list), collections.Counter()
    for r in got:
        text = dict(rows).get(r["doc_id"])
        assert r["size"] == len((text or "").encode()) + 1
        assert r["text_crc32"] == (None if text is None else zlib.crc32(text.encode()))
        assert of.setdefault(text, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded_digest(frame(spark, []), 4).count() == 0


def test_longest_first_is_balanced():
    rng = random.Random(4)
    sizes = [(i, int(rng.paretovariate(1.2) * 100)) for i in range(2000)]
    plan = sharding.schedule(sizes, 8)
    load = collections.Counter()
    for i, s in sizes:
        load[plan[i]] += s
    fair = max(sum(s for _, s in sizes) / 8, max(s for _, s in sizes))
    assert max(load.values()) <= 4 / 3 * fair


# --- near copies ---------------------------------------------------------------


def edited(rng, text, share):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def near_rows(seed):
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.randrange(3, 200), 3000)) for _ in range(30)]
    line = " ".join(words(rng, 40, 3000))
    rows = []
    for b in base:
        rows.append(b)
        rows += [edited(rng, b, rng.choice([0.01, 0.02, 0.04, 0.08])) for _ in range(rng.randrange(0, 6))]
        rows += [b] * rng.randrange(0, 3)
    rows += [edited(rng, base[0] + " " + base[1], 0.02) for _ in range(40)]  # one large group
    rows += [line + " " + " ".join(words(rng, rng.randrange(10, 60), 3000)) for _ in range(40)]  # a common line
    rows += [None, "", " \n", "one", "One", "one two", "Four words are here", "four WORDS are here", "x" * 20000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    want = brute.near(rows)
    got = near_dups.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def family(n, seed, edits, size=100):
    """Texts that differ from one base in ``edits`` words each."""
    rng = random.Random(seed)
    base, out = words(rng, size, 5000), []
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(size), edits):
            own[at] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(own))
    return out


def test_pairs_of_similar_unlinked_texts_grow_with_their_number(spark, monkeypatch):
    plain, tried = near_dups._confirmed, []

    def counted(pairs, sets, pct):
        tried.append(pairs.count())
        return plain(pairs, sets, pct)

    monkeypatch.setattr(near_dups, "_confirmed", counted)
    sums = []
    for n in (250, 500, 1000):
        tried.clear()
        rows = list(enumerate(family(n, 3, 3)))
        got = near_dups.near_duplicates(frame(spark, rows)).collect()
        sums.append(sum(tried))
        if n == 250:  # a few are linked, as their edits lie near each other
            want = brute.near(rows)
            assert sum(r["component_id"] == want[r["doc_id"]][1] for r in got) >= 0.97 * n
    # at most 1 + ROUNDS hubs for each of 48 bands; all pairs would grow fourfold
    assert sums[1] <= 2.5 * sums[0] and sums[2] <= 2.5 * sums[1], sums


def test_recall_in_families_near_the_threshold(spark):
    """Links between texts of one family, some just above the threshold, some below."""
    texts = family(150, 5, 1, 60) + family(150, 6, 2, 100) + family(120, 7, 1, 45)
    rows = list(enumerate(texts))
    want = brute.near(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(frame(spark, rows)).collect()}
    right = sum(got[d] == want[d][1] for d in got)
    assert right >= 0.97 * len(rows), right / len(rows)


def test_near_duplicates_of_odd_rows(spark):
    t = "some words of a text that is long enough for shingles to exist"
    rows = [(1, t), (1, t), (2, t + " x"), (None, t), (2, "quite another text under the same number as before"), (3, "quite another text under the same number as before"), (4, None)]
    got = collections.Counter(map(tuple, near_dups.near_duplicates(frame(spark, rows)).collect()))
    n = len(brute.shingles(t))
    assert got == collections.Counter(
        [(1, n, 1, True), (1, n, 1, True), (2, n + 1, 1, False), (None, n, None, False), (2, 5, 1, False), (3, 5, 1, False), (4, 0, 4, True)]
    )
    assert near_dups.near_duplicates(frame(spark, [])).count() == 0
    assert near_dups.near_duplicates(frame(spark, [(1, None)])).collect()[0]["kept"]


def test_empty_bins_keep_the_match_probability():
    rng = np.random.default_rng(1)
    same = []
    for _ in range(300):
        s = np.unique(rng.integers(0, 2**64, 8, dtype=np.uint64))
        same.append(np.mean(near_dups.signature(s) == near_dups.signature(s[:6])))
    assert abs(np.mean(same) - 6 / 8) < 0.03


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (7, 7)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in components.components(Scratch(spark, "t"), df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 300: 200, 200: 200}
    assert components.components(Scratch(spark, "t"), df.filter("false")).count() == 0


# --- line chunks ---------------------------------------------------------------


def test_line_chunks_equal_plain_python(spark):
    rng = random.Random(5)
    lines = [" ".join(words(rng, rng.randrange(1, 9))) for _ in range(60)]
    passage = [" ".join(words(rng, 9)) for _ in range(30)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randrange(0, 12)))) for i in range(60)]
    for i in range(60, 80):  # a passage of many lines in changing surroundings
        rows.append((i, "\n".join(rng.choices(lines, k=5) + passage + rng.choices(lines, k=5))))
    rows += [(90, None), (91, ""), (92, "\n\n\n"), (93, " \n \n"), (94, rows[70][1]), (-3, rows[70][1])]
    want = brute.line_chunks(rows)
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    kept = [r for r in got if 60 <= r["doc_id"] < 80]
    assert sum(r["n_lines_removed"] for r in kept) > 28 * 19  # nearly all of the passage, wherever it stands


@pytest.mark.parametrize("size, share", [(10, 0.95), (20, 0.97), (5, 0.5)])
def test_share_of_a_passage_that_goes(size, share):
    """Passages in changing surroundings, by the plain version that the query equals."""
    rng, rows = random.Random(5), []
    for g in range(40):
        passage = [f"p{g} " + " ".join(words(rng, 8, 4000)) for _ in range(size)]
        for _ in range(6):
            around = [[" ".join(words(rng, 9, 4000)) for _ in range(rng.randrange(3, 12))] for _ in range(2)]
            rows.append((len(rows), "\n".join([*around[0], *passage, *around[1]])))
    out = brute.line_chunks(rows)
    left = sum(out[d].count(f"p{d // 6} ") for d, _ in rows if d % 6)
    assert left <= (1 - share) * 40 * 5 * size
    assert all(out[d] == t for d, t in rows if d % 6 == 0)


def test_near_copies_keep_what_they_share(spark):
    rng = random.Random(8)
    lines = [" ".join(words(rng, 9, 4000)) for _ in range(30)]
    half = lines[:16] + [" ".join(words(rng, 9, 4000)) for _ in range(12)]
    less = lines[:12] + [" ".join(words(rng, 9, 4000)) for _ in range(18)]
    rows = [(i, "\n".join(x)) for i, x in enumerate((lines, half, less, lines))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_documents(frame(spark, rows), copy_share=0.5).collect()}
    assert got[0] == got[3] == rows[0][1] and got[1] == rows[1][1]
    assert len(got[2]) < len(rows[2][1])


def test_line_chunks_keep_rows_and_columns(spark):
    t = "\n".join(f"a line with some words {i}" for i in range(40))
    rows = [(1, t), (1, t), (None, t), (2, "x\ny"), (3, None)]
    df = frame(spark, rows)
    out = line_dedup.dedup_documents(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert by[None][0]["text"] == t  # a null id sorts first and holds the first place
    assert by[1][0]["text"] == by[1][1]["text"] and len(by[1][0]["text"]) < len(t)
    assert by[1][0]["n_chars"] == len(by[1][0]["text"])
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


# --- licences ------------------------------------------------------------------


def test_licences_and_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        (1, "p/LICENSE", mit, "x"),
        (2, "p/a/b/code.c", "int main;\nno words of that kind", "x"),
        (3, "p/a/COPYING.txt", apache + "\n", "x"),
        (4, "p/a/own.c", "// Licensed under CC BY-NC 4.0.\ncode", "x"),
        (5, "q/x.c", "text", "x"),
        (6, None, "// " + mit, "x"),
        (7, "p/b.c", None, "x"),
        (7, "p/b.c", None, "x"),
        (8, "top.c", "nothing", "x"),
        (None, "p/a/b/c.c", "", "x"),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string, dir string")
    got = licenses.scan_licenses(df).collect()
    assert len(got) == len(files)
    found = {(r["doc_id"], r["license"], r["found"], r["license_dir"]) for r in got}
    assert found == {
        (1, "MIT", "own", None),
        (2, "Apache-2.0", "inherited", "p/a"),
        (3, "Apache-2.0", "own", None),
        (4, "CC-BY-NC-4.0", "own", None),
        (5, None, "none", None),
        (6, "MIT", "own", None),
        (7, "MIT", "inherited", "p"),
        (8, None, "none", None),
        (None, "Apache-2.0", "inherited", "p/a"),
    }
    assert licenses.scan_licenses(df.filter("false")).count() == 0


def test_lines_without_cues_stay_below_the_threshold():
    vectors = [{"a": 3.0, "b": 2.0, "c": 0.5}, {"b": 1.0, "d": 1.0}]
    cues = licenses.cue_terms(vectors, 0.8)
    for v in vectors:
        whole = sum(x * x for x in v.values())
        assert sum(x * x for t, x in v.items() if t not in cues) < 0.64 * whole


# --- leaks ---------------------------------------------------------------------


def leaks(spark, docs, items, **kw):
    found = decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), **kw)
    return {(r["doc_id"], r["item_id"]): r for r in found.collect()}


def test_leaks_copies_edits_and_clean_texts(spark):
    rng = random.Random(6)
    items = [(i, " ".join(words(rng, rng.randrange(15, 58), 5000))) for i in range(60)]
    docs, want = [], {}
    for i, t in items:
        docs.append((i, " ".join(words(rng, rng.randrange(0, 50), 5000)) + "\n" + t.upper().replace("W", "w") + " " + " ".join(words(rng, 20, 5000))))
        want[i, i] = 0
    for i, t in items:
        w = t.split()
        w[len(w) // 2] = "changed"
        docs.append((100 + i, " ".join(words(rng, 37, 5000) + w)))
        want[100 + i, i] = 1
    docs += [(200 + k, " ".join(words(rng, 300, 5000))) for k in range(60)]
    got = leaks(spark, docs, items)
    copies = {k for k, v in want.items() if v == 0}
    assert copies <= set(got) and set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)
    assert all(r["edits"] == want[k] for k, r in got.items())
    again = leaks(spark, docs, items, block_items=13)
    assert set(again) == set(got)


def planted(rng, lengths, count):
    """Items, and documents that hold one each with 10, 20 and 25 % of its words edited."""
    items, docs = [], []
    for n in lengths:
        for _ in range(count):
            item = words(rng, n, 5000)
            items.append((len(items), " ".join(item)))
            for pct in (10, 20, 25):
                w = list(item)
                for _ in range(n * pct // 100):
                    i, kind = rng.randrange(len(w)), rng.randrange(3)
                    w[i : i + (kind < 2)] = [f"e{rng.randrange(10**6)}"] if kind != 1 else []
                text = words(rng, rng.randrange(8, 30), 5000) + w + words(rng, 9, 5000)
                docs.append((len(docs), " ".join(text)))
    return items, docs


@pytest.mark.parametrize("lengths, share", [((15, 16, 19, 23, 24, 31, 39, 40, 59, 63), 1), ((64, 100, 300), 0.97)])
def test_leaks_equal_brute_force_at_all_edits(spark, lengths, share):
    items, docs = planted(random.Random(21), lengths, 12)
    want = {}
    for d, text in docs:
        item = np.array([hash(w) for w in items[d // 3][1].split()])
        edits, _ = decontaminate.edit_distance(item, np.array([hash(w) for w in text.split()]))
        if edits <= len(item) * 25 // 100:
            want[d, d // 3] = edits
    assert len(want) >= 0.9 * len(docs)
    got = {k: r["edits"] for k, r in leaks(spark, docs, items).items()}
    assert got.items() <= want.items()
    assert len(got) >= share * len(want)


def test_leaks_of_very_long_and_short_items(spark):
    rng = random.Random(22)
    long = " ".join(words(rng, 5000, 5000))
    short = {n: words(rng, n, 5000) for n in (4, 7, 8, 11, 12, 14)}
    items = [(n, " ".join(w)) for n, w in short.items()] + [(99, long)]  # the last of its block
    docs, want = [(1000, "x y " + long + " z")], {(1000, 99): 0}
    for n, w in short.items():
        for d, first in ((n, ["changed"]), (100 + n, [])):  # first word changed or dropped
            docs.append((d, " ".join(words(rng, 11, 5000) + first + w[1:] + words(rng, 5, 5000))))
            want[d, n] = 1
    got = leaks(spark, docs, items)
    assert {k: r["edits"] for k, r in got.items()} == want


def test_leaks_of_odd_rows(spark):
    short, long = "tiny item of five words", " ".join(f"v{i}" for i in range(30))
    docs = [(1, "before " + short), (1, "before " + short), (2, None), (3, ""), (4, long), (5, "v0 v1 v2"), (None, "x " + long)]
    items = [(1, short), (2, None), (3, ""), (4, long), (5, long), (None, long)]
    got = leaks(spark, docs, items)
    assert set(got) == {(1, 1), (4, 4), (4, 5), (None, 4), (None, 5)}
    assert leaks(spark, [], items) == {} and leaks(spark, docs, []) == {}


def test_edit_distance_equals_plain_python():
    rng = random.Random(8)

    def plain(item, text):
        row = list(range(len(item) + 1))
        best = row[-1]
        for w in text:
            new = [0]
            for i, x in enumerate(item):
                new.append(min(row[i] + (x != w), row[i + 1] + 1, new[i] + 1))
            row = new
            best = min(best, row[-1])
        return best

    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(5) for _ in range(rng.randrange(0, 20))]
        assert decontaminate.edit_distance(np.array(a), np.array(b, int))[0] == plain(a, b)


# --- pipeline ------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    src = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{src}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "123 456", "en", "s", 7), (None, "the words of this text are here", "en", "s", 31)],
        docs.schema,
    )
    docs = docs.unionByName(odd).withColumn("_hash", F.lit("extra"))
    before = docs.count()
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, src)
        if name != "pieces":
            assert out.columns == docs.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
    assert counts[0] == before - 3 and counts[1] == counts[0]
    assert counts[2] < counts[1] and counts[3] < counts[2] and counts[4] == counts[3]
    empty = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{src}/documents.parquet").filter("false"), src)
    for _, stage in corpus_pipeline.STAGES[1:]:
        empty = stage(spark, empty, src)
    assert empty.count() == 0


def test_pipeline_leaves_one_row_of_copies(spark):
    import corpus_pipeline

    rng = random.Random(12)
    rows, own = [], {}
    for g in range(12):
        lines = [" ".join(words(rng, rng.randrange(4, 12), 3000)) for _ in range(3 + 4 * g)]
        texts = ["\n".join(lines)] * 3  # exact copies
        if len(lines) > 15:  # and near copies, with one line edited
            for k in range(2):
                texts.append("\n".join([*lines[:7], f"changed line {g} {k}", *lines[8:]]))
        for t in texts:
            own[len(rows)] = g
            rows.append((len(rows), t))
    whole = "\n".join(rows[-1][1].split("\n") * 3)  # nothing but repeats of its own lines
    rows += [(500, whole), (501, ""), (502, None)]
    df = frame(spark, rows)
    copies = near_dups.near_duplicates(df)
    groups = {r["doc_id"]: r["component_id"] for r in copies.collect()}
    assert len({groups[d] for d in own}) == 12
    lined = Scratch(spark, "t").write(corpus_pipeline.line_dedup_stage(spark, df, ""))
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_dedup(spark, lined, "").collect()}
    kept = collections.Counter(own[d] for d, t in left.items() if d in own)
    assert kept == {g: 1 for g in range(12)}
    assert all(left[d].strip() for d in left if d < 500)
    assert left[501] == "" and left[502] is None  # empty before, so they stay


def test_line_dedup_drops_only_rows_it_empties(spark):
    block = "\n".join(f"a line with some words {i}" for i in range(40))
    rows = [(1, block + "\nan end of its own"), (2, block + "\nan end of its own"), (3, ""), (4, None)]
    out = line_dedup.dedup_documents(frame(spark, rows), keep_emptied=False).collect()
    before = {r["doc_id"]: r["text"] for r in line_dedup.dedup_documents(frame(spark, rows)).collect()}
    assert {r["doc_id"] for r in out} == {d for d, t in before.items() if d in (1, 3, 4) or t.strip()}
