"""Benchmark decontamination: CGK embedding and bit sampling.

Documents and items are sequences of lower-cased words. An item of n words leaks
where a run of a document is within e edits of it (``edit_pct`` of n).

A window goes through a random walk (CGK: Chakraborty, Goldenberg, Koucky). It is read
from its start: at every step the walk emits the word under its pointer, and a random
bit of (step, word) says whether the pointer moves on. Two windows a few edits apart
fall out of step at an edit and into step again, so that edit distance becomes Hamming
distance of the emitted words. Sampling a few steps and hashing their words gives keys.

Items go in classes by length, each with windows of its own size (about half of its
shortest item, up to 15 words). Document windows start at every ``stride``-th word, item windows
at every word of a short item and at as many successive words as a stride has at each
of ``PLACES`` places of a long one, so a copy meets a document window that starts at the
very same word. How many keys a walk needs comes from simulated items with all
``edit_pct`` edits: as many as it takes for ``recall`` of them to be met, at several
lengths of the class.

Candidates are (document, item, place), near ones taken together; the edit distance of
the whole item to the best matching run of words at that place is computed exactly.

Items are read in blocks of ``block_items``, one pass over the documents for each
block, so what a task holds has a bound at any benchmark size.

Cases: null texts, and items without words, match nothing; items of one to three words
must occur as they are; an item that is a text several times is reported for each
item_id; repeated document rows give the same result once; empty tables give no rows;
extra columns are not read. Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices
from .words import batch_words, mix

#: Classes of items: least words, words of a window, words between document windows,
#: steps that a key samples.
CLASSES = ((1, 1, 1, 1), (2, 2, 1, 2), (4, 2, 1, 2), (8, 4, 2, 3), (15, 8, 4, 4), (30, 12, 8, 4), (60, 15, 15, 4))
#: Steps of a walk that are sampled: later ones seldom are in step behind an edit.
STEPS = 10
#: Walks, wanted recall, allowed edits in % of an item's words.
WALKS, RECALL, EDIT_PCT = 8, 0.99, 25
#: Places of a long item, evenly apart, where its windows start.
PLACES = 7
#: Items of a block: their keys and a filter over them are broadcast, at most about
#: 60 KB for an item, 10 KB for one of up to 59 words.
BLOCK_ITEMS = 1000
#: Marks of the filter for each key.
FILTER_SHARE = 32


@dataclass(frozen=True)
class Plan:
    """Windows of one class of items, and which steps each key samples."""

    size: int
    stride: int
    steps: np.ndarray  # (walks, keys, samples)


def _seeds(walks: int) -> np.ndarray:
    return mix(np.arange(1, walks + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def walk(words: np.ndarray, starts: np.ndarray, steps: int, seed: np.uint64) -> Iterator[np.ndarray]:
    """Pointers of all windows, step by step. ``words`` ends with a 0 that stops."""
    moves = mix(words ^ seed)  # bit j: move on at step j
    moves[words == 0] = 0
    at = starts.copy()
    for j in range(steps):
        yield at
        at = at + ((moves[at] >> np.uint64(j)) & np.uint64(1)).astype(at.dtype)


def keys_of(words: np.ndarray, starts: np.ndarray, plan: Plan) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(key number, key of every start, which of them count). Beyond a window its words
    count as 0. A key whose steps found the pointer at one place again and again holds
    a word or two, which are everywhere; it must hold a word for each step but one."""
    for w, seed in enumerate(_seeds(WALKS)):
        made = [np.full(len(starts), w * 1000 + k, np.uint64) for k in range(len(plan.steps[w]))]
        last = [np.full(len(starts), -1, starts.dtype) for _ in made]
        held = [np.zeros(len(starts), np.int8) for _ in made]
        wanted: dict[int, list[int]] = {}
        for k, steps in enumerate(plan.steps[w].tolist()):
            for j in steps:
                wanted.setdefault(j, []).append(k)
        for j, at in enumerate(walk(words, starts, max(wanted) + 1, seed)):
            if j not in wanted:
                continue
            inside = at - starts < plan.size
            emitted = np.where(inside, words[at], np.uint64(0))
            for k in wanted[j]:
                x = made[k]
                x ^= emitted
                x *= np.uint64(0xD6E8FEB86659FD93)
                x ^= x >> np.uint64(29)
                held[k] += inside & (at != last[k])
                last[k] = at
        least = max(1, min(plan.steps.shape[2] - 1, plan.size))
        for k, x in enumerate(made):
            yield w * 1000 + k, x, held[k] >= least


def item_offsets(n: int, plan: Plan) -> np.ndarray:
    """Where the windows of an item of n words start."""
    last = n - plan.size
    if last + 1 <= PLACES * plan.stride:
        return np.arange(last + 1)
    firsts = np.linspace(0, last - plan.stride + 1, PLACES).astype(np.int64)
    return np.unique(firsts[:, None] + np.arange(plan.stride))


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with that many random words replaced, dropped or put in."""
    out = words.tolist()
    for _ in range(edits):
        i, kind, new = int(rng.integers(0, len(out))), rng.integers(0, 3), int(rng.integers(1, 2**63))
        out[i : i + (kind < 2)] = [new] if kind != 1 else []
    return np.array(out, np.uint64)


def simulated_recall(plan: Plan, n: int, edit_pct: int, trials: int = 1000) -> np.ndarray:
    """Share of edited items of n words met by the first 1, 2, ... keys of each walk."""
    rng = np.random.default_rng(n)
    items, docs, spots, marks, at_item, at_doc = [], [], [], [], 0, 0
    offsets = item_offsets(n, plan)
    for _ in range(trials):
        item = rng.integers(1, 2**63, n).astype(np.uint64)
        before = rng.integers(1, 2**63, int(rng.integers(plan.stride, 2 * plan.stride + 1))).astype(np.uint64)
        text = np.concatenate([before, edited(item, n * edit_pct // 100, rng), before])
        items.append(np.append(item, np.uint64(0)))
        docs.append(np.append(text, np.uint64(0)))
        spots.append(at_item + offsets)
        marks.append(at_doc + np.arange(0, len(text), plan.stride))
        at_item, at_doc = at_item + n + 1, at_doc + len(text) + 1
    owner_i = np.repeat(np.arange(trials), len(offsets)).astype(np.uint64)
    owner_d = np.repeat(np.arange(trials), [len(m) for m in marks]).astype(np.uint64)
    met = np.zeros((plan.steps.shape[1], trials), bool)
    left = keys_of(np.concatenate(items), np.concatenate(spots), plan)
    right = keys_of(np.concatenate(docs), np.concatenate(marks), plan)
    for (number, a, some), (_, b, others) in zip(left, right):
        hit = others & np.isin(mix(b) ^ mix(owner_d), (mix(a) ^ mix(owner_i))[some])
        met[number % 1000, owner_d[hit].astype(np.int64)] = True
    return np.logical_or.accumulate(met).mean(axis=1)


def class_of(n: int) -> int:
    """Number of the class that items of n words are in."""
    return sum(n >= least for least, *_ in CLASSES) - 1


@lru_cache(maxsize=32)
def make_plan(number: int, recall: float = RECALL, edit_pct: int = EDIT_PCT) -> Plan:
    """As many keys per walk as items of a class need with all edits that are allowed:
    the shortest, the one with the largest share of edits, and long ones."""
    least, size, stride, samples = CLASSES[number]
    rng = np.random.default_rng(9)
    most = CLASSES[number + 1][0] - 1 if number + 1 < len(CLASSES) else 4 * least
    lengths = {least, min(most, -(-least * edit_pct // 100) * 100 // max(1, edit_pct)), (least + most) // 2, most}
    # a key's steps come from equal parts of the walk, so that its words lie apart
    parts = np.array_split(np.arange(max(samples, min(STEPS, 2 * size))), samples)
    keys = 8
    while True:
        steps = np.stack([rng.choice(part, (WALKS, keys)) for part in parts], axis=2)
        plan = Plan(size, stride, steps)
        found = np.min([simulated_recall(plan, n, edit_pct) for n in lengths if n >= least], axis=0)
        # two standard errors above the wanted share
        enough = np.flatnonzero(found >= min(recall + 2 * math.sqrt(recall * (1 - recall) / 1000), 0.999))
        if len(enough) or keys >= 64:
            return Plan(size, stride, steps[:, : (enough[0] + 1 if len(enough) else keys)])
        keys *= 2


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least word edits between the item and any run of the text, and its end."""
    n = len(item)
    column = np.arange(n + 1)  # distances of item prefixes to runs that end here
    best, end = n, 0
    ramp = np.arange(n + 1)
    for k, w in enumerate(text):
        step = np.empty(n + 1, np.int64)
        step[0] = 0  # a run may start anywhere
        step[1:] = np.minimum(column[:-1] + (item != w), column[1:] + 1)
        # insertions run down the column: a running minimum of step - position
        column = np.minimum.accumulate(step - ramp) + ramp
        if column[n] < best:
            best, end = int(column[n]), k + 1
            if best == 0:
                break
    return best, end


@dataclass
class Index:
    """Sorted keys with the item and the offset each comes from, behind a bit filter."""

    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    bits: np.ndarray

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in ``keys``, item, offset) of everything that meets."""
        at = np.flatnonzero(self.bits[(keys >> _shift(self.bits)).astype(np.int64)])
        lo, hi = (np.searchsorted(self.keys, keys[at], side) for side in ("left", "right"))
        n = hi - lo
        rows = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
        return np.repeat(at, n), self.items[rows], self.offsets[rows]


def _shift(bits: np.ndarray) -> np.uint64:
    return np.uint64(65 - len(bits).bit_length())


def make_index(keys: np.ndarray, items: np.ndarray, offsets: np.ndarray) -> Index:
    order = np.argsort(keys)
    bits = np.zeros(1 << max(10, (FILTER_SHARE * len(keys)).bit_length()), bool)
    bits[(keys >> _shift(bits)).astype(np.int64)] = True
    return Index(keys[order], items[order], offsets[order], bits)


@dataclass
class Block:
    """One block of items with their keys, small enough for every task."""

    items: list[tuple[int, np.ndarray]]  # item_id, words
    edits: np.ndarray  # allowed edits of each item
    classes: list[tuple[Plan, Index]]  # all keys of the windows of a class's items


def make_block(items: list[tuple[int, str | None]], recall: float, edit_pct: int) -> Block | None:
    known = [(i, (t or "").encode("utf-8", "replace").lower()) for i, t in items]
    hashes, _, _, first = batch_words([t for _, t in known])
    cut = [(i, hashes[a:b]) for (i, _), a, b in zip(known, first[:-1], first[1:]) if b > a]
    if not cut:
        return None
    sizes = np.array([len(w) for _, w in cut], np.int64)
    member = np.array([class_of(n) for n in sizes.tolist()])
    classes = []
    for number in np.unique(member).tolist():
        plan, ks = make_plan(number, recall, edit_pct), np.flatnonzero(member == number)
        flat = np.concatenate([np.append(cut[k][1], np.uint64(0)) for k in ks])
        begin = np.cumsum([0, *(sizes[ks] + 1)])[:-1]
        offsets = [item_offsets(int(sizes[k]), plan) for k in ks]
        starts = np.concatenate([b + o for b, o in zip(begin, offsets)])
        owner = np.repeat(ks, [len(o) for o in offsets]).astype(np.int32)
        where = np.concatenate(offsets).astype(np.int32)
        made = [(k[some], owner[some], where[some]) for _, k, some in keys_of(flat, starts, plan)]
        classes.append((plan, make_index(*map(np.concatenate, zip(*made)))))  # a key holds its number
    return Block(cut, sizes * edit_pct // 100, classes)


def _verified(block: Block, words: np.ndarray, seen: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(item index, edits, end word) for candidates (item, first and last guessed start)."""
    done: dict[int, tuple[int, int]] = {}
    for k, start, last in sorted(seen):
        item = block.items[k][1]
        n = len(item)
        most = int(block.edits[k])
        if k in done and done[k][0] == 0:
            continue
        a = max(0, start)
        if np.array_equal(words[a : a + n], item):
            done[k] = 0, a + n
            continue
        a = max(0, start - most)
        near = words[a : max(0, last + n + most)]
        if np.isin(item, near).sum() < n - most:  # words that are missing are edits
            continue
        d, end = edit_distance(item, near)
        if d <= most and (k not in done or d < done[k][0]):
            done[k] = d, a + end
    for k, (d, end) in done.items():
        yield k, d, end


def _together(block: Block, text: np.ndarray, k: np.ndarray, guess: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Candidates of each text: (item, first and last guessed start), guesses that edits
    may have moved apart taken as one."""
    order = np.lexsort((guess, k, text))
    text, k, guess = text[order], k[order], guess[order]
    new = np.ones(len(text), bool)
    apart = guess[1:] - guess[:-1] > block.edits[k[1:]] + 1
    new[1:] = (text[1:] != text[:-1]) | (k[1:] != k[:-1]) | apart
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(text)) - 1
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in zip(head.tolist(), tail.tolist()):
        found.setdefault(int(text[a]), []).append((int(k[a]), int(guess[a]), int(guess[b])))
    return found


def _matches(block: Block, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
    """(text index, item index, edits, first word) of a batch of texts."""
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    hashes, _, _, first = batch_words(data)
    n = np.diff(first)
    # words of all texts, each followed by a 0
    flat = np.zeros(len(hashes) + len(data), np.uint64)
    shift = np.repeat(np.arange(len(data)), n)
    flat[np.arange(len(hashes)) + shift] = hashes
    begin = first[:-1] + np.arange(len(data))
    hits = []
    for plan, index in block.classes:
        counts = -(-n // plan.stride)
        owner = np.repeat(np.arange(len(data)), counts)
        inside = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * plan.stride
        starts = begin[owner] + inside
        for _, keys, some in keys_of(flat, starts, plan):
            here = np.flatnonzero(some)
            at, k, offset = index.hits(keys[here])
            at = here[at]
            hits.append(np.stack([owner[at], k, inside[at] - offset]))
    every = np.unique(np.concatenate(hits, axis=1), axis=1) if hits else np.zeros((3, 0), np.int64)
    for d, seen in _together(block, *every).items():
        words = flat[begin[d] : begin[d] + n[d]]
        for k, edits, end in _verified(block, words, seen):
            yield d, k, edits, end - len(block.items[k][1])


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    edit_pct: int = EDIT_PCT,
    recall: float = RECALL,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """doc_id, item_id, edits, item_words and first_word of every contained item."""
    spark = docs.sparkSession
    named = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    kind = named.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, edits long, item_words long, first_word long"
    wanted = items.filter(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    ).distinct()
    blocks = max(1, math.ceil(wanted.count() / block_items))
    if blocks > 1:  # each block is read back alone
        wanted = Scratch(spark, "leak-items").write(
            wanted.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
        )
    else:
        wanted = wanted.withColumn("_block", F.lit(0))
    out = None
    for number in range(blocks):
        rows = wanted.filter(F.col("_block") == number).orderBy("item_id", "text").collect()
        block = make_block([(r["item_id"], r["text"]) for r in rows], recall, edit_pct)
        if block is None:
            continue
        shared = spark.sparkContext.broadcast(block)  # block_items items at most

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            b = shared.value
            for batch in slices(batches, 1 << 20):
                got = list(_matches(b, batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([d for d, *_ in got], pa.int64())),
                        pa.array([b.items[k][0] for _, k, *_ in got], pa.int64()),
                        pa.array([e for _, _, e, _ in got], pa.int64()),
                        pa.array([len(b.items[k][1]) for _, k, *_ in got], pa.int64()),
                        pa.array([max(0, p) for *_, p in got], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "edits", "item_words", "first_word"],
                )

        part = named.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out.distinct()

