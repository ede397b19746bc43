"""Alignment of two tokenizers over the same texts, and how often their ids meet.

A byte-level tokenizer (A) reads a space and the text, a SentencePiece model (B) reads
the text and puts the space there itself. Both give spans: A the characters of every
token, B the bytes of every piece (those of the library's proto form, in the shape it
hands out fastest). Spans that follow on each other are coarse cuts. Where tokens share a character (a multibyte character in
several tokens, byte-fallback pieces) the spans say nothing more, and the decoded bytes
of the entries are laid end to end between the two cuts around them.

Groups end where a token of A and a token of B end at the same byte; these two are a
link. How often a pair of ids is linked in all texts is counted by Spark, and each link
is then held against the most frequent partner of its B id.

Texts are read in units: a new one starts where white space follows a character that is
none. No token of A crosses such a place (its pattern takes white space with what
follows) and no piece of B (checked against the vocabulary), and neither looks back or
ahead over it. So every distinct unit is encoded and aligned once per worker, in bounded
memory. Tokenizers for which that doesn't hold read whole texts as one unit.

Counts of pairs: the ``hot_pairs`` most frequent ones are broadcast (a fixed number of
rows); rows of all others meet their counts in a join, where no key is frequent.

Cases: null and empty texts, and texts whose joined bytes of A or B aren't a space and
the text (a literal U+2581 is read as a space by B), have no tokens, zeros and an empty
``groups_sha256``; strings of special tokens are plain text; entries without bytes end
where the token before them ends; rows with equal doc_id are rows of their own; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .common import Scratch, slices

#: Distinct units a task remembers, and pairs whose counts are broadcast.
UNITS_KEPT, HOT_PAIRS = 500_000, 1 << 16
#: White space that starts a unit behind a character that is none.
_STARTS = " \n\t"
_UNIT = re.compile(rf"[{_STARTS}]\s*\S*(?:[^\S{_STARTS}]\s*\S*)*")


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """Byte-level entries write each byte as one visible character: visible Latin-1
    bytes as themselves, the others from U+0100 on in order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids, character spans, bytes of entries."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = True
        spec = json.loads(self.tok.to_str())
        cut = spec["pre_tokenizer"] or {}
        self.by_unit = (
            spec["normalizer"] is None
            and spec["model"]["type"] == "BPE"
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
        )
        at = _byte_of()
        vocab = spec["model"]["vocab"]
        self.entries = [b""] * self.tok.get_vocab_size()
        for t, i in vocab.items():
            if all(c in at for c in t):
                self.entries[i] = bytes(at[c] for c in t)

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids, and the byte span of the characters each one has a part in."""
        e = self.tok.encode(text, add_special_tokens=False)
        spans = np.fromiter(chain.from_iterable(e.offsets), np.int64).reshape(-1, 2)
        if not text.isascii():  # characters -> bytes
            code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
            wide = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
            spans = np.append(0, np.cumsum(wide))[spans]
        return e.ids, spans


class PieceModel:
    """Tokenizer B: ids, byte spans, bytes of pieces."""

    def __init__(self, path: str):
        model = pieces.load(path)
        names = [model.whole.id_to_piece(i) for i in range(model.whole.get_piece_size())]
        crossing = re.compile(f"[^\\s{pieces.SPACE}][{_STARTS}{pieces.SPACE}]")
        self.by_unit = model.fast and not any(map(crossing.search, names))
        # in units the space is there already; a model that normalises puts it there
        self.sp = model.plain if self.by_unit else model.whole
        self.entries = [
            bytes([int(t[3:5], 16)])
            if self.sp.is_byte(i)
            else b""
            if self.sp.is_control(i)
            else t.replace(pieces.SPACE, " ").encode()
            for i, t in enumerate(names)
        ]

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids, and the byte span of each piece."""
        got = self.sp.encode(
            text if self.by_unit else text[1:], return_type="offset_mapping", return_bytes=True, num_threads=1
        )
        return got["ids"], np.fromiter(chain.from_iterable(got["offsets"]), np.int64).reshape(-1, 2)


def byte_ends(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Last byte (exclusive) of each token: its span's end where the next span begins
    there, else as many bytes behind the last such place as the entries have."""
    if not len(spans):
        return np.zeros(0, np.int64)
    total = np.cumsum(sizes)
    cut = np.append((spans[1:, 0] == spans[:-1, 1]) & (spans[1:, 1] > spans[:-1, 1]), True)
    last = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), -1))
    coarse, own = np.append(spans[:, 1], 0), np.append(total, 0)  # [-1]: the start
    return np.where(cut, spans[:, 1], coarse[last] + total - own[last])


class Aligner:
    """Both tokenizers and the units a task has seen."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), PieceModel(b_path)
        self.by_unit = self.a.by_unit and self.b.by_unit
        ids = range(max(len(self.a.entries), len(self.b.entries)))
        self.words = [f"{i}{sign}" for i in ids for sign in (",", "|", ";", "\n")]
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.shown: list[str | None] = []  # groups of a unit as text; None: bytes differ
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links
        self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def aligned(self, text: str) -> tuple[list[int], np.ndarray, list[int], np.ndarray] | None:
        """Ids of A with their last bytes, then B's; None where bytes differ."""
        raw, out = text.encode("utf-8", "replace"), []
        for side in (self.a, self.b):
            ids, spans = side.encode(text)
            parts = list(map(side.entries.__getitem__, ids))
            if b"".join(parts) != raw:
                return None
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            ends = byte_ends(spans, sizes)
            if ends[-1:].tolist() != [len(raw)] or (np.diff(ends) < 0).any():
                ends = np.cumsum(sizes)  # spans of a normalised text: bytes alone
            out += [ids, ends]
        return tuple(out)

    def _described(self, units: list[str], found: tuple | None) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Texts, sizes and linked pairs of units that have been encoded together."""
        if found is None:
            return [None] * len(units), np.zeros((len(units), 4), np.int64), np.zeros(0, np.int64)
        a, a_ends, b, b_ends = found
        stops = np.cumsum([len(u.encode("utf-8", "replace")) for u in units])
        cuts = common_ends(a_ends, b_ends)
        pairs, at = links_of(a, a_ends, b, b_ends, cuts)
        count = lambda ends: np.bincount(np.searchsorted(stops, ends), minlength=len(units))
        sizes = np.stack([count(a_ends), count(b_ends), count(cuts), count(at)], axis=1)
        return self._texts(a, a_ends, b, b_ends, cuts, stops), sizes, pairs

    def _texts(self, a: list[int], a_ends: np.ndarray, b: list[int], b_ends: np.ndarray, cuts: np.ndarray, stops: np.ndarray) -> list[str]:
        """Groups of every unit as text, as ``show`` has them: each id is a word with the
        sign that follows it, a line end behind a unit."""
        ga, gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        ends = np.zeros(len(cuts), bool)
        ends[np.searchsorted(cuts, stops)] = True
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (ga, gb))
        sign_b = np.where(last_b, np.where(ends[gb], 3, 2), 0)
        words = np.concatenate([np.array(a) * 4 + last_a, np.array(b) * 4 + sign_b])
        order = np.argsort(np.concatenate([ga * 2, gb * 2 + 1]), kind="stable")
        return "".join(map(self.words.__getitem__, words[order].tolist())).split("\n")[:-1]

    def learn(self, units: list[str]) -> None:
        """Units behind each other are a text of these units, so they are encoded at
        once; those with a literal mark or white space at their end are not."""
        plain = [u for u in units if self.by_unit and pieces.SPACE not in u and not u[-1].isspace()]
        found = self.aligned("".join(plain)) if plain else None
        if found is None:
            plain = []
        known = set(plain)
        alone = [u for u in units if u not in known]
        parts = [self._described(plain, found)] if plain else []
        parts += [self._described([u], self.aligned(u)) for u in alone]
        for u in chain(plain, alone):
            self.slots[u] = len(self.slots)
        for shown, _, _ in parts:
            self.shown += shown
        sizes = np.concatenate([np.zeros((0, 4), np.int64), *(x for _, x, _ in parts)])
        ends = len(self.pairs) + np.cumsum(sizes[:, 3])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.concatenate([self.starts, ends - sizes[:, 3]])
        self.pairs = np.concatenate([self.pairs, *(x for _, _, x in parts)])

    def trim(self) -> None:
        """Forget the newest units beyond the limit; the first ones are mostly frequent."""
        if len(self.shown) > UNITS_KEPT:
            self.slots = {u: k for u, k in self.slots.items() if k < UNITS_KEPT}
            del self.shown[UNITS_KEPT:]
            self.sizes, self.starts = self.sizes[:UNITS_KEPT], self.starts[:UNITS_KEPT]
            self.pairs = self.pairs[: int(self.sizes[:, 3].sum())]

    def units(self, text: str) -> list[str]:
        """Never empty ones: a text starts with a space, and a unit with what it breaks at."""
        return _UNIT.findall(" " + text) if self.by_unit else [" " + text]

    def documents(self, texts: list[str | None]) -> list[tuple[np.ndarray, str, np.ndarray]]:
        """(tokens of A and B, groups and links; groups_sha256; linked pairs) of each text."""
        cut = [self.units(t) if t else [] for t in texts]
        self.learn([u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in self.slots])
        out = []
        for units in cut:
            at = list(map(self.slots.__getitem__, units))
            shown = list(map(self.shown.__getitem__, at))
            if not at or None in shown:
                out.append((np.zeros(4, np.int64), "", np.zeros(0, np.int64)))
                continue
            slots = np.array(at)
            counts = self.sizes[slots, 3]
            total = np.cumsum(counts)
            pairs = self.pairs[np.repeat(self.starts[slots] - total + counts, counts) + np.arange(total[-1])]
            out.append((self.sizes[slots].sum(axis=0), sha256(";".join(shown).encode()).hexdigest(), pairs))
        self.trim()
        return out


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Bytes at which a token of A and one of B end (both sorted)."""
    if not len(a_ends) or not len(b_ends):
        return a_ends[:0]
    at = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
    found = a_ends[b_ends[at] == a_ends]
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def groups_of(
    a: list[int], a_ends: np.ndarray, b: list[int], b_ends: np.ndarray, cuts: np.ndarray
) -> list[tuple[list[int], list[int]]]:
    """Ids of A and of B between ends that both have."""
    to_a = np.searchsorted(a_ends, cuts, "right").tolist()
    to_b = np.searchsorted(b_ends, cuts, "right").tolist()
    return [(a[i:j], b[k:m]) for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b)]


def links_of(
    a: list[int], a_ends: np.ndarray, b: list[int], b_ends: np.ndarray, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(pair, byte) for every token of A and of B that end at the same byte."""
    ids = []
    for tokens, ends in ((a, a_ends), (b, b_ends)):
        lo, hi = np.searchsorted(ends, cuts, "left"), np.searchsorted(ends, cuts, "right")
        ids.append((np.array(tokens, np.int64), lo, hi - lo))
    (xs, x0, nx), (ys, y0, ny) = ids
    n = nx * ny
    cut = np.repeat(np.arange(len(cuts)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    left, right = xs[x0[cut] + k // ny[cut]], ys[y0[cut] + k % ny[cut]]
    return left << 32 | right, cuts[cut]


def show(groups: list[tuple[list[int], list[int]]]) -> list[str]:
    return [",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups]


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat, kind))


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups of every text: doc_id, groups (array of ids of A and ids of B)."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load(a_path, b_path)
        shape = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in slices(batches):
            rows = []
            for t in batch.column(1).to_pylist():
                found = both.aligned(" " + t) if t else None
                rows.append([{"a": a, "b": b} for a, b in groups_of(*found, common_ends(found[1], found[3]))] if found else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, shape)], names=["doc_id", "groups"])

    return kept.mapInArrow(run, f"doc_id {kind}, groups array<struct<a: array<int>, b: array<int>>>")


def _sketch(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per text with its distinct linked pairs and how often each occurs."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row = load(a_path, b_path), TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            found = both.documents(batch.column(1).to_pylist())
            counted = [np.unique(p, return_counts=True) for _, _, p in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(found)), pa.int64()),
                    batch.column(0),
                    *(pa.array([f[0][k] for f in found], pa.int64()) for k in range(4)),
                    pa.array([f[1] for f in found], pa.string()),
                    _lists([p for p, _ in counted], pa.int64()),
                    _lists([n for _, n in counted], pa.int32()),
                ],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )
            row += len(found)

    return docs.mapInArrow(
        run,
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, pairs array<long>, times array<int>",
    )


def pair_counts(sketch: DataFrame) -> DataFrame:
    """pair (id of A << 32 | id of B), n links that hold it, best: no pair of its B id
    has more."""
    every = sketch.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = every.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    return counts


def _with_best(counts: DataFrame) -> DataFrame:
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, b == most["b"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(sketch: DataFrame, hot: list[tuple[int, int, bool]]) -> DataFrame:
    """Sums over links whose pair is in ``hot``; the other pairs stay for a join."""
    hot = sorted(hot)
    keys, n, best = (np.array([h[k] for h in hot], np.int64) for k in range(3))
    shared = sketch.sparkSession.sparkContext.broadcast((keys, n, best))
    plain = [c for c in sketch.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            pairs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            each = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            sums = [np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)]
            np.add.at(sums[0], owner[known], each[known] * best[at[known]])
            np.add.at(sums[1], owner[known], each[known] * n[at[known]])
            rest = np.flatnonzero(~known)
            cuts = np.searchsorted(owner[rest], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in plain),
                    *(pa.array(s, pa.int64()) for s in sums),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(pairs[rest], pa.int64())),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(each[rest], pa.int64())),
                ],
                names=[*plain, "n_best", "count_sum", "rest", "rest_times"],
            )

    kinds = ", ".join(f"{c} {sketch.schema[c].dataType.simpleString()}" for c in plain)
    return sketch.mapInArrow(run, f"{kinds}, n_best long, count_sum long, rest array<long>, rest_times array<long>")


def align_digest(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scratch = Scratch(docs.sparkSession, "alignment")
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketch = scratch.write(_sketch(named, a_path, b_path))
    counts = scratch.write(pair_counts(sketch))
    counts = scratch.write(_with_best(counts))
    # ties at the end of this list only decide which way a pair's count travels
    hot = counts.orderBy(F.desc("n"), "pair").limit(hot_pairs).collect()
    scored = _scored(sketch, [(r["pair"], r["n"], r["best"]) for r in hot])
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if len(hot) < hot_pairs:  # all pairs there are
        return scored.select(*out)
    scored = scratch.write(scored)
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x"))
    sums = (
        rest.select("row", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    )
    sums = scratch.write(sums)
    return (
        scored.join(sums, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0)))
        .select(*out)
    )
