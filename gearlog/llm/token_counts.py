"""Token counts of whole texts, long ones in overlapping chunks that are spliced.

A long text is encoded in chunks that overlap. Two neighbours are joined at a
boundary that both prove:

* The first chunk of a text starts where the text starts, so its words (the pieces
  the tokenizer cuts a text into before merging) are the text's, as long as they
  end far enough before the chunk's own end for what follows not to matter: a word
  that ends inside the chunk has been ended by a character of the chunk, and
  special strings reach no further than the longest of them.
* Where such a word ends and the next chunk starts a word as well, everything
  from there on is cut alike, because words depend on the text after their start
  only. So the next chunk's words are the text's from that boundary on, and so on.

If the overlap holds no common boundary (one word longer than the overlap), it is
widened until there is one, at most to the whole rest of the text.

Cases: a null or empty text has no tokens; repeated rows are repeated; special
strings inside texts become special tokens, as the library does by default; extra
columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Characters per chunk and in the overlap of two chunks.
CHUNK, OVERLAP = 1 << 15, 256


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def _margin(path: str) -> int:
    """Length of the longest special string."""
    added = _tokenizer(path).get_added_tokens_decoder().values()
    return max([1, *(len(a.content) for a in added)])


def _words(encoding, at: int) -> dict[int, int]:
    """Position in the text -> index of the token, for tokens that start a word."""
    out, last = {}, object()
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != last:
            out[at + start] = i
            last = word
    return out


def encode_long(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
    """Ids of a text of any length, in parts; memory holds two chunks."""
    tok, margin = _tokenizer(path), _margin(path)
    at, end = 0, min(len(text), chunk)
    left = tok.encode(text[at:end], add_special_tokens=False)
    first = 0  # first token of `left` that has not been given out
    while end < len(text):
        wide = overlap
        while True:
            start = max(at, end - wide)
            stop = min(len(text), max(end, start) + chunk)
            if start == at:  # the overlap has grown to the whole chunk: take both as one
                left = tok.encode(text[at:stop], add_special_tokens=False)
                end = stop
                break
            right = tok.encode(text[start:stop], add_special_tokens=False)
            ours, theirs = _words(left, at), _words(right, start)
            floor = at + left.offsets[first][0] if first < len(left) else at
            # a boundary at p is proven by a word of `left` that ends before its end
            common = [p for p in ours if max(start + 1, floor) <= p < end - margin and p in theirs]
            if common:
                cut = max(common)
                yield left.ids[first : ours[cut]]
                left, first, at, end = right, theirs[cut], start, stop
                break
            wide *= 2
    yield left.ids[first:]


def encode_ids(text: str | None, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    return [i for part in encode_long(text or "", path, chunk, overlap) for i in part]


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text.

    ``path`` is a tokenizers file that every executor can read.
    """
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            short = [t for t in texts if len(t) <= chunk]
            counts = iter([len(e) for e in tok.encode_batch_fast(short, add_special_tokens=False)])
            n = [
                next(counts) if len(t) <= chunk else sum(map(len, encode_long(t, path, chunk, overlap)))
                for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
