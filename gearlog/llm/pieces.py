"""SentencePiece encoding that keeps source offsets, and decoding.

The model's own normaliser is redone with its source alignment. At every position
the longest entry of the compiled character map that is a prefix of the rest of
the text is replaced by its normal form (one character stays as it is where no
entry fits); white space is trimmed, merged, escaped and prefixed as the model
asks. Every normalised byte remembers the source byte it came from, so each piece
gets the byte span of the original text that it stands for.

The normalised text is then cut at white space where no piece of the vocabulary
crosses such a cut (merges then never cross it either), and every distinct word is
encoded once by the library with its normaliser turned off; words are found by
64-bit hash in a bounded memory per task. Models whose pieces do cross are encoded
whole.

Cases: a null text counts as empty; an empty text has only the begin and end ids;
repeated rows are repeated; bytes that no piece covers become byte pieces or the
unknown id, as the model asks; extra columns are not read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import mix, word_hashes

_ONLY_SPACE = np.arange(256) == 0x20
SPACE = "▁"  # the mark that stands for white space in pieces
_MARK = SPACE.encode()
#: Distinct words remembered per task.
WORDS_KEPT = 400_000


class CharMap:
    """Longest-prefix lookup in a compiled character map.

    The map is a double-array trie over UTF-8 bytes, whose values point at
    zero-ended normal forms in one string of them.
    """

    def __init__(self, blob: bytes):
        self.units: np.ndarray | list[int] = []
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.forms = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, normal form) of the longest entry at ``at``."""
        units = self.units
        if not units:
            return None
        found = None
        node = 0
        step = units[0]
        node ^= (step >> 10) << ((step & 0x200) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if (unit & 0x800000FF) != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if (unit >> 8) & 1:
                value = units[node] & 0x7FFFFFFF
                found = i + 1 - at, value
        if found is None:
            return None
        return found[0], self.forms[found[1] : self.forms.index(b"\0", found[1])]


def _char_size(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Pieces:
    """One model: normalising with alignment, ids, spans, decoding."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        spec = proto.normalizer_spec
        self.charmap = CharMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix_marks = proto.trainer_spec.treat_whitespace_as_suffix
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=blob)
        kinds = [p.type for p in proto.pieces]
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        self.by_word = (
            proto.trainer_spec.model_type == 2  # merges of pairs
            and self.escape
            and not self.suffix_marks
            and 4 not in kinds  # no user-defined pieces
            and not any(crossing.search(p.piece) for p in proto.pieces if p.type == 1)
        )
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        spec.precompiled_charsmap = b""
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.fast = self.by_word and not self.charmap.units and not self.trim and self.prefix and kinds.count(6) == 256
        self.forget()
        # normalised bytes of each id; -1: unknown, its length is what no piece covers
        self.sizes = np.array(
            [1 if k == 6 else 0 if k == 3 else -1 if k == 2 else len(p.piece.encode()) for p, k in zip(proto.pieces, kinds)]
        )

    def normalise(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) its source byte."""
        if not self.charmap.units:
            data = np.frombuffer(raw, np.uint8)
            source = np.arange(len(data) + 1)
        else:
            out, source_list, at = [], [], 0
            while at < len(raw):
                hit = self.charmap.longest(raw, at)
                if hit:
                    taken, form = hit
                else:
                    taken = min(_char_size(raw[at]), len(raw) - at)
                    form = raw[at : at + taken]
                out.append(form)
                source_list += [at] * len(form)
                at += taken
            data = np.frombuffer(b"".join(out), np.uint8)
            source = np.array([*source_list, len(raw)], np.int64)
        space = data == 0x20
        if self.trim and len(data):  # no leading, trailing or repeated spaces
            after = np.concatenate([[True], space[:-1]])
            keep = ~(space & after)
            kept = np.flatnonzero(keep)
            if len(kept) and space[kept[-1]]:
                keep[kept[-1]] = False
                end = source[kept[-1]]
            else:
                end = source[kept[-1] + 1] if len(kept) else source[0]
            data, space = data[keep], space[keep]
            source = np.append(source[:-1][keep], end)
        if not len(data):
            return b"", source[-1:]
        if self.escape:
            counts = np.where(space, len(_MARK), 1)
            text = data.tobytes().replace(b" ", _MARK)
            source = np.append(np.repeat(source[:-1], counts), source[-1])
        else:
            text = data.tobytes()
        if self.prefix:
            mark = _MARK if self.escape else b" "
            fill = np.full(len(mark), source[0] if not self.suffix_marks else source[-1])
            if self.suffix_marks:
                text, source = text + mark, np.concatenate([source[:-1], fill, source[-1:]])
            else:
                text, source = mark + text, np.concatenate([fill, source])
        return text, source

    def forget(self) -> None:
        """Words known so far: hash -> slot; a slot's ids lie together in ``flat``."""
        self.slots: dict[int, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, keys: list[int], parts: list[str]) -> None:
        ids = self.plain.encode(parts, num_threads=1)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        base, first = len(self.flat), len(self.slots)
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.starts = np.concatenate([self.starts, base + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.slots.update(zip(keys, range(first, first + len(keys))))

    def _encode_words(self, raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begins, ends) of non-empty texts without a literal mark, all at once."""
        joined = b" " + b"  ".join(raws) + b" "  # each text has a prefix and a separator
        sizes = np.fromiter((len(r) + 2 for r in raws), np.int64, len(raws))
        begin = np.cumsum(sizes) - sizes
        stop = begin + sizes - 1  # where the separator is
        hashes, starts, ends = word_hashes(joined, _ONLY_SPACE)
        first = np.searchsorted(starts, np.append(begin, len(joined)))
        owner = np.repeat(np.arange(len(raws)), np.diff(first))
        before = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        lead = starts - np.maximum(before, begin[owner])
        last = begin.copy()
        some = np.diff(first) > 0
        last[some] = ends[first[1:][some] - 1]
        tail = stop - last  # spaces after a text's last word are a part of their own
        with_tail = np.flatnonzero(tail > 0)
        keys = np.concatenate(
            [mix(hashes ^ mix(lead.astype(np.uint64))), mix(mix(tail[with_tail].astype(np.uint64)))]
        )
        from_at = np.concatenate([starts - lead, last[with_tail]])
        to_at = np.concatenate([ends, stop[with_tail]])
        order = np.argsort(from_at)
        keys, from_at, to_at = keys[order], from_at[order], to_at[order]
        part_owner = np.searchsorted(begin, from_at, "right") - 1
        distinct, place, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.slots) + len(distinct) > WORDS_KEPT:
            self.forget()
        names = distinct.tolist()
        new = [k for k, name in enumerate(names) if name not in self.slots]
        if new:
            cut = [joined[a:b].decode() for a, b in zip(from_at[place[new]].tolist(), to_at[place[new]].tolist())]
            self._learn([names[k] for k in new], cut)
        slot = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))[inverse]
        counts = self.counts[slot]
        total = np.cumsum(counts)
        ids = self.flat[np.repeat(self.starts[slot] - total + counts, counts) + np.arange(total[-1])]
        # ends of pieces in escaped bytes, then the source byte of each
        space = np.frombuffer(joined, np.uint8) == 0x20
        space[stop] = False
        width = np.where(space, len(_MARK), 1)
        width[stop] = 0
        source = np.repeat(np.arange(len(joined)), width)
        piece = self.sizes[ids]
        reach = np.cumsum(piece)
        source = np.append(source, len(joined) - 1)
        per_text = np.bincount(part_owner, counts, len(raws)).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum(per_text)])
        out = []
        bos, eos = self.whole.bos_id(), self.whole.eos_id()
        left, right = source[reach - piece], source[reach]
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            base, size = int(begin[k]) + 1, len(raws[k])
            lo = np.clip(left[a:b] - base, 0, size)
            hi = np.clip(right[a:b] - base, 0, size)
            hi[-1:] = size
            out.append((
                np.concatenate([[bos], ids[a:b], [eos]]).astype(np.int32),
                np.concatenate([[0], lo, [size]]),
                np.concatenate([[0], hi, [size]]),
            ))
        return out

    def encode_batch(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids with begin and end, first byte, end byte) of each text."""
        raws = [(t or "").encode("utf-8", "replace") for t in texts]
        quick = [k for k, r in enumerate(raws) if self.fast and r and _MARK not in r]
        found = dict(zip(quick, self._encode_words([raws[k] for k in quick]) if quick else []))
        out = []
        for k, raw in enumerate(raws):
            if k not in found:
                ids = self.encode(raw.decode())
                found[k] = np.array(ids, np.int32), *self.spans(raw.decode(), ids)
            out.append(found[k])
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids with begin and end."""
        raw = (text or "").encode("utf-8", "replace")
        ids = self.plain.encode(self.normalise(raw)[0].decode()) if self.escape else self.whole.encode(raw.decode())
        return [self.whole.bos_id(), *ids, self.whole.eos_id()]

    def spans(self, text: str | None, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and last source byte (exclusive) of each id; begin and end are empty."""
        normal, source = self.normalise((text or "").encode("utf-8", "replace"))
        sizes = self.sizes[ids]
        if (sizes < 0).any():  # an unknown run reaches to where the next known piece starts
            sizes = sizes.copy()
            at = 0
            for i, n in enumerate(sizes.tolist()):
                if n < 0:
                    nxt = self.whole.id_to_piece(ids[i + 1]).encode() if i + 1 < len(ids) - 1 else b""
                    stop = normal.find(nxt, at + 1) if nxt else len(normal)
                    sizes[i] = n = (stop if stop >= 0 else len(normal)) - at
                at += n
        ends = np.cumsum(sizes)
        return source[ends - sizes], source[np.minimum(ends, len(normal))]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids with begin and end, byte spans of each id, decoded text."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            found = model.encode_batch(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    pa.array([f[2] for f in found], pa.list_(pa.int64())),
                    pa.array([model.whole.decode(f[0].tolist()) for f in found], pa.string()),
                ],
                names=["doc_id", "ids", "begins", "ends", "decoded"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(
        run, f"doc_id {kind}, ids array<int>, begins array<long>, ends array<long>, decoded string"
    )


def ids_digest(ids: np.ndarray) -> str:
    return sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()


def encode_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, checksums of ids and decoded text, bytes that pieces span."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            found = model.encode_batch(texts)
            covered = [int((e - a).sum()) for _, a, e in found]
            decoded = [sha256(model.whole.decode(i.tolist()).encode()).hexdigest() for i, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(i) for i, _, _ in found], pa.int64()),
                    pa.array([ids_digest(i) for i, _, _ in found], pa.string()),
                    pa.array(decoded, pa.string()),
                    pa.array(covered, pa.int64()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes_covered"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(
        run,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes_covered long",
    )
