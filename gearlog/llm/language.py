"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. For each bit one linear classifier
over hashed byte n-grams learns which half of the languages a text belongs to.
A text's margins are decoded against all codewords: each bit's logistic loss is
weighted by how often that bit's classifier was right for that language in
training, and the nearest codeword wins. Little distance to the runner-up flags
the text as ambiguous.

The classifiers are fitted on a bounded sample of labelled rows (``per_language``
rows of each language and ``sample_rows`` in all, taken by hash, whole texts).
Prediction reads every whole text.

Cases: a text that is null or has no letter is ``und`` with score 0; without any
labelled row every text is ``und``; with one language every text with a letter
has it; ties go to the first language in order of name; repeated rows are
repeated; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

UNKNOWN = "und"
#: Hashed features, rows of the training sample, share of the runner-up's loss.
FEATURES, PER_LANGUAGE, SAMPLE_ROWS, AMBIGUOUS = 4096, 600, 6000, 0.05
_LETTER = re.compile(r"[^\W\d_]")
#: Texts are counted in pieces of this many bytes.
PIECE = 1 << 20


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1 bits: all splits of the languages, or random codes for many."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        bits = [[1 if (k >> i) & 1 else -1 for i in range(n)] for k in range(1, 2 ** (n - 1))]
        return np.array(bits, float).T
    width = 6 * int(np.ceil(np.log2(n)))
    rng, best, least = np.random.default_rng(5), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if apart > least and (abs(code.sum(0)) < n).all():
            best, least = code, apart
    return best


def features(text: str) -> np.ndarray:
    """Square-rooted counts of hashed byte 2- to 4-grams, of length one."""
    data = text.lower().encode("utf-8", "replace")
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, len(data), PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + 3, len(data) - at), at).astype(np.uint32)
        code = b[:-1] << 8 | b[1:]
        for n in (2, 3, 4):
            if n > 2:
                code = code[:-1] << 8 | b[n - 1 :]
            if len(code) == 0:
                break
            size = min(len(code), PIECE)
            h = (code[:size] * np.uint32(2654435761) + np.uint32(n * 977)) >> np.uint32(20)
            counts += np.bincount(h, minlength=FEATURES)
    x = np.sqrt(counts, dtype=np.float32)
    norm = np.sqrt(counts.sum())
    return x / np.float32(norm) if norm else x


@dataclass
class Codes:
    """Fitted classifiers: one column of weights for each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray  # languages x bits, rows sum to 1

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, gap to the runner-up) of feature rows."""
        margins = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        distance = (loss * self.trust[None]).sum(2)
        best = distance.argmin(1)
        chance = np.exp(-8 * (distance - distance.min(1, keepdims=True)))
        chance /= chance.sum(1, keepdims=True)
        if len(self.languages) == 1:
            return best, np.ones(len(x)), np.ones(len(x))
        two = np.sort(distance, 1)[:, :2]
        return best, chance[np.arange(len(x)), best], (two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1e-9)


def fit(x: np.ndarray, labels: list[str], steps: int = 300, rate: float = 8.0, decay: float = 1e-4) -> Codes:
    """Logistic regression of every bit at once, by accelerated gradient steps."""
    languages = sorted(set(labels))
    y_index = np.array([languages.index(v) for v in labels])
    code = codewords(len(languages))
    target = code[y_index]
    share = np.bincount(y_index, minlength=len(languages))
    row = (1 / share[y_index] / len(languages))[:, None]  # languages count alike
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1])
    w_ahead, b_ahead = w, bias
    for t in range(steps if len(languages) > 1 else 0):
        z = np.clip((x @ w_ahead + b_ahead) * target, -40, 40)
        pull = (row * target / (1 + np.exp(z))).astype(np.float32)
        w_next = w_ahead + rate * (x.T @ pull - decay * w_ahead)
        b_next = b_ahead + rate * pull.sum(0) / 4
        push = t / (t + 3)
        w_ahead, b_ahead = w_next + push * (w_next - w), b_next + push * (b_next - bias)
        w, bias = w_next, b_next
    right = ((x @ w + bias) * target > 0).astype(float)
    trust = np.stack([right[y_index == i].mean(0) for i in range(len(languages))]) + 1e-3
    return Codes(languages, code, w.astype(np.float32), bias, trust / trust.sum(1, keepdims=True))


def held_out(id_col: str) -> F.Column:
    """True where crc32 of the id as text is a multiple of 5 (or the id is null)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> Codes | None:
    """Fit on rows that aren't held out; None without labelled rows."""
    text, lang = F.col(text_col), F.col(lang_col)
    usable = docs.filter(~held_out(id_col) & text.isNotNull() & lang.isNotNull() & text.rlike(r"\p{L}"))
    sizes = {r[0]: r[1] for r in usable.groupBy(lang.alias("lang")).agg(F.count("*")).collect()}
    if not sizes:
        return None
    wanted = max(1, min(per_language, sample_rows // len(sizes)))
    spark = docs.sparkSession
    shares = spark.createDataFrame(
        [(k, min(1.0, wanted / n)) for k, n in sizes.items()], "_lang string, _share double"
    )
    # a hash below the language's share: about `wanted` rows of each, in no task's order
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1_000_003)) / 1_000_003.0
    sample = (
        usable.join(F.broadcast(shares), lang == F.col("_lang"))  # a row per language
        .filter(chance < F.col("_share"))
        .select(F.col("_lang").alias("lang"), text.alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [features(t).astype(np.float16).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["lang", "x"])

    # at most `sample_rows` rows: their order is settled here, not by a shuffle
    found = sorted(map(tuple, sample.mapInArrow(run, "lang string, x binary").collect()))
    if not found:
        return None
    x = np.stack([np.frombuffer(r[1], np.float16) for r in found]).astype(np.float32)
    return fit(x, [r[0] for r in found])


def predict(
    docs: DataFrame, model: Codes | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every whole text."""
    kept = docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(2).to_pylist()
            lang, score, doubt = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            known = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
            if known:
                best, chance, gap = model.decode(np.stack([features(texts[i]) for i in known]))
                for i, k, c, g in zip(known, best, chance, gap):
                    lang[i], score[i], doubt[i] = model.languages[k], float(c), bool(g < AMBIGUOUS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang), pa.array(score, pa.float64()), pa.array(doubt)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
