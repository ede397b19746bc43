"""Learned decision lists over text statistics.

Sequential covering learns which labelled texts are poor: a rule grows by adding
the threshold that gains most information on one part of the labelled rows, is
pruned on the other part by dropping last conditions, and is kept while it stays
precise there; the rows it covers leave both parts and the next rule begins. The
ordered rules become one Spark conditional expression over the statistics, so a
verdict can be read, changed and explained.

The rules are learned from a bounded sample of labelled rows (``sample_rows``, by
hash of the id). Statistics are taken from every whole text.

Cases: a null or empty text has no words, so its base check fails; labels that
disagree for one id go by their mean (a tie counts as good); ids without a text,
or labels without a quality, teach nothing; without any labels there are no rules
and the base check decides alone; repeated rows are repeated; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import batch_words, grams, mix

#: Bounds and settings of the learner.
SAMPLE_ROWS, MOST_RULES, MOST_CONDITIONS, PRECISION, THRESHOLDS = 20000, 12, 4, 0.9, 48
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks"]

_is = {name: np.zeros(256, bool) for name in ("symbol", "upper", "digit", "mark")}
_is["symbol"][list(SYMBOLS.encode())] = True
_is["upper"][65:91] = _is["digit"][48:58] = True
_is["mark"][list(b"!?")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80
_BLANK = " \t\n\r\x0b\x0c"


def _dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    n = 0
    for line in lines:
        if line in seen:
            n += bool(line.strip(_BLANK))
        else:
            seen.add(line)
    return n


def text_counts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The columns of COUNTS for each text."""
    known = [t or "" for t in texts]
    data = [t.encode("utf-8", "replace") for t in known]
    hashes, starts, ends, first = batch_words(data)
    joined = np.frombuffer(b"\n".join(data), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
    n = np.diff(first)

    def per_text(marks: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks)])
        return total[np.minimum(begins[1:] - 1, len(joined))] - total[begins[:-1]]

    leads = np.concatenate([[0], np.cumsum(_LEAD[joined])])
    word_size = np.concatenate([[0], np.cumsum(leads[ends] - leads[starts])])
    # words inside a three-word window that its text holds twice
    repeated = np.zeros(len(hashes) + 1, np.int64)
    owner = np.repeat(np.arange(len(data)), n)
    if len(hashes) >= 3:
        inside = owner[2:] == owner[:-2]
        at = np.flatnonzero(inside)
        key = grams(hashes, 3)[at] ^ mix(owner[at].astype(np.uint64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        for k in range(3):
            repeated[at[twice] + k] = 1
    covered = np.concatenate([[0], np.cumsum(repeated[:-1])])
    return {
        "n_words": n,
        "word_chars": word_size[first[1:]] - word_size[first[:-1]],
        "n_symbols": per_text(_is["symbol"][joined]),
        "n_dup_lines": np.array([_dup_lines(t) for t in known], np.int64),
        "n_repeat_words": covered[first[1:]] - covered[first[:-1]],
        "n_lines": np.array([t.count("\n") + 1 for t in known], np.int64),
        "n_upper": per_text(_is["upper"][joined]),
        "n_digits": per_text(_is["digit"][joined]),
        "n_marks": per_text(_is["mark"][joined]),
    }


def statistics(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and the counts of every whole text."""
    kept = docs.select(*keys, F.col(text_col).alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[: len(keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            counts = text_counts(b.column(len(keys)).to_pylist())
            columns = [b.column(i) for i in range(len(keys))]
            columns += [pa.array(counts[c], pa.int64()) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *COUNTS])

    return kept.mapInArrow(run, ", ".join([head, *[f"{c} long" for c in COUNTS]]))


#: Features of a rule, as Spark expressions over the counts (x100 for shares).
def measures() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_100_words": 100 * F.col("n_symbols") / words,
        "marks_per_100_words": 100 * F.col("n_marks") / words,
        "duplicate_line_share": 100 * F.col("n_dup_lines") / F.col("n_lines"),
        "repeated_word_share": 100 * F.col("n_repeat_words") / words,
        "upper_share": 100 * F.col("n_upper") / chars,
        "digit_share": 100 * F.col("n_digits") / chars,
        "words_per_line": F.col("n_words") / F.col("n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    limit: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.measure] > self.limit if self.above else x[self.measure] <= self.limit

    def expression(self) -> Column:
        m = measures()[self.measure]
        return m > self.limit if self.above else m <= self.limit

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.limit:.6g}"


def _covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: dict[str, np.ndarray], poor: np.ndarray, on: np.ndarray) -> Condition | None:
    """The threshold with the largest information gain among covered rows."""
    p0, n0 = (poor & on).sum(), on.sum()
    if p0 == 0 or p0 == n0:
        return None
    base, best, most = np.log2(p0 / n0), None, 1e-9
    for name in x:
        v = x[name][on]
        cuts = np.unique(np.quantile(v, np.linspace(0, 1, THRESHOLDS), method="lower"))
        order = np.searchsorted(cuts, v)  # rows at or below each cut
        below_all = np.cumsum(np.bincount(order, minlength=len(cuts)))[: len(cuts)]
        below_poor = np.cumsum(np.bincount(order, poor[on], len(cuts)))[: len(cuts)]
        for above in (False, True):
            p = p0 - below_poor if above else below_poor
            n = n0 - below_all if above else below_all
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / np.maximum(n, 1)) - base), 0)
            k = int(gain.argmax())
            if gain[k] > most:
                most, best = gain[k], Condition(name, above, float(cuts[k]))
    return best


def learn(x: dict[str, np.ndarray], poor: np.ndarray) -> list[list[Condition]]:
    """Ordered rules that find poor rows, by sequential covering."""
    n = len(poor)
    # every third row, in a fixed random order, is for pruning
    part = np.random.default_rng(3).permutation(n) % 3 == 0
    live = np.ones(n, bool)
    rules: list[list[Condition]] = []
    while len(rules) < MOST_RULES:
        grow, prune = live & ~part, live & part
        rule: list[Condition] = []
        on = grow.copy()
        while len(rule) < MOST_CONDITIONS and (c := _best_condition(x, poor, on)):
            rule.append(c)
            on &= c.holds(x)

        def worth(r: list[Condition], rows: np.ndarray) -> tuple[float, float, float]:
            hit = _covers(r, x, n) & rows
            p, all_hit = float((hit & poor).sum()), float(hit.sum())
            return (p + 1) / (all_hit + 2), p, p / max(all_hit, 1)

        candidates = [rule[:k] for k in range(1, len(rule) + 1)]
        if not candidates:
            break
        # the shortest form of the best value on the pruning rows
        rule = max(candidates, key=lambda r: (round(worth(r, prune)[0], 3), -len(r)))
        _, found, precise = worth(rule, prune)
        hit = _covers(rule, x, n) & live
        if precise < PRECISION or found < 2 or (hit & poor).sum() < PRECISION * hit.sum():
            break
        rules.append(rule)
        live &= ~hit
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that holds (1, 2, ...), 0 if none does."""
    out: Column | None = None
    for i, rule in enumerate(rules, 1):
        both = rule[0].expression()
        for c in rule[1:]:
            both = both & c.expression()
        out = F.when(both, F.lit(i)) if out is None else out.when(both, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> list[list[Condition]]:
    per_id = (
        labels.filter(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.avg(quality_col) < 0.5).alias("poor"))
    )
    # the rows with the smallest hashes: a top-k, merged from each task's own
    chosen = per_id.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    known = texts.join(F.broadcast(chosen), "_id")  # at most sample_rows ids
    stats = statistics(known, ["_id", "poor"], "_text")
    found = stats.select("poor", *[v.cast("double").alias(k) for k, v in measures().items()])
    rows = found.orderBy("_id", *COUNTS).toPandas()
    if rows.empty:
        return []
    x = {k: rows[k].to_numpy(float) for k in measures()}
    return learn(x, rows["poor"].to_numpy(bool))


def judge(docs: DataFrame, rules: list[list[Condition]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the contract's counts, base_failed, rule (0: none) and kept."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        statistics(named, ["doc_id"], "_text")
        .withColumns({"base_failed": base, "rule": verdict(rules)})
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "rule",
            (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
        )
    )


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, train(docs, labels))
