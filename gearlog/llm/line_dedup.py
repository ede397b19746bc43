"""Removal of repeated multi-line chunks, cut where the content says so.

A rolling hash over the hashes of two successive lines with words stands at every such
line. A chunk ends where it is smaller than at the line before and not greater than at
the next one. So the cuts depend on the lines around them alone and come back to the
same places after lines have been inserted or removed before; two cuts are never at
neighbouring lines, so every chunk has two lines with words at least (unless the text
has one only). Lines without words belong to the line before.

A chunk that occurs more than once in all documents is removed everywhere but at its
first place (smallest doc_id, then position), after its bytes have been compared with
those of the first place. A passage seldom starts and ends where a chunk does, so each
removal goes on line by line, before and behind the chunk, as long as the lines of the
neighbouring chunk equal those next to the first place. Every line that goes is held
by an earlier place, so one copy of each always stays.

Only DataFrame functions: what is shuffled are chunk hashes, then the texts of
documents with a repeated chunk, then the repeated chunks with their neighbours.

Cases: a null text stays null and an empty one empty; lines are split at \\n only;
rows with the same doc_id and text are one document and get the same result; a
null doc_id sorts first; chunks whose hashes agree but bytes differ stay; a text
whose every line is repeated becomes empty and its row stays; an empty table
gives no rows; extra columns are kept by ``dedup_documents`` and not read.

With ``copy_share``, a document that has at least this share of its distinct lines with
words in common with the document of a chunk's first place is a copy of it and keeps
the chunk, so that a later step can know copies as copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

_LEAST_ID = -(2**63)
_WORD = r"[^\x20\x09-\x0D]"
_KEYS = ["_id", "_hash"]


def with_chunks(df: DataFrame, text: str) -> DataFrame:
    """Add ``_lines``, ``_worded`` (numbers of lines with words) and ``_ends`` (number of
    the last line of every chunk).

    Every step is a column of its own that the next one reads more than once, so
    none is worked out again inside another's loop.
    """
    line = lambda i: F.element_at("_lines", i)
    df = df.withColumn("_lines", F.split(F.col(text), "\n"))
    numbers = F.sequence(F.lit(1), F.size("_lines"))
    df = df.withColumn("_worded", F.filter(numbers, lambda i: line(i).rlike(_WORD)))
    df = df.withColumn("_hashes", F.transform("_worded", lambda i: F.md5(line(i).cast("binary"))))

    def rolling(own: Column, k: Column) -> Column:  # k: from 0; "~" is above all hashes
        before = F.element_at("_hashes", F.greatest(k, F.lit(1)))
        return F.when(k == 0, F.lit("~")).otherwise(F.md5(F.concat(before, own).cast("binary")))

    df = df.withColumn("_rolling", F.transform("_hashes", rolling))
    at = lambda k: F.element_at("_rolling", k)
    inner = F.when(F.size("_rolling") >= 4, F.sequence(F.lit(2), F.size("_rolling") - 2))
    cuts = F.filter(
        F.coalesce(inner, F.array().cast("array<int>")), lambda k: (at(k) < at(k - 1)) & (at(k) <= at(k + 1))
    )
    df = df.withColumn("_cuts", cuts)
    ends = F.concat(F.transform("_cuts", lambda k: F.element_at("_worded", k + 1) - 1), F.array(F.size("_lines")))
    return df.withColumn("_ends", ends).drop("_hashes", "_rolling", "_cuts")


def _first_line(k: Column) -> Column:
    """Number of the first line of chunk k (from 0)."""
    return F.when(k == 0, F.lit(1)).otherwise(F.element_at("_ends", F.greatest(k, F.lit(1))) + 1)


def _chunk(k: Column) -> Column:
    """Lines of chunk k; none outside of the text."""
    inside = (k >= 0) & (k < F.size("_ends"))
    safe = F.when(inside, k).otherwise(F.lit(0))
    first = _first_line(safe)
    size = F.when(inside, F.element_at("_ends", safe + 1) - first + 1).otherwise(F.lit(0))
    return F.slice("_lines", first, size)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    return (
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST_ID)),
        F.xxhash64(F.col(text_col)),
    )


def _copies(scratch: Scratch, found: DataFrame, held: DataFrame, share: float) -> DataFrame:
    """(_id, _hash, first._id, first._hash) of documents with that share of their lines
    in the document of a first place."""
    other = (F.col("_id") != F.col("first._id")) | (F.col("_hash") != F.col("first._hash"))
    pairs = found.filter(other).select(*_KEYS, F.struct("first._id", "first._hash").alias("of")).distinct()
    marks = F.transform(F.filter("_lines", lambda x: x.rlike(_WORD)), lambda x: F.xxhash64(x))
    lines = scratch.write(held.select(*_KEYS, F.array_distinct(marks).alias("marks")).dropDuplicates(_KEYS))
    of = lines.select(F.struct(*_KEYS).alias("of"), F.col("marks").alias("theirs"))
    both = F.size(F.array_intersect("marks", "theirs"))
    return (
        pairs.join(lines, _KEYS)
        .join(of, "of")
        .filter(both >= F.size("marks") * share)
        .select(*_KEYS, "of", F.lit(True).alias("copy"))
    )


def _equal_run(a: str, b: str) -> Column:
    """How many elements two arrays have in common from their start."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, F.lit(False))
    return F.when(stop > 0, stop - 1).otherwise(F.size(same)).cast("int")


def _cleaned_texts(docs: DataFrame, id_col: str, text_col: str, copy_share: float | None) -> DataFrame:
    """(_id, _hash, _clean, _n_chunks, _n_lines) of documents that lose something."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    own_id, own_hash = _keyed(docs, id_col, text_col)
    named = docs.filter(F.col(text_col).isNotNull()).select(
        own_id.alias("_id"), own_hash.alias("_hash"), F.col(text_col).alias("_text")
    )
    hashes = F.transform(
        "_ends",
        lambda _, k: F.when(F.size("_worded") >= 2, F.md5(F.array_join(_chunk(k), "\n").cast("binary"))),
    )
    places = scratch.write(
        with_chunks(named, "_text")
        .select(*_KEYS, F.posexplode(hashes).alias("pos", "chunk"))
        .filter("chunk IS NOT NULL")
    )
    place = F.struct(*_KEYS, "pos")
    repeated = scratch.write(  # more than one place (rows of one document are one place)
        places.groupBy("chunk")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first <> last")
        .select("chunk", "first")
    )
    found = scratch.write(places.join(repeated, "chunk"))
    keys = found.select(*_KEYS).distinct()
    held = scratch.write(
        with_chunks(named.join(keys, _KEYS, "left_semi"), "_text").drop("_text", "_worded")
    )
    if copy_share is None:
        drop = place != F.col("first")
    else:
        copies = scratch.write(_copies(scratch, found, held, copy_share))
        found = found.withColumn("of", F.struct("first._id", "first._hash")).join(copies, [*_KEYS, "of"], "left")
        own = F.struct(*_KEYS) == F.col("of")
        earliest = F.min("pos").over(Window.partitionBy(*_KEYS, "chunk"))
        drop = ~(own | F.coalesce("copy", F.lit(False))) | (F.col("pos") != earliest)
    mark = F.struct("pos", "chunk", drop.alias("drop"), (place == F.col("first")).alias("is_first"))
    marked = found.select(*_KEYS, mark.alias("mark")).groupBy(*_KEYS).agg(F.collect_set("mark").alias("marks"))

    def shown(m: Column) -> Column:
        pos = m["pos"]
        return F.struct(
            m["chunk"].alias("chunk"),
            m["drop"].alias("drop"),
            m["is_first"].alias("is_first"),
            _first_line(pos).alias("lo"),
            F.element_at("_ends", pos + 1).alias("hi"),
            F.array_join(_chunk(pos), "\n").alias("body"),
            F.reverse(_chunk(pos - 1)).alias("before"),
            _chunk(pos + 1).alias("after"),
        )

    seen = scratch.write(
        held.join(scratch.write(marked), _KEYS)
        .select(*_KEYS, F.explode(F.transform("marks", shown)).alias("m"))
        .filter("m.drop OR m.is_first")
        .select(*_KEYS, "m.*")
        .dropDuplicates([*_KEYS, "lo"])  # repeated rows are one document
    )
    firsts = seen.filter("is_first").select(
        "chunk", F.col("body").alias("_body"), F.col("before").alias("_before"), F.col("after").alias("_after")
    )
    gone = (
        seen.filter("drop")
        .join(firsts, "chunk")
        .filter("body = _body")
        .select(
            *_KEYS,
            (F.col("lo") - _equal_run("before", "_before")).alias("lo"),
            (F.col("hi") + _equal_run("after", "_after")).alias("hi"),
        )
        .groupBy(*_KEYS)
        .agg(
            F.array_distinct(F.flatten(F.collect_list(F.sequence("lo", "hi")))).alias("gone"),
            F.count("*").cast("int").alias("_n_chunks"),
        )
    )
    lines = held.select(*_KEYS, "_lines").join(scratch.write(gone), _KEYS)
    kept = F.array_except(F.sequence(F.lit(1), F.size("_lines")), "gone")
    return scratch.write(
        lines.withColumn("_kept", kept).select(
            *_KEYS,
            F.array_join(F.transform("_kept", lambda i: F.element_at("_lines", i)), "\n").alias("_clean"),
            "_n_chunks",
            F.size("gone").alias("_n_lines"),
        ).dropDuplicates(_KEYS)
    )


def _cleaned(docs: DataFrame, id_col: str, text_col: str, copy_share: float | None = None) -> DataFrame:
    """All rows as ``_row``, the result in ``_clean`` and counts of what went."""
    own_id, own_hash = _keyed(docs, id_col, text_col)
    changed = _cleaned_texts(docs, id_col, text_col, copy_share)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), own_id.alias("_id"), own_hash.alias("_hash"))
    return rows.join(changed, _KEYS, "left").select(
        "_row",
        F.coalesce(F.col("_clean"), F.col("_row")[text_col]).alias("_clean"),
        F.coalesce("_n_chunks", F.lit(0)).alias("_n_chunks"),
        F.coalesce("_n_lines", F.lit(0)).alias("_n_lines"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, cleaned text, chunks and lines removed, for every document."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _cleaned(named, "doc_id", "text").select(
        "_row.doc_id",
        F.col("_clean").alias("text"),
        F.col("_n_chunks").cast("long").alias("n_chunks_removed"),
        F.col("_n_lines").cast("long").alias("n_lines_removed"),
    )


def dedup_documents(docs: DataFrame, copy_share: float | None = None, keep_emptied: bool = True) -> DataFrame:
    """The documents themselves with cleaned ``text`` (and ``n_chars``, if present).

    Without ``keep_emptied`` rows go that lost all their words here.
    """
    clean = _cleaned(docs, "doc_id", "text", copy_share)
    if not keep_emptied:
        clean = clean.filter((F.col("_n_lines") == 0) | F.col("_clean").rlike(_WORD))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_clean").alias("text"))
        elif c == "n_chars":
            changed = F.char_length("_clean").cast(docs.schema[c].dataType)
            columns.append(F.when(F.col("_n_lines") > 0, changed).otherwise(F.col("_row")[c]).alias(c))
        else:
            columns.append(F.col("_row")[c].alias(c))
    return clean.select(*columns)


#: The same rule over DuckDB's lists, with md5 as the hash.
SQL = r"""
WITH docs AS (
  SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, text AS whole, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM docs
), worded AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY doc_id, whole) AS u,
         lead(i) OVER w AS next_i, coalesce(md5(concat(lag(md5(line)) OVER w, md5(line))), '') AS rolled
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  WINDOW w AS (PARTITION BY doc_id, whole ORDER BY i)
), rolling AS (
  SELECT *, CASE WHEN k = 1 THEN '~' ELSE rolled END AS r FROM worded
), cuts AS (
  SELECT doc_id, whole, next_i - 1 AS i
  FROM (SELECT *, lag(r) OVER w AS r0, lead(r) OVER w AS r2 FROM rolling
        WINDOW w AS (PARTITION BY doc_id, whole ORDER BY i))
  WHERE k BETWEEN 2 AND u - 2 AND r < r0 AND r <= r2
), numbered AS (
  SELECT l.*, coalesce(sum((c.i IS NOT NULL)::INT) OVER (
      PARTITION BY doc_id, whole ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM lines l LEFT JOIN cuts c USING (doc_id, whole, i)
), chunks AS (
  SELECT doc_id, whole, pos, string_agg(line, chr(10) ORDER BY i) AS body, list(line ORDER BY i) AS ls,
         min(i) AS lo, max(i) AS hi
  FROM numbered GROUP BY doc_id, whole, pos
), placed AS (
  SELECT *, coalesce(list_reverse(lag(ls) OVER w), []) AS b4, coalesce(lead(ls) OVER w, []) AS aft
  FROM chunks WINDOW w AS (PARTITION BY doc_id, whole ORDER BY pos)
), ranked AS (
  SELECT p.*, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS nth
  FROM placed p JOIN (SELECT DISTINCT doc_id, whole FROM worded WHERE u >= 2) USING (doc_id, whole)
), pairs AS (
  SELECT p.doc_id, p.whole, p.lo, p.hi, p.b4 AS b1, f.b4 AS b2, p.aft AS a1, f.aft AS a2
  FROM ranked p JOIN ranked f ON f.body = p.body AND f.nth = 1 WHERE p.nth > 1
), drops AS (
  SELECT doc_id, whole,
         lo - coalesce(nullif(list_position(list_transform(range(1, least(len(b1), len(b2)) + 1),
                lambda j: b1[j] = b2[j]), false), 0) - 1, least(len(b1), len(b2))) AS lo,
         hi + coalesce(nullif(list_position(list_transform(range(1, least(len(a1), len(a2)) + 1),
                lambda j: a1[j] = a2[j]), false), 0) - 1, least(len(a1), len(a2))) AS hi
  FROM pairs
), gone AS (
  SELECT DISTINCT doc_id, whole, unnest(range(lo, hi + 1)) AS i FROM drops
), clean AS (
  SELECT doc_id, whole, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (g.doc_id IS NULL), '') AS text,
         count(g.doc_id)::BIGINT AS n_lines_removed
  FROM lines l LEFT JOIN gone g USING (doc_id, whole, i) GROUP BY doc_id, whole
), counts AS (
  SELECT doc_id, whole, count(*) AS n_chunks_removed FROM drops GROUP BY doc_id, whole
)
SELECT d.doc_id, c.text, coalesce(n_chunks_removed, 0) AS n_chunks_removed,
       coalesce(n_lines_removed, 0) AS n_lines_removed
FROM documents d LEFT JOIN clean c ON d.doc_id = c.doc_id AND d.text = c.whole
LEFT JOIN counts n ON d.doc_id = n.doc_id AND d.text = n.whole
"""
