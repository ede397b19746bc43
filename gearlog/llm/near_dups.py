"""Near duplicates by one-permutation MinHash with optimal densification.

1. Each document becomes the set of its distinct five-word shingles (64-bit
   hashes of lower-cased words). One pass over the sorted set gives one minimum
   per bin; an empty bin takes the value of the first filled bin in its own random
   order of bins, which keeps each bin's match probability at the Jaccard index.
2. Equal sets collapse into one class, so copies never meet in pairs.
3. Bands of the signature are bucket keys. In a bucket every class is paired with
   one hub: a star, not all pairs. Pairs are confirmed on the full sets. Bands go in a
   few groups; ends that an earlier group has joined aren't compared again.
4. A member that the hub didn't confirm may still belong to another member. Where
   the members of a hub make up several components, each gets an upper bound: its
   shingles that any other of these documents has. A document whose bound rules out
   every partner of its group's sizes is settled without meeting anyone. The few
   that are left go back to their buckets for ``ROUNDS`` rounds, each with a new hub,
   drawn by hash, for every bucket that isn't one component yet. So the pairs tried
   are at most (1 + ROUNDS) times the bucket rows, whatever a bucket holds. A link is
   missed only where no chain of links leads from one end over these hubs to the other;
   README has the recall measured against all pairs.

Cases: a null text, or one without words, has an empty set and links with
nothing; fewer than five words make one shingle of the whole sequence; rows with
equal doc_id are one node, linked by any of their texts; a null doc_id is kept
with a null component and ``kept`` false; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, is_empty, slices
from .components import components
from .words import batch_words, grams, mix

WORDS, BINS, ROWS_PER_BAND = 5, 240, 5
_order = np.random.default_rng(77)
#: For each bin a random order of all bins, where a filled one is looked for.
_PROBES = np.stack([_order.permutation(BINS) for _ in range(BINS)])
_PROBES = np.concatenate([np.arange(BINS)[:, None], _PROBES], axis=1)
_EDGES = (np.arange(BINS, dtype=object) * 2**64 // BINS).astype(np.uint64)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]  # bytes: A-Z only
    hashes, _, _, first = batch_words(data)
    every = grams(hashes, WORDS)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            s = np.sort(every[a : b - WORDS + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(grams(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """One minimum per bin of the hash range, empty bins filled from others."""
    at = np.searchsorted(shingles, _EDGES)
    filled = np.diff(at, append=len(shingles)) > 0
    values = shingles[np.minimum(at, len(shingles) - 1)]
    if filled.all():
        return values
    empty = np.flatnonzero(~filled)
    probes = _PROBES[empty]
    values[empty] = values[probes[np.arange(len(empty)), np.argmax(filled[probes], axis=1)]]
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """Bucket keys: one number for each band of rows, the band's index included."""
    grid = values.reshape(-1, ROWS_PER_BAND)
    out = np.arange(len(grid), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS_PER_BAND):
        out = mix(out + grid[:, k])
    return out


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _digest(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        sets = shingle_sets(b.column(1).to_pylist())
        keys = [bands(signature(s)) if len(s) else np.zeros(0, np.uint64) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
                _lists(keys),
            ],
            names=["doc_id", "n_shingles", "digest", "bands"],
        )


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        sets = shingle_sets(b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_digest(s) for s in sets], pa.binary()), _lists(sets)],
            names=["rep", "digest", "set"],
        )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold_pct: int = 75
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept."""
    scratch = Scratch(docs.sparkSession, "near-dups")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = scratch.write(
        named.mapInArrow(_sketch, "doc_id long, n_shingles long, digest binary, bands array<long>")
    )
    classes = scratch.write(  # one row for each distinct non-empty set with a document
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    )
    edges, found = _links(scratch, named, classes, threshold_pct)
    # rows of one doc_id with different sets are one node
    same = (
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
        .filter("lo <> hi")
        .select("doc_id")
    )
    tied = (
        rows.filter("n_shingles > 0")
        .join(same, "doc_id")
        .join(classes.select("digest", "rep"), "digest")
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
        .filter("u <> v")
    )
    tied = scratch.write(tied)
    if found is None or not is_empty(tied):
        found = _components(scratch, edges.unionByName(tied), edges.count() + tied.count())
    placed = scratch.write(
        classes.join(found, "rep", "left").select(
            "digest", F.coalesce("component", "rep").alias("linked")
        )
    )
    out = (
        rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
        .join(placed, "digest", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("linked", "doc_id")))
    )
    return out.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(False)).alias("kept"),
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The (u, v) pairs whose full sets are similar enough."""
    a = sets.select(F.col("rep").alias("u"), F.col("set").alias("su"))
    ends = sets.join(pairs.select(F.col("v").alias("rep")).distinct(), "rep", "left_semi")
    b = ends.select(F.col("rep").alias("v"), F.col("set").alias("sv"))
    small, large = F.least(F.size("su"), F.size("sv")), F.greatest(F.size("su"), F.size("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    return (
        pairs.join(a, "u")
        .join(b, "v")
        .filter(small * 100 >= large * pct)
        .select("u", "v", both.alias("both"), (small + large).alias("sum"))
        .filter(F.col("both") * 100 >= (F.col("sum") - F.col("both")) * pct)
        .select("u", "v")
        .distinct()
    )


def _components(scratch: Scratch, edges: DataFrame, rows: int) -> DataFrame:
    return scratch.write(components(scratch, edges, rows).withColumnRenamed("node", "rep"), 2 * rows)


#: Bits of the map that holds back texts nobody asks for: 4 MB to broadcast.
MAP_BITS = 1 << 25


def _marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose id's bit is set: all of ``wanted``, and few others while ``wanted``
    is small against the map. Texts of the rest never reach a shuffle."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))
    bits = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("_bucket"))
    maps = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("_map"))
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (
        docs.withColumn("_bucket", F.bitmap_bucket_number(spot))
        .join(F.broadcast(maps), "_bucket")  # at most MAP_BITS / 32768 rows of 4 KB
        .filter(F.getbit(byte, (at % 8).cast("int")) == 1)
        .drop("_bucket", "_map")
    )


#: Bands are tried in groups that end here. Ends that earlier groups have brought into
#: one component aren't compared again, so most copies meet one or two hubs, not 48.
BAND_GROUPS = (3, 12, BINS // ROWS_PER_BAND)


def _apart(pairs: DataFrame, found: DataFrame | None) -> DataFrame:
    """The (u, v) pairs whose ends aren't in one component yet."""
    if found is None:
        return pairs
    a = found.select(F.col("rep").alias("u"), F.col("component").alias("cu"))
    b = found.select(F.col("rep").alias("v"), F.col("component").alias("cv"))
    return (
        pairs.join(a, "u", "left")
        .join(b, "v", "left")
        .filter(F.coalesce("cu", "u") != F.coalesce("cv", "v"))
        .select("u", "v")
    )


def _grown(scratch: Scratch, edges: DataFrame, found: DataFrame | None, new: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Edges with ``new`` ones, and their components worked out from the old ones."""
    stars = new if found is None else new.unionByName(
        found.filter("rep <> component").select(F.col("rep").alias("u"), F.col("component").alias("v"))
    )
    return edges.unionByName(new), _components(scratch, stars, rows)


def _links(
    scratch: Scratch, named: DataFrame, classes: DataFrame, pct: int
) -> tuple[DataFrame, DataFrame | None]:
    """Confirmed links (u, v) between documents that represent classes, and their
    components (None if there are none)."""
    buckets = classes.select(F.posexplode("bands").alias("band", "key"), "rep")
    shared = scratch.write(  # hub of every bucket with more than one class
        buckets.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("other")).filter("hub <> other")
    )
    members = scratch.write(
        buckets.join(shared.select("key", "hub"), "key")
        .filter("rep <> hub")
        .groupBy(F.col("rep").alias("u"), F.col("hub").alias("v"))
        .agg(F.min("band").alias("band"))
    )
    n_pairs = members.count()
    if n_pairs == 0:
        return members.select("u", "v"), None
    wanted = scratch.write(members.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), 2 * n_pairs)
    sets = scratch.write(
        _marked(named, wanted)
        .join(wanted, "doc_id", "left_semi")
        .mapInArrow(_full, "rep long, digest binary, set array<long>")
        .join(classes.select("rep", "digest"), ["rep", "digest"], "left_semi")
        .dropDuplicates(["rep", "digest"])
        .drop("digest")
    )
    edges, found, first = members.select("u", "v").filter(F.lit(False)), None, 0
    for last in BAND_GROUPS:
        here = members.filter((F.col("band") >= first) & (F.col("band") < last)).select("u", "v")
        new = scratch.write(_confirmed(scratch.write(_apart(here, found), n_pairs), sets, pct))
        if not is_empty(new):
            edges, found = _grown(scratch, edges, found, new, 2 * n_pairs)
        first = last
    if found is None:
        found = members.select(F.col("u").alias("rep"), F.col("v").alias("component")).filter(F.lit(False))
    tried = members.select("u", "v")
    open_docs = _open_documents(scratch, tried, n_pairs, found, sets, pct)
    if is_empty(open_docs):
        return edges, found
    # their buckets, without the hubs that have met them all
    left = scratch.write(
        classes.join(open_docs, "rep")
        .select(F.explode("bands").alias("key"), "rep", "n", "core")
        .join(shared.select("key", "hub"), "key")
        .filter("rep <> hub")
        .select("key", "rep", "n", "core")
        .distinct()
    )
    return _rounds(scratch, left, tried, edges, found, sets, pct)


def _open_documents(
    scratch: Scratch, tried: DataFrame, n_pairs: int, found: DataFrame, sets: DataFrame, pct: int
) -> DataFrame:
    """(rep, n, core) of documents that may have a link which no hub has shown: set
    size, and shingles that another such document may share."""
    members = tried.select(F.col("v").alias("hub"), F.col("u").alias("rep")).unionByName(
        tried.select(F.col("v").alias("hub"), F.col("v").alias("rep")).distinct()
    )
    sizes = sets.groupBy("rep").agg(F.min(F.size("set")).alias("n"))
    members = scratch.write(
        members.join(found, "rep", "left")
        .withColumn("comp", F.coalesce("component", "rep"))
        .select("hub", "rep", "comp")
        .join(sizes, "rep"),
        2 * n_pairs,
    )
    for _ in range(2):  # a second look, without the documents that the first has settled
        mixed = (
            members.groupBy("hub")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least"))
            .filter("lo <> hi")
            .select("hub", "least")
        )
        mixed = scratch.write(mixed, n_pairs)
        members = scratch.write(members.join(mixed, "hub").select("hub", "rep", "comp", "n", "least"), 2 * n_pairs)
        held = sets.join(members.select("rep").distinct(), "rep", "left_semi").select(
            "rep", F.explode("set").alias("shingle")
        )
        held = scratch.write(held)
        common = held.groupBy("shingle").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi")
        bound = held.join(common.select("shingle"), "shingle").groupBy("rep").agg(F.count("*").alias("core"))
        # |x & y| <= core(x), so core(x) must reach the overlap that the smallest partner needs
        least = F.greatest(F.col("least"), F.ceil(F.col("n") * pct / 100))
        members = scratch.write(
            members.join(bound, "rep")
            .filter(F.col("core") * (100 + pct) >= pct * (F.col("n") + least))
            .drop("least"),
            2 * n_pairs,
        )
        scratch.drop(held)
    mixed = members.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    left = members.join(mixed.select("hub"), "hub", "left_semi").select("rep", "n", "core").distinct()
    return scratch.write(left, n_pairs)


#: Further rounds, each with one new hub for every bucket that isn't one component.
ROUNDS = 6


def _rounds(
    scratch: Scratch,
    left: DataFrame,
    tried: DataFrame,
    edges: DataFrame,
    found: DataFrame,
    sets: DataFrame,
    pct: int,
) -> tuple[DataFrame, DataFrame]:
    """Links with those that further hubs of the buckets ``left`` (key, rep, n, core)
    show. The hub of a round is the member with the least hash of (id, round), which is
    the same one in most of the buckets it is in, so a document meets few of them."""
    n = left.count()
    for number in range(ROUNDS):
        rest = scratch.write(
            left.join(found, "rep", "left").select(
                "key", "rep", "n", "core", F.coalesce("component", "rep").alias("comp")
            ),
            n,
        )
        lot = F.struct(F.xxhash64("rep", F.lit(number)).alias("lot"), "rep", "comp", "n", "core")
        hubs = (
            rest.groupBy("key")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(lot).alias("hub"))
            .filter("lo <> hi")
            .select("key", "hub")
        )
        hubs = scratch.write(hubs, n)
        if is_empty(hubs):
            break
        # what two sets share is in the core of both, and a link needs this much of it
        enough = F.least("core", "hub.core") * (100 + pct) >= pct * (F.col("n") + F.col("hub.n"))
        pairs = (
            rest.join(hubs, "key")
            .filter((F.col("comp") != F.col("hub.comp")) & enough)
            .select(F.greatest("rep", "hub.rep").alias("u"), F.least("rep", "hub.rep").alias("v"))
            .distinct()
        )
        pairs = scratch.write(pairs.join(tried, ["u", "v"], "left_anti"), n)
        new = scratch.write(_confirmed(pairs, sets, pct))
        if not is_empty(new):
            edges, found = _grown(scratch, edges, found, new, 2 * n)
        tried = scratch.write(tried.unionByName(pairs))
        scratch.drop(rest, hubs)
    return edges, found
