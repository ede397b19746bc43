"""Licence scans: TF-IDF cosine to templates, then inheritance along directories.

Every line of a file is compared with licence templates; a licence file (by name)
is also compared as a whole. Vectors are sparse: weights are term counts times the
inverse document frequency of template terms over all files (terms outside the
templates weigh like a term of no file). A line is looked at if it holds a cue
term. Cues are chosen from the templates so that a line without any of them can't
reach the threshold: the terms that aren't cues make up less than ``threshold`` of
each template's length, and by Cauchy-Schwarz bound the cosine.

A file takes the best licence of its own text. Else it inherits from the nearest
directory above it that holds a licence file with a known licence, by joining its
directory's ancestors with those directories.

Only DataFrame functions. Templates and their terms are a small parameter; they
are broadcast by size, and nothing else is.

Cases: a null text or path has no licence of its own, a null path inherits none;
ties go to the first licence in order of name; several licence files in a
directory count as one, the best match names it; repeated rows are repeated; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Short notices by which texts declare their licence.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

#: Names of licence files.
LICENSE_FILES = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][^/]*)?$"
THRESHOLD = 0.8
_TERMS = r"[^a-z0-9.]+"


def terms(text: Column) -> Column:
    """Lower-cased terms of letters, digits and inner full stops."""
    cut = F.split(F.lower(text), _TERMS)
    bare = F.transform(cut, lambda t: F.btrim(t, F.lit(".")))
    return F.filter(bare, lambda t: t != "")


def _words(text: str) -> list[str]:
    import re

    return [t for t in (x.strip(".") for x in re.split(_TERMS, text.lower())) if t]


def _count(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for w in words:
        out[w] = out.get(w, 0) + 1
    return out


def cue_terms(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms of which any text at the threshold must hold one."""
    cues: set[str] = set()
    for v in vectors:
        whole = math.sqrt(sum(x * x for x in v.values()))
        rest = sorted((t for t in v if t not in cues), key=lambda t: (-v[t], t))
        left = math.sqrt(sum(v[t] ** 2 for t in rest))
        while left >= 0.999 * threshold * whole and rest:
            cues.add(rest.pop(0))
            left = math.sqrt(sum(v[t] ** 2 for t in rest))
    return sorted(cues)


def scan_licenses(
    files: DataFrame,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, path, license, score, found (own, inherited or none), license_dir."""
    spark = files.sparkSession
    scratch = Scratch(spark, "licenses")
    notices = [(name, _count(_words(t))) for name, ts in (templates or TEMPLATES).items() for t in ts]
    vocabulary = sorted({w for _, c in notices for w in c})
    path = F.col(path_col)
    named = files.select(
        F.col(id_col).alias("doc_id"),
        path.alias("path"),
        F.col(text_col).alias("text"),
        F.coalesce(path.rlike(LICENSE_FILES), F.lit(False)).alias("is_license"),
    )
    # document frequency of template terms, over all files
    some = F.filter(
        F.array_distinct(terms(F.col("text"))), lambda t: F.array_contains(F.array(*map(F.lit, vocabulary)), t)
    )
    frequency = (
        named.filter("text IS NOT NULL")
        .select(F.explode(F.concat(F.array(F.lit("")), some)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    counted = {r["term"]: r["df"] for r in frequency.collect()}  # a row per template term
    total = counted.get("", 0)
    idf = {t: math.log((total + 1) / (counted.get(t, 0) + 1)) + 1 for t in vocabulary}
    other = math.log(total + 1) + 1
    vectors = [{t: n * idf[t] for t, n in c.items()} for _, c in notices]
    cues = cue_terms(vectors, threshold)
    lengths = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    weights = spark.createDataFrame(
        [
            (t, idf[t], [(k, v[t] / lengths[k]) for k, v in enumerate(vectors) if t in v])
            for t in vocabulary
        ],
        "term string, idf double, parts array<struct<k: int, share: double>>",
    )
    # lines that hold a cue, and licence files as a whole
    cue = r"(?<![a-z0-9])(" + "|".join(c.replace(".", r"\.") for c in cues) + r")(?![a-z0-9])"
    lines = F.filter(F.split("text", "\n"), lambda x: F.lower(x).rlike(cue))
    known = F.create_map(*[F.lit(x) for t in vocabulary for x in (t, idf[t])])
    whole = F.when(F.col("is_license"), terms(F.col("text")))
    named = named.withColumn("_weights", F.transform(whole, lambda t: F.element_at(known, t)))
    inside = F.aggregate(F.array_compact("_weights"), F.lit(0.0), lambda a, x: a + x)
    outside = F.size("_weights") - F.size(F.array_compact("_weights"))
    # a text is at least as long as its foreign terms, and its known part at most
    # as long as the sum of their weights: what can't reach the threshold goes
    may = outside * (other * other * threshold**2) <= (1 - threshold**2) * inside * inside * 1.001
    units = F.array_distinct(
        F.when(F.col("is_license") & may, F.concat(lines, F.array(F.col("text")))).otherwise(lines)
    )
    held = named.filter("text IS NOT NULL").select(
        "doc_id", "path", F.xxhash64("text").alias("_hash"), F.explode(units).alias("unit")
    )
    held = scratch.write(held.withColumn("unit_key", F.unhex(F.md5(F.col("unit").cast("binary")))))
    tf = (  # a line that many files share is scored once
        held.dropDuplicates(["unit_key"])
        .select("unit_key", F.explode(terms(F.col("unit"))).alias("term"))
        .groupBy("unit_key", "term")
        .agg(F.count("*").alias("tf"))
    )
    weighed = tf.join(F.broadcast(weights), "term", "left").withColumn(  # a row per template term
        "w", F.col("tf") * F.coalesce("idf", F.lit(other))
    )
    norms = F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length")
    shares = F.map_from_entries(F.coalesce("parts", F.array().cast("array<struct<k: int, share: double>>")))
    dots = [
        F.sum(F.col("w") * F.coalesce(F.element_at("shares", F.lit(k)), F.lit(0.0))).alias(f"d{k}")
        for k in range(len(notices))
    ]
    scores = weighed.withColumn("shares", shares).groupBy("unit_key").agg(norms, *dots)
    best = F.sort_array(
        F.array(
            *[
                F.struct(
                    (-F.round(F.col(f"d{k}") / F.col("length"), 6)).alias("minus"), F.lit(name).alias("license")
                )
                for k, (name, _) in enumerate(notices)
            ]
        )
    )[0]
    matched = scratch.write(
        scores.select("unit_key", best.alias("b")).filter(-F.col("b.minus") >= threshold)
    )
    own = (
        held.select("doc_id", "path", "_hash", "unit_key")
        .join(matched, "unit_key")
        .groupBy("doc_id", "path", "_hash")
        .agg(F.min("b").alias("b"))
    )
    scored = scratch.write(
        named.select("doc_id", "path", "is_license", F.xxhash64("text").alias("_hash")).join(
            own.select(
                F.col("doc_id").alias("_d"), F.col("path").alias("_p"), F.col("_hash").alias("_h"), "b"
            ),
            F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("path").eqNullSafe(F.col("_p")) & (F.col("_hash") == F.col("_h")),
            "left",
        ).select(
            "doc_id",
            "path",
            "is_license",
            F.regexp_replace("path", r"/?[^/]*$", "").alias("dir"),
            F.col("b.license").alias("license"),
            (-F.col("b.minus")).alias("score"),
        )
    )
    holders = (
        scored.filter("is_license AND license IS NOT NULL")
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("score")).alias("m"), "license")).alias("h"))
        .select(F.col("dir").alias("above"), F.col("h.license").alias("inherited"))
    )
    parts = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    nearest = scratch.write(
        scored.filter("dir IS NOT NULL")
        .select("dir")
        .distinct()
        .select("dir", F.explode(F.array_distinct(F.concat(above, F.array("dir")))).alias("above"))
        .join(holders, "above")
        .groupBy("dir")
        .agg(F.max(F.struct(F.length("above").alias("n"), "above", "inherited")).alias("near"))
        .select("dir", "near.above", "near.inherited")
    )
    joined = scored.join(nearest, "dir", "left")
    mine = F.col("license").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", "inherited").alias("license"),
        F.col("score"),
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(~mine, F.col("above")).alias("license_dir"),
    )


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files: ids give directories, round ids are licence files."""
    i = F.col("doc_id")
    text = lambda n: (i / n).cast("long").cast("string")
    path = (
        F.when(i % 1000 == 0, F.concat_ws("/", "source", F.lit("LICENSE")))
        .when(i % 100 == 0, F.concat_ws("/", "source", text(1000), F.lit("LICENSE")))
        .when(i % 10 == 0, F.concat_ws("/", "source", text(1000), text(100), F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", "source", text(1000), text(100), F.concat(i.cast("string"), F.lit(".txt"))))
    )
    return docs.select("doc_id", path.alias("path"), "text")
