"""Registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    decontaminate,
    html_text,
    language,
    licenses,
    line_dedup,
    near_dups,
    pieces,
    prefix_trie,
    quality_rules,
    sharding,
    token_counts,
    vantage,
)
from .common import table


def op1_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_digest(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op3_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_digest(table(spark, sf_dir, "documents"), path)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(licenses.as_files(table(spark, sf_dir, "documents")))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op11_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_digest(table(spark, sf_dir, "documents"), *paths)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_lpt_shards,
        op2_main_text,
        op3_language_codes,
        op4_token_counts,
        op5_pieces,
        op6_quality_rules,
        op7_line_chunks,
        op8_license_scan,
        op9_benchmark_leaks,
        op10_near_duplicates,
        op11_vantage_neighbours,
        op12_prefix_trie,
        op13_token_alignment,
    )
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    sql = {"op7_line_chunks": line_dedup.SQL, "op12_prefix_trie": prefix_trie.SQL}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
