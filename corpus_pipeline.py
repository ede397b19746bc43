"""A corpus pipeline of five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame, which
``run`` writes as Parquet to the shared folder and reads again as the next one's
documents, so a lost executor never costs more than the running stage. All stages
but the last return the columns of ``documents``.

1. language ID: texts without a language (null, or no letter) and ambiguous ones go.
   The classifiers learn from the labelled rows of the stage's own input.
2. line dedup: repeated multi-line chunks are removed from the texts, with DataFrame
   functions only. A document that shares half of its lines with the one that holds a
   chunk first keeps the chunk, or the next stage couldn't know it as a copy; rows that
   lose all their words go.
3. MinHash near-dedup: one document of each group stays, that of smallest id.
4. benchmark decontamination: documents that hold a benchmark item go.
5. SentencePiece: ids and decoded text of what is left, as checksums.

Cases: an empty table passes through all stages as an empty table; rows with null
ids pass the stages that decide by id, as nothing can be said against them; rows
that were empty before line dedup stay; repeated rows share their decision.
Extra columns of the input are carried along until the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearlog.llm import decontaminate, language, line_dedup, near_dups, pieces
from gearlog.llm.common import Scratch, table


#: Share of lines in common from which line dedup leaves a document to near-dedup.
COPY_SHARE = 0.5


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose doc_id isn't in ``gone`` (column gone_id); null ids stay."""
    return docs.join(gone.distinct(), docs["doc_id"] == gone["gone_id"], "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.identify(docs)
    rejected = found.filter((F.col("lang_pred") == language.UNKNOWN) | F.col("ambiguous"))
    return _without(docs, rejected.select(F.col("doc_id").alias("gone_id")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_documents(docs, copy_share=COPY_SHARE, keep_emptied=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(docs).filter("NOT kept")
    return _without(docs, found.select(F.col("doc_id").alias("gone_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, leaks.select(F.col("doc_id").alias("gone_id")))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pieces", encode_pieces),
]

#: Trained classifiers, random walks and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
