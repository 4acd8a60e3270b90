"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's docs. All but the last return the columns
of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.llm import decontamination, jaccard_join, language_id, packing, secret_scans
from vidlens.llm.common import materialize, prepare, table

LONG_TEXT = 200
LEAST_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, and texts of ``LONG_TEXT`` characters or more that
    are far from every learned language. Shorter texts tell too little to be
    rejected by their score. Without any label nothing can be judged and all stay."""
    prepare(spark)
    labels, protos = language_id.learn(docs)
    if not labels:
        return docs
    judged = language_id.judge(docs, labels, protos)
    far = (F.char_length("text") >= LONG_TEXT) & (F.col("__lang.score") < LEAST_SCORE)
    return judged.where((F.col("__lang.lang_pred") != language_id.UNKNOWN) & ~far).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more)
    the smallest doc_id stays. Rows under one id stay or go together."""
    prepare(spark)
    found = jaccard_join.jaccard_components(docs, k=5, percent=80)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("__kept")), "left_semi")


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to a similarity of 0.8, go."""
    hits = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    ids = hits.select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(F.col("__hit")), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    prepare(spark)
    return secret_scans.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_texts),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
