"""The corpus pipeline: each stage works on all its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns the columns of
``documents``, but for the last, which returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.llm import exact_dedup, minhash, packing, quality, secrets
from pastline.llm.common import keep_rows, source_table, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or a certified cutoff rejects go."""
    return quality.keep_good(docs, source_table(spark, sf_dir, "labels", "doc_id", "quality"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return keep_rows(docs, exact_dedup.merged(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return keep_rows(docs, minhash.grouped(docs))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; n_chars follows the text."""
    masked = secrets.mask_secrets(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))) if "n_chars" in docs.columns else masked


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, packed into windows of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: Similarity groups and tokens have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
