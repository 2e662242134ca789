"""Registered queries of the subpackage: ``QUERIES`` (name -> builder) and ``SQL`` (name -> DuckDB text)."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pastline.llm import bpe, exact_dedup, langid, merkle, minhash, packing, pii, quality, secrets, sharding, simhash, spelling, toxicity
from pastline.llm.common import source_table

Builder = Callable[[SparkSession, str], DataFrame]


def _documents(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Builder:
    return lambda spark, sf_dir: operator(source_table(spark, sf_dir, "documents", *columns))


QUERIES: dict[str, Builder] = {
    "pipeline": corpus_pipeline.run,
    "op1_toxicity": toxicity.toxicity_query,
    "op2_quality_rules": quality.quality_query,
    "op3_byte_bpe": _documents(lambda d: bpe.bpe_documents(d, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), "doc_id", "text"),
    "op4_packing": _documents(lambda d: packing.pack_documents(d, public_tokenizers.path("word_bpe_49k.json")), "doc_id", "text"),
    "op5_exact_dedup": _documents(exact_dedup.exact_dedup, "doc_id", "text"),
    "op6_secret_scans": secrets.secrets_query,
    "op7_language_id": _documents(langid.identify_language, "doc_id", "text", "lang"),
    "op8_sharding": _documents(sharding.interleaved_shards, "doc_id", "text", "source"),
    "op9_pii_surrogates": _documents(pii.surrogate_pii, "doc_id", "text"),
    "op10_minhash_near_dedup": _documents(lambda d: minhash.near_dedup(d, words=2), "doc_id", "text"),
    "op11_spelling_variants": _documents(spelling.spelling_variants, "doc_id", "text"),
    "op12_simhash_near_dedup": _documents(simhash.simhash_near_dedup, "doc_id", "text"),
    "op13_merkle_manifest": _documents(merkle.merkle_manifest, "doc_id", "source", "lang", "n_chars", "text"),
}
SQL: dict[str, str] = {
    "op2_quality_rules": quality.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_secret_scans": secrets.SQL,
    "op8_sharding": sharding.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
