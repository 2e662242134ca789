"""Exact deduplication by a tree merge of sorted digest runs.

Each input partition makes one run of digests. Runs meet in binomial rounds:
in a round, 16 neighbouring runs (``run >> 4``) are merged into one, and a
digest that stands in several of them keeps the largest identifier and the
summed count. So a digest that a third of all rows share is one row per run
after the first round, and at most 16 rows of a key meet in any later one.
The root's answer goes down the same tree: the rows of a run look it up under
(run, digest), so a hot digest is looked up in as many places as it has runs.

Two texts count as equal when SHA-256, byte length and a second, independent
64-bit hash of the lower-cased text agree; all three are in the merge key at
every level, so rows that differ in any of them never merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.llm.common import lower_ascii, stored, text_key

KEY = ["sha", "n_bytes", "check"]
FAN_BITS = 4


def digest_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its run, its digest key, its identifier and a row number."""
    text = F.encode(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), "UTF-8")
    return docs.select("doc_id", text_key().alias("text_key"), text.alias("body")).select(
        "doc_id", "text_key", F.monotonically_increasing_id().alias("row_id"),
        F.spark_partition_id().alias("run"), F.unhex(F.sha2("body", 256)).alias("sha"),
        F.octet_length("body").alias("n_bytes"), F.xxhash64("body").alias("check"))


def _merge(runs: DataFrame, bits: int) -> DataFrame:
    """Merge ``2 ** bits`` neighbouring runs into one, sorted by digest."""
    return (runs.groupBy(F.shiftright("run", bits).alias("run"), *KEY)
            .agg(F.max("best").alias("best"), F.sum("n").alias("n")))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (reads ``doc_id`` and ``text`` only; further
    columns, of any name, are ignored).

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Equal texts are
    those identical after lower-casing A-Z. The row with the largest doc_id
    stays. Null text counts as empty. A null doc_id is smaller than any other.
    Of repeated rows with one doc_id, exactly one is marked kept. An empty
    table gives an empty result.
    """
    return merged(docs).drop("text_key")


def merged(docs: DataFrame) -> DataFrame:
    """``exact_dedup`` with the key that tells rows apart."""
    leaf = stored(digest_runs(docs), "digest-runs")
    last = leaf.agg(F.max("run")).first()[0] or 0
    level = leaf.select("run", *KEY, F.struct("doc_id", "row_id").alias("best"), F.lit(1).cast("long").alias("n"))
    levels = [_merge(level, 0)]
    while last > 0:
        levels.append(_merge(levels[-1], FAN_BITS))
        last >>= FAN_BITS
    answer = levels.pop()
    while levels:
        child = levels.pop()
        up = answer.withColumnRenamed("run", "up")
        answer = (child.select("run", F.shiftright("run", FAN_BITS).alias("up"), *KEY)
                  .join(up, ["up", *KEY]).drop("up"))
    return leaf.join(answer, ["run", *KEY]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("best.row_id") == F.col("row_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "text_key")


SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
