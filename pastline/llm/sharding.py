"""Shards with the same mixture of sources: proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; a row's fractional
rank is ``(rank - u) / rows of the source`` with a seeded ``u`` in (0, 1) per
source. Sorted by it, the rows of every source are spread evenly, so any cut
into consecutive ranges holds each source in its overall share.

No rank is taken over a whole source. Both ranks use buckets of about
``bucket_rows`` rows: rows are numbered inside a bucket and the rows of the
buckets before are added from a table of bucket counts. Buckets come from a
hash (first rank) and from the fractional rank itself (second rank); both are
uniform by construction, so a source with a third of all rows fills many
buckets of the usual size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pastline.llm.common import stored

BUCKET_ROWS = 1 << 14


def interleaved_shards(docs: DataFrame, shards: int = 40, seed: str = "shard-0",
                       bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text, source; others are ignored).

    Columns: doc_id, size (UTF-8 bytes + 16), text_crc32, law ('rows'), shard,
    slot, grown_shard (null). Shard counts differ by one at most. Null text:
    size 16 and the checksum of the empty text. Null sources are a stratum of
    their own. Rows with one doc_id are told apart by their place in the input.
    An empty table gives an empty result.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    # 60 bits of a hash of the id, as a number
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10)
    stratum = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = stored(docs.select(
        "doc_id", stratum.alias("stratum"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), key.cast("long").alias("key"),
        F.monotonically_increasing_id().alias("row_id")), "shard-rows")
    total = rows.count()
    bits = max(0, (max(1, total // bucket_rows) - 1).bit_length())

    rows = rows.withColumn("bucket", F.shiftright("key", 60 - bits))
    inside = Window.partitionBy("stratum", "bucket").orderBy("key", "doc_id", "row_id")
    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("stratum", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy("stratum")).alias("of"))
    start = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.col("stratum"))), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    ranked = (rows.withColumn("rank", F.row_number().over(inside)).join(counts, ["stratum", "bucket"])
              .withColumn("at", (F.col("before") + F.col("rank") - start) / F.col("of")).drop("bucket"))

    ranked = ranked.withColumn("bucket", F.floor(F.col("at") * (1 << bits)))
    inside = Window.partitionBy("bucket").orderBy("at", "key", "doc_id", "row_id")
    counts = ranked.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    counts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before2"))
    place = ranked.withColumn("rank2", F.row_number().over(inside)).join(counts, "bucket").withColumn(
        "place", F.col("before2") + F.col("rank2") - 1)
    return place.withColumn("shard", F.expr(f"((place + 1) * {shards} - 1) div {max(1, total)}")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.expr(f"place - (shard * {total}L) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.expr("nullif(substr(stratum, 2), '')").alias("stratum"))


SQL = """
WITH RECURSIVE
bits(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
t AS (SELECT doc_id, coalesce('=' || source, '') AS stratum, hex(encode(coalesce(text, ''))) AS h,
             ('0x' || substr(md5('shard-0:' || doc_id), 1, 15))::BIGINT AS key FROM documents),
r AS (SELECT *, octet_length(from_hex(h)) + 16 AS size, row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id) AS rank,
             count(*) OVER (PARTITION BY stratum) AS of FROM t),
f AS (SELECT *, (rank - ((('0x' || substr(md5('shard-0/' || stratum), 1, 8))::BIGINT)::DOUBLE + 0.5) / 4294967296.0) / of AS frac FROM r),
p AS (SELECT *, row_number() OVER (ORDER BY frac, key, doc_id) - 1 AS place, count(*) OVER () AS total FROM f),
s AS (SELECT *, (((place + 1) * 40 - 1) // total)::INT AS shard FROM p)
SELECT doc_id, size::BIGINT AS size,
       xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(from_hex(h))),
           lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
           lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8)))::BIGINT AS text_crc32,
       'rows' AS law, shard, (place - (shard * total) // 40)::BIGINT AS slot, NULL::INT AS grown_shard, nullif(substr(stratum, 2), '') AS stratum
FROM s, crc
"""
