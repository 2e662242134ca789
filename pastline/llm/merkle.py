"""A Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf; the leaves of a source form a tree of runs of three, and
the sources' roots form the tree above. A node carries the interval
``[lo, hi)`` of the leaf ranks it covers and its level, so no parent pointers
are kept: a node at level L lies in the bucket ``lo div 3^L``, its ancestors
are the nodes whose interval contains its own (found by an equality join on
level and bucket), and its siblings are what is left of the run inside the
parent's interval when its own interval is taken away.

Trees are built in tiers of ``TIER`` levels. A tier groups ``3 ** TIER``
neighbouring nodes, so no group grows with its source; a hot source is only
more groups. Leaf ranks come from one range partition of the rows' digests;
texts are read once, in the first scan, and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pastline.llm.common import stored

FAN, TIER = 3, 5
#: Powers of FAN that a 64-bit rank can need.
POWERS = [FAN ** i for i in range(40)]
PATH = "array<struct<before:binary,after:binary>>"


def framed(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(text: Column) -> Column:
    """The 32 bytes of the text's SHA-256."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(text: Column) -> Column:
    return digest(F.concat(*[framed(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)]))


_POWERS = "array(" + ", ".join(f"{p}L" for p in POWERS) + ")"


def power(level: str) -> Column:
    """``FAN ** level`` of a SQL expression."""
    return F.expr(f"get({_POWERS}, {level})")


def over(rank: Column, by: Column) -> Column:
    return F.call_function("div", rank, by)


def height(n: str = "n") -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.expr(f"size(filter({_POWERS}, p -> p < {n}))")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``rank`` in its tree, in the given order, and the tree's size ``n``.

    One range partition by (tree, order); the place in a partition is counted
    there, the rows of a tree in the partitions before come from a table with
    one row per partition and tree.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed, "ranked").withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    of_tree = Window.partitionBy("tree")
    counts = counts.select("part", "tree", "first", F.sum("rows").over(of_tree).alias("n"), F.coalesce(
        F.sum("rows").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(counts, ["part", "tree"]).withColumn("rank", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def tier_nodes(base: DataFrame, low: int, tier: int) -> DataFrame:
    """Nodes (tree, n, level, lo, hi, digest) of levels ``low`` to ``low + tier`` above ``base`` (tree, n, lo, digest at ``low``)."""
    group = base.groupBy("tree", "n", over(F.col("lo"), F.lit(POWERS[low + tier])).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("lo", "digest"))).alias("run"))  # FAN ** tier at most
    group = group.select("tree", "n", "bucket", F.transform("run", lambda x: as_hex(x["digest"])).alias("h0"))

    def parents(below: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int")),
                           lambda j: F.sha2(F.array_join(F.slice(below, j * FAN + 1, F.lit(FAN)), "").cast("binary"), 256))

    def labelled(name: str, i: int) -> Column:
        return F.transform(name, lambda d, j: F.struct(
            F.lit(low + i).alias("level"), (F.col("bucket") * POWERS[low + tier] + j * POWERS[low + i]).alias("lo"), F.unhex(d).alias("digest")))

    for i in range(tier):
        grown = F.when(height() > low + i, parents(F.col(f"h{i}"))).otherwise(F.array().cast("array<string>"))
        group = group.withColumn(f"h{i + 1}", grown)
    each = F.flatten(F.array(*[labelled(f"h{i}", i) for i in range(tier + 1)]))
    return group.select("tree", "n", F.inline(each)).select(
        "tree", "n", "level", "lo", F.least(F.col("lo") + power("level"), "n").alias("hi"), "digest")


def siblings(nodes: DataFrame) -> DataFrame:
    """(tree, level, lo, hi, before, after): what the parent's interval holds beside the node's, joined left and right of it."""
    runs = nodes.filter(F.col("level") < height()).groupBy(
        "tree", "level", over(F.col("lo"), power("level + 1")).alias("parent")).agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("run"))  # FAN at most
    each = runs.select("tree", "level", "run", F.inline("run"))

    def joined(part: Column) -> Column:
        return F.aggregate(part, F.lit(b""), lambda acc, x: F.concat(acc, x["digest"]))

    return each.select("tree", "level", "lo", "hi",
                       joined(F.filter("run", lambda x: x["hi"] <= F.col("lo"))).alias("before"),
                       joined(F.filter("run", lambda x: x["lo"] >= F.col("hi"))).alias("after"))


def tier_paths(base: DataFrame, kin: DataFrame, low: int, tier: int) -> DataFrame:
    """(tree, lo, path): siblings of each base node's ancestors inside the tier, its own first, bottom up."""
    top = F.least(height(), F.lit(low + tier)) - 1
    asked = base.filter(height() > low).select("tree", F.col("lo").alias("at"), F.explode(F.sequence(F.lit(low), top)).alias("level"))
    asked = asked.withColumn("bucket", over(F.col("at"), power("level")))
    held = kin.withColumn("bucket", over(F.col("lo"), power("level")))
    found = asked.join(held, ["tree", "level", "bucket"]).filter("at >= lo and at < hi")
    path = F.transform(F.sort_array(F.collect_list(F.struct("level", "before", "after"))), lambda x: F.struct(x["before"].alias("before"), x["after"].alias("after")))
    return found.groupBy("tree", F.col("at").alias("lo")).agg(path.alias("path"))


def proofs(leaves: DataFrame, tier: int = TIER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``leaves`` (tree, n, rank, digest): paths (tree, lo, path) of the leaves inside their lowest block of
    ``FAN ** tier``, blocks (tree, block, path from there to the tree's root), and roots (tree, n, digest)."""
    base = leaves.select("tree", "n", F.col("rank").alias("lo"), "digest")
    largest = base.agg(F.max("n")).first()[0] or 0
    low, own, blocks, roots = 0, [], None, None
    while low == 0 or POWERS[low] < largest:
        nodes = stored(tier_nodes(base, low, tier), "merkle-nodes")
        paths = tier_paths(base, siblings(nodes), low, tier)
        own.append((low, base, stored(paths, "merkle-paths") if low else paths))
        done = nodes.filter(F.col("level") == height()).select("tree", "n", "digest")
        roots = done if roots is None else roots.unionByName(done)
        base = nodes.filter((F.col("level") == low + tier) & (F.col("level") < height())).select("tree", "n", "lo", "digest")
        low += tier
    none = F.array().cast(PATH)
    for low, base, paths in reversed(own[1:]):  # from the top tier down
        path = base.select("tree", "lo").join(paths, ["tree", "lo"], "left").withColumn("path", F.coalesce("path", none))
        if blocks is not None:
            path = path.withColumn("block", over(F.col("lo"), F.lit(POWERS[low + tier]))).join(
                blocks.withColumnRenamed("path", "above"), ["tree", "block"], "left").withColumn("path", F.concat("path", F.coalesce("above", none)))
        blocks = path.select("tree", over(F.col("lo"), F.lit(POWERS[low])).alias("block"), "path")
    if blocks is None:
        blocks = leaves.select("tree", F.lit(0).cast("long").alias("block"), none.alias("path")).limit(0)
    return own[0][2], blocks, roots


def merkle_manifest(docs: DataFrame, tier: int = TIER) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, source, lang, n_chars, text; others are ignored).

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    ``folded_root`` is the root recomputed from the leaf and its siblings,
    where the leaf of a row with an even crc32 of its id is that of the text
    without line feeds; ``verified`` tells whether it equals the root. Nulls
    in any column are the value ``-`` of the leaf; null sources are a tree of
    their own, the first; null ids come first in a source and are not
    tampered with. Rows that repeat an id ascend by their leaf; equal rows are
    leaves of their own, each with its own place. A lone leaf is its tree's
    root. An empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, leaf_digest(F.replace(text, F.lit("\n"), F.lit(""))))
    rows = docs.select("doc_id", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
                       leaf_digest(text).alias("digest"), tampered.alias("tampered"))
    leaves = ranked(rows, ["doc_id", "digest"])
    leaves = leaves.withColumn("tampered", F.coalesce("tampered", "digest"))
    paths, blocks, subroots = proofs(leaves, tier)

    # the tree of the sources
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = ranked(tops, ["of"])
    above, far, root = proofs(tops, tier)
    source = tops.withColumn("lo", F.col("rank")).join(above, ["tree", "lo"], "left").withColumn("block", over(F.col("rank"), F.lit(POWERS[tier]))).join(
        far.withColumnRenamed("path", "rest"), ["tree", "block"], "left").join(root.select("tree", F.col("digest").alias("root")), "tree")
    none = F.array().cast(PATH)
    source = stored(source.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root",
                                  F.concat(F.coalesce("path", none), F.coalesce("rest", none)).alias("last")), "merkle-sources")

    # heads: for each block of leaves all that lies above it
    block = over(F.col("rank"), F.lit(POWERS[tier]))
    heads = leaves.select("tree", block.alias("block")).distinct().join(blocks, ["tree", "block"], "left").join(source, "tree").select(
        "tree", "block", "subroot", "root", F.concat(F.coalesce("path", none), "last").alias("above"))
    whole = leaves.withColumn("lo", F.col("rank")).join(paths, ["tree", "lo"], "left").withColumn("block", block).join(heads, ["tree", "block"])
    whole = whole.select("doc_id", "digest", "tampered", "subroot", "root", F.concat(F.coalesce("path", none), "above").alias("path"))
    folded = F.aggregate("path", as_hex(F.col("tampered")), lambda acc, x: F.sha2(F.concat(as_hex(x["before"]), acc, as_hex(x["after"])).cast("binary"), 256))
    proof = F.array_join(F.transform("path", lambda x: F.concat(as_hex(x["before"]), as_hex(x["after"]))), "")
    out = whole.select("doc_id", as_hex(F.col("digest")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), as_hex(F.col("root")).alias("root"),
                       F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


SQL = f"""
WITH RECURSIVE
bits(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT *, coalesce(xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::BIGINT)),
          lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8))) % 2 = 0, false) AS broken FROM documents, crc),
l AS (SELECT *, row_number() OVER () AS id FROM (SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
             CASE WHEN broken THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS tampered FROM d)),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY tree) AS n FROM l),
nodes(tree, lvl, k, n, h) AS (SELECT tree, 0, k, n, leaf FROM o
    UNION ALL SELECT tree, lvl + 1, k // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY k)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, k // 3),
runs AS (SELECT tree, lvl, k // 3 AS parent, list(h ORDER BY k) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
subs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS k, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, k, n, h) AS (SELECT 0, k, n, subroot FROM subs
    UNION ALL SELECT lvl + 1, k // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY k)) FROM tops WHERE n > 1 GROUP BY lvl, k // 3),
top_runs AS (SELECT lvl, k // 3 AS parent, list(h ORDER BY k) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
folds(id, tree, lvl, k, n, acc, proof) AS (SELECT id, tree, 0, k, n, tampered, '' FROM o
    UNION ALL SELECT id, f.tree, f.lvl + 1, k // 3, (n + 2) // 3,
        sha256(array_to_string(hs[1:k % 3], '') || acc || array_to_string(hs[k % 3 + 2:], '')), proof || array_to_string(hs[1:k % 3], '') || array_to_string(hs[k % 3 + 2:], '')
    FROM folds f JOIN runs r ON r.tree = f.tree AND r.lvl = f.lvl AND r.parent = k // 3 WHERE n > 1),
ends(id, lvl, k, n, acc, proof) AS (SELECT f.id, 0, s.k, s.n, f.acc, f.proof FROM folds f JOIN subs s USING (tree) WHERE f.n = 1
    UNION ALL SELECT id, f.lvl + 1, k // 3, (n + 2) // 3,
        sha256(array_to_string(hs[1:k % 3], '') || acc || array_to_string(hs[k % 3 + 2:], '')), proof || array_to_string(hs[1:k % 3], '') || array_to_string(hs[k % 3 + 2:], '')
    FROM ends f JOIN top_runs r ON r.lvl = f.lvl AND r.parent = k // 3 WHERE n > 1),
root AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM o JOIN subs USING (tree) JOIN ends e ON e.id = o.id AND e.n = 1, root
"""
