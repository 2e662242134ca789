"""Near-duplicates by SimHash, with a self-join of binary tries.

The fingerprints are the leaves of a binary trie. The join walks pairs of
nodes of one depth together, counts the bits in which their prefixes differ,
and drops a pair as soon as its error budget is exceeded. Four differing bits
leave one third of the 64 bits with at most one, so three tries are walked,
each with another third as its first bits and a budget of one error there;
all of it together finds every pair within four bits.

The upper part of a trie is walked by Spark, ``STEP`` bits a round: a pair of
nodes is split into pairs of its children (equality joins on the parents'
prefixes) while one of the two holds more than ``LEAF`` fingerprints, so dense
regions are split deeper and no task gets more than twice ``LEAF``. The rest of
the walk is done in tasks, over ranges of sorted arrays. Equal fingerprints
are one leaf; a pair of nodes whose fingerprints are already in one component
is dropped too, so a group of near copies is never compared pair by pair.
Tasks return spanning links only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pastline.llm.common import stored
from pastline.llm.components import components

WORDS, SEED, BITS = 4, 42, 4
STEP, LEAF = 4, 4096
#: Width of the first part, with a budget of one error, of each of the three tries; each starts where the one before ends.
FIRST = (21, 21, 22)
ONE_ERROR = 1
U = np.uint64


def fingerprint(text: str | None) -> int:
    """64 bits, each set where it is in over half of the hashes of the text's 4-word shingles, A-Z lower-cased.

    Fewer words make one shingle; no words give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    size = min(WORDS, n)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:n - size])).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    stops = (ends[size - 1:] - 1).tolist()
    for at in range(0, len(starts), 8192):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + 8192], stops[at:at + 8192])], U)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return sum(1 << i for i in np.nonzero(counts * 2 > len(starts))[0].tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp), fp as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), U, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, "doc_id long, fp long")


# -- the upper trie, in Spark ----------------------------------------------

def rotations() -> Column:
    """Array of (trie, key): the fingerprint with each trie's first part in front."""
    out, at = [], 0
    for trie, width in enumerate(FIRST):
        key = F.col("fp") if not at else F.shiftleft("fp", at).bitwiseOR(F.shiftrightunsigned("fp", 64 - at))
        out.append(F.struct(F.lit(trie).alias("trie"), key.alias("key")))
        at += width
    return F.array(*out)


def prefix(depth: int) -> Column:
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def within(depth: int) -> Column:
    """Whether prefixes ``a`` and ``b`` of ``depth`` bits keep the budgets: one error in the first part, ``BITS`` in all."""
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)
    for trie, width in enumerate(FIRST):
        head = F.shiftrightunsigned(differ, depth - width) if depth > width else differ
        first = first & ((F.col("trie") != trie) | (F.bit_count(head) <= ONE_ERROR))
    return first & (F.bit_count(differ) <= BITS)


def node_pairs(keys: DataFrame, leaf: int) -> tuple[list[int], DataFrame | None]:
    """Pairs (trie, depth, a, b) of trie nodes of at most ``leaf`` keys each that hold all links, and the depths they have."""
    open_, found, depths = None, None, []
    for depth in range(0, 65, STEP):
        under = keys if open_ is None else keys.withColumn("parent", prefix(depth - STEP)).join(
            open_.select("trie", F.explode(F.array("a", "b")).alias("parent")).distinct(), ["trie", "parent"], "left_semi")
        nodes = stored(under.groupBy("trie", prefix(depth).alias("node")).agg(F.count("*").alias("n")), "trie-nodes")
        if open_ is None:
            pairs = nodes.select("trie", F.col("node").alias("a"), F.col("node").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"))
        else:
            up = F.shiftrightunsigned("node", STEP)
            left = nodes.select("trie", up.alias("up_a"), F.col("node").alias("a"), F.col("n").alias("na"))
            right = nodes.select("trie", up.alias("up_b"), F.col("node").alias("b"), F.col("n").alias("nb"))
            parents = open_.select("trie", F.col("a").alias("up_a"), F.col("b").alias("up_b"))
            pairs = parents.join(left, ["trie", "up_a"]).join(right, ["trie", "up_b"]).filter("a <= b").filter(within(depth))
        pairs = stored(pairs.filter("a <> b or na > 1").select("trie", F.lit(depth).alias("depth"), "a", "b", F.greatest("na", "nb").alias("most")), "trie-pairs")
        done, open_ = pairs.filter(F.col("most") <= leaf).drop("most"), pairs.filter(F.col("most") > leaf)
        counts = pairs.agg(F.count(F.when(F.col("most") <= leaf, 1)).alias("done"), F.count(F.when(F.col("most") > leaf, 1)).alias("open")).first()
        if counts["done"]:
            depths.append(depth)
            found = done if found is None else found.unionByName(done)
        if not counts["open"]:
            break
    return depths, found


# -- the lower trie, in a task ---------------------------------------------

def runs_of(keys: np.ndarray) -> np.ndarray:
    """Component number of each of the sorted keys by links between neighbours."""
    return np.concatenate(([0], np.cumsum(np.bitwise_count(keys[1:] ^ keys[:-1]) > BITS)))


def walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, first: int, small: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) of sorted keys ``a[i]``, ``b[j]`` under two trie nodes of ``depth``, all but those inside one component.

    ``first`` is the width of the part with a budget of one error.
    """
    comp_a = runs_of(a)
    comp_b = comp_a if same else runs_of(b) + len(a)
    lo1, hi1, lo2, hi2 = (np.array([x], np.int64) for x in (0, len(a), 0, len(b)))
    out_i, out_j = [], []
    while len(lo1):
        # a pair of nodes in one component has nothing to add
        one = (comp_a[lo1] == comp_a[hi1 - 1]) & (comp_b[lo2] == comp_b[hi2 - 1]) & (comp_a[lo1] == comp_b[lo2])
        little = ((hi1 - lo1) * (hi2 - lo2) <= small) | (depth >= 64)
        for start in range(0, int((little & ~one).sum()), 1 << 14):
            pick = np.nonzero(little & ~one)[0][start:start + (1 << 14)]
            wide = hi2[pick] - lo2[pick]
            each = (hi1[pick] - lo1[pick]) * wide
            node = np.repeat(np.arange(len(pick)), each)
            place = np.arange(len(node)) - np.repeat(np.cumsum(each) - each, each)
            i, j = lo1[pick][node] + place // wide[node], lo2[pick][node] + place % wide[node]
            linked = np.bitwise_count(a[i] ^ b[j]) <= BITS
            linked &= comp_a[i] != comp_b[j]
            out_i.append(i[linked])
            out_j.append(j[linked])
        go = ~(one | little)
        lo1, hi1, lo2, hi2 = lo1[go], hi1[go], lo2[go], hi2[go]
        if not len(lo1):
            break
        bit, keep = U(1) << U(63 - depth), ~((U(1) << U(63 - depth)) - U(1))
        mid1 = np.searchsorted(a, (a[lo1] & keep) | bit)
        mid2 = np.searchsorted(b, (b[lo2] & keep) | bit)
        mid1, mid2 = np.clip(mid1, lo1, hi1), np.clip(mid2, lo2, hi2)
        twin = same & (lo1 == lo2)
        kids = [(lo1, mid1, lo2, mid2), (mid1, hi1, mid2, hi2), (lo1, mid1, mid2, hi2), tuple(x[~twin] for x in (mid1, hi1, lo2, mid2))]
        lo1, hi1, lo2, hi2 = (np.concatenate(x) for x in zip(*kids))
        depth += 1
        full = (lo1 < hi1) & (lo2 < hi2)
        lo1, hi1, lo2, hi2 = lo1[full], hi1[full], lo2[full], hi2[full]
        differ = (a[lo1] ^ b[lo2]) >> U(64 - depth)
        ok = np.bitwise_count(differ) <= BITS
        ok &= np.bitwise_count(differ >> U(max(0, depth - first))) <= ONE_ERROR
        lo1, hi1, lo2, hi2 = lo1[ok], hi1[ok], lo2[ok], hi2[ok]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(out_i or none), np.concatenate(out_j or none)


def spanning(a: np.ndarray, b: np.ndarray, same: bool, depth: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what ``walk`` and neighbours join; of two nodes, only those across (each node's own are found in its own pair)."""
    i, j = walk(a, b, same, depth, first)
    comp_a = runs_of(a)
    comp_b = comp_a if same else runs_of(b) + len(a)
    x, y = comp_a[i], comp_b[j]
    _, once = np.unique(np.minimum(x, y) * (len(a) + len(b)) + np.maximum(x, y), return_index=True)
    above: dict[int, int] = {}

    def root(c: int) -> int:
        while c in above:
            c = above[c]
        return c

    left, right = [], []
    for k in once.tolist():
        p, q = sorted((root(int(x[k])), root(int(y[k]))))
        if p != q:
            above[q] = p
            left.append(a[i[k]])
            right.append(b[j[k]])
    if same:  # the smallest key of each component with the others
        roots = np.array([root(c) for c in range(int(comp_a[-1]) + 1)])[comp_a]
        order = np.argsort(roots, kind="stable")
        head = order[np.searchsorted(roots[order], roots)]
        rest = head != np.arange(len(a))
        return a[head[rest]], a[rest]
    return np.array(left, U), np.array(right, U)


def _links(trie: int, depth: int, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    key, side = table.column("key").to_numpy().view(U), table.column("side").to_numpy()
    a, b = np.sort(key[side == 0]), np.sort(key[side == 1])
    same = not len(b)
    at = U(sum(FIRST[:trie]))
    back = lambda x: (x >> at) | (x << (U(64) - at)) if at else x
    return tuple(back(x) for x in spanning(a, a if same else b, same, depth, FIRST[trie]))


def trie_links(fps: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that join all those within ``BITS`` bits."""
    keys = stored(fps.select(F.inline(rotations())), "trie-keys")
    depths, pairs = node_pairs(keys, leaf)
    if pairs is None:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sides = pairs.select("trie", "depth", "a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("node")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("node")), F.struct(F.lit(1).alias("side"), F.col("b").alias("node"))))).alias("s")).select("trie", "depth", "a", "b", "s.*")
    held = keys.select("trie", "key", F.inline(F.array(*[F.struct(F.lit(d).alias("depth"), prefix(d).alias("node")) for d in depths])))

    def check(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, b = _links(key[0].as_py(), key[1].as_py(), table)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return held.join(sides, ["trie", "depth", "node"]).select("trie", "depth", "a", "b", "side", "key").groupBy("trie", "depth", "a", "b").applyInArrow(check, "a long, b long")


def simhash_near_dedup(docs: DataFrame, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id and text; others are ignored).

    Columns: doc_id, fingerprint (16 lowercase hex digits), component_id (the
    smallest doc_id reachable over links of 4 or fewer differing bits, itself
    included). Null and empty texts, and those without words, have fingerprint
    zero and are linked like any other. A row without doc_id is linked too; it
    has no component id unless a linked row has an id. Rows that repeat a
    doc_id are linked each by its own text. An empty table gives an empty
    result.
    """
    signed = stored(fingerprints(docs), "simhash")
    fps = signed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    comp = components(trie_links(fps.select("fp"), leaf))
    grouped = fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    low = grouped.groupBy("comp").agg(F.min("first").alias("low"))
    of = grouped.join(low, "comp").select("fp", "low")
    return signed.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("low").alias("component_id"))
