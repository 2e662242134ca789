"""Near-duplicates by min-max hashing.

A document is the set of its distinct word shingles, as 64-bit hashes. Each
of ``perms`` hash functions gives two values of a set, its minimum and its
maximum; both agree between two sets with probability equal to their
similarity, so one evaluation yields two signature values. A band is
``rows / 2`` functions' minima and maxima; documents that share a band become
candidates. Minimum and maximum are drawn without replacement, so with 40
bands of 6 values a pair of similarity 0.8 is missed with probability 5e-6
where the sets are large, and more often the smaller they are (9e-6 for 16 of
20 shingles, 5.9e-5 for 4 of 5). Sets of fewer than 30 shingles therefore
become candidates by exact prefix keys too, which miss no pair. Every link is
confirmed on the full sets.

Equal sets are one node from the start, whatever the number of copies.
Inside a band's bucket no pairs are made of a group: the nodes are compared
with a hub (the smallest) and confirmed ones join its component, so a large
group of near copies costs a few comparisons per node. In the buckets whose
nodes are then still in different components, the nodes outside the bucket's
largest component are compared with all its nodes, in blocks of bounded size.
So no link between different components is left untested, and no pair is
emitted but links. A hub's partners are dealt to salted keys before any join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.llm.common import stored, text_key
from pastline.llm.components import SPREAD, components

PERMS, ROWS = 120, 6
#: Partners of a hub, and shingles of one side, that a task has at a time; a node counts as ``LEAST`` shingles at least.
BLOCK, SQUARE, LEAST = 64, 1 << 17, 512
#: Below so many shingles, sets have exact prefix keys.
SMALL = 30
#: Words whose hash a Python worker keeps while it has a task, about 150 bytes each; longer words are not kept.
CACHE_WORDS, CACHE_LENGTH = 1 << 17, 32


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


_HASH = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of a text, A-Z lower-cased.

    ``bytes.split`` cuts at exactly ``[\\x20\\x09-\\x0D]+`` and ``bytes.lower``
    changes A-Z only. With fewer words the whole sequence is the one shingle;
    without words the set is empty.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(_HASH.__getitem__, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    if not k:
        return h
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
    return np.unique(out)


class MinMax:
    """Band keys of shingle sets, for many sets at a time."""

    def __init__(self, perms: int, rows: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.a = draw.integers(1, 1 << 63, perms, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, perms, np.uint64)
        self.per_band = rows // 2  # functions, of two values each

    def bands(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of 64-bit band keys per non-empty set."""
        joined, start = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
        sign = np.empty((len(self.a), 2, len(sets)), np.uint64)
        for p, (a, b) in enumerate(zip(self.a, self.b)):
            x = joined * a + b
            sign[p, 0], sign[p, 1] = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start)
        keys = []
        for band in range(len(self.a) // self.per_band):
            key = np.full(len(sets), band + 1, np.uint64)
            for values in sign[band * self.per_band:(band + 1) * self.per_band]:
                for v in values:
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + v)
            keys.append(key)
        return np.stack(keys, axis=1)


SIGNED = "doc_id long, text_key long, node binary, n_shingles long, bands array<long>"


def prefix_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which two sets of similarity ``percent`` or more share one, if the smaller has fewer than ``SMALL`` shingles."""
    n = len(shingles)
    if n > 100 * SMALL // percent:
        return shingles[:0]
    return _mix(shingles[:n - -(-percent * n // 100) + 1] ^ np.uint64(0x5851F42D4C957F2D))


def signatures(docs: DataFrame, words: int, perms: int, rows: int, percent: int = 80) -> DataFrame:
    """(doc_id, text_key, node, n_shingles, bands); ``node`` is the 128-bit hash of the set, null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minmax = MinMax(perms, rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), words) for t in part.column(2)]
                full = [s for s in sets if len(s)]
                keys = iter(minmax.bands(full).view(np.int64) if full else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([np.concatenate((next(keys), prefix_keys(s, percent).view(np.int64))) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "node", "n_shingles", "bands"])
        _HASH.clear()  # the worker may serve other stages next

    return docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(run, SIGNED)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes with ``100 * |A and B| >= percent * |A or B|`` on their full sets.

    ``texts`` (node, text) holds a text of every node. Partners of a node are
    dealt to blocks of about ``BLOCK``; a block gets the node's text once and
    streams its partners, so a hub of any size is spread over many tasks.
    """
    blocks = F.greatest(F.lit(1), (F.col("partners") / BLOCK).cast("int"))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b", F.lit(1)), F.lit(SPREAD)).cast("int"))
    part = salted.groupBy("a", "salt").agg(F.count("*").alias("n"))
    total = part.groupBy("a").agg(F.sum("n").alias("partners"))
    sized = salted.join(part.drop("n").join(total, "a"), ["a", "salt"]).drop("salt")
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("b"), blocks).cast("int"))
    left = dealt.selectExpr("a as hub", "block as hub_block").distinct().join(texts.selectExpr("node as hub", "text as hub_text"), "hub")
    right = dealt.join(texts.selectExpr("node as b", "text"), "b").select("a", "block", "b", "text")

    def check(hub: pa.Table, others: pa.Table) -> pa.Table:
        linked, a = [], None
        if hub.num_rows:
            a = hub.column("hub")[0].as_py()
            mine = shingle_set(hub.column("hub_text")[0].as_py(), words)
            for b, text in zip(others.column("b"), others.column("text")):
                other = shingle_set(text.as_py(), words)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if 100 * both >= percent * (len(mine) + len(other) - both):
                    linked.append(b.as_py())
        return pa.table({"a": pa.array([a] * len(linked), pa.binary()), "b": pa.array(linked, pa.binary())})

    return left.groupBy("hub", "hub_block").cogroup(right.groupBy("a", "block")).applyInArrow(check, "a binary, b binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of two lists of sorted sets, ``width`` common values at a time."""
    def cells(sets: list[np.ndarray], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        hit = common[at] == flat
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    out = np.zeros((len(left), len(right)), np.float32)
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(common):
        return out
    (row_l, at_l), (row_r, at_r) = cells(left, common), cells(right, common)
    for lo in range(0, len(common), width):
        part = []
        for row, at, n in ((row_l, at_l, len(left)), (row_r, at_r, len(right))):
            i, j = np.searchsorted(at, [lo, lo + width])
            m = np.zeros((n, width), np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            part.append(m)
        out += part[0] @ part[1].T
    return out


def links_between(nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different components in one bucket; ``nodes`` has (node, comp, grp).

    The nodes outside a bucket's largest component are a query set that is
    compared with the whole bucket, in blocks of about ``SQUARE`` by
    ``SQUARE`` shingles; nothing is emitted but links.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), words).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])
        _HASH.clear()

    sets = texts.join(nodes.select("node").distinct(), "node").select("node", "text").mapInArrow(listed, "node binary, shingles binary")
    sets = stored(sets, "open-sets").withColumn("weight", F.greatest(F.lit(LEAST), F.octet_length("shingles") / 8).cast("long"))
    weighed = nodes.join(sets.select("node", "weight"), "node")
    sizes = weighed.groupBy("grp", "comp").agg(F.sum("weight").alias("w")).groupBy("grp").agg(
        F.sum("w").alias("members"), F.max(F.struct("w", "comp")).alias("main"))
    sizes = sizes.select("grp", "members", (F.col("members") - F.col("main.w")).alias("asking"), F.col("main.comp").alias("main")).filter("asking > 0")
    all_ = stored(nodes.join(sizes, "grp"), "open-members")
    blocks = lambda n: F.ceil(F.col(n) / SQUARE).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    left = all_.filter("comp <> main").select("grp", mine("asking").alias("q"), F.explode(F.sequence(F.lit(0), blocks("members") - 1)).alias("m"), "node", "comp")
    right = all_.select("grp", F.explode(F.sequence(F.lit(0), blocks("asking") - 1)).alias("oq"), mine("members").alias("om"), "node", "comp")
    left = left.join(sets, "node").select("grp", "q", "m", "node", "comp", "shingles")
    right = right.join(sets, "node").select(F.col("grp").alias("of"), "oq", "om", F.col("node").alias("other"), F.col("comp").alias("other_comp"), F.col("shingles").alias("other_shingles"))

    def check(ask: pa.Table, members: pa.Table) -> pa.Table:
        a, b = [], []
        if ask.num_rows and members.num_rows:
            l, r = ([np.frombuffer(x.as_py(), np.uint64) for x in t.column(c)] for t, c in ((ask, "shingles"), (members, "other_shingles")))
            both = overlaps(l, r).astype(np.int64)
            total = np.array([len(x) for x in l])[:, None] + np.array([len(x) for x in r])[None, :]
            number = {c: i for i, c in enumerate(set(ask.column("comp").to_pylist()) | set(members.column("other_comp").to_pylist()))}
            c, d = (np.array([number[x] for x in t.column(n).to_pylist()]) for t, n in ((ask, "comp"), (members, "other_comp")))
            linked = (both * (100 + percent) >= percent * total) & (c[:, None] != d[None, :])
            i, j = np.nonzero(linked)
            _, once = np.unique(i * len(number) + d[j], return_index=True)  # one link to a component is enough
            ids, others = ask.column("node").to_pylist(), members.column("other").to_pylist()
            a, b = [ids[x] for x in i[once]], [others[x] for x in j[once]]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return left.groupBy("grp", "q", "m").cogroup(right.groupBy("of", "oq", "om")).applyInArrow(check, "a binary, b binary")


def near_links(signed: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, comp) of the nodes that have a link; ``signed`` is stored output of ``signatures``."""
    nodes = signed.filter("node is not null").groupBy("node").agg(F.first("bands").alias("bands"))
    in_band = nodes.select("node", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("hub")).filter("n > 1")
    live = stored(in_band.join(shared.drop("n"), "band"), "band-members")
    # one text of every node in a shared band
    wanted = signed.join(live.select("node").distinct(), "node").groupBy("node").agg(F.min(F.struct("text_key", "doc_id")).alias("x"))
    wanted = wanted.select("node", F.col("x.doc_id").alias("__id"), F.col("x.text_key").alias("__key"))
    found = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key")))
    texts = stored(found.groupBy("node").agg(F.first("text").alias("text")), "candidate-texts")

    pairs = live.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    comp = components(confirmed(pairs, texts, words, percent))
    # buckets whose nodes are still apart
    known = live.select("band", "node").join(comp, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    apart = known.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band")
    nodes = stored(known.join(apart, "band").select("node", "comp", F.col("band").alias("grp")), "open-nodes")
    more = links_between(nodes, texts, words, percent)
    return components(comp.select(F.col("comp").alias("a"), F.col("node").alias("b")).union(more))


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, perms: int = PERMS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id and text; others are ignored).

    Columns: doc_id, n_shingles, component_id, kept. ``component_id`` is the
    smallest doc_id reachable over links of ``percent`` or more; ``kept`` is
    doc_id = component_id. Texts without words, and null texts, have an empty
    set, link with nothing and are kept. A row without doc_id is kept and has
    no component id unless a linked row has one. Equal sets (hence equal
    texts) are always linked. Rows that repeat a doc_id are linked each by its
    own text. An empty table gives an empty result.
    """
    return grouped(docs, words, percent, perms, rows).drop("text_key")


def grouped(docs: DataFrame, words: int = 5, percent: int = 80, perms: int = PERMS, rows: int = ROWS) -> DataFrame:
    """``near_dedup`` with the key that tells rows apart."""
    docs = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    signed = stored(signatures(docs, words, perms, rows, percent), "signatures")
    comp = near_links(signed, docs, words, percent)
    rows_ = signed.select("doc_id", "text_key", "node", "n_shingles").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = rows_.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("low"))
    return rows_.join(lowest, "comp", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("low", "doc_id"), F.lit(True)).alias("kept"), "text_key")
