"""Spelling variants of words, with an index of variable-length grams.

The gram dictionary is a trie cut by frequency: a gram that stands in more
than ``HEAVY`` places is extended by a letter, and of its extensions the rarest
are folded back into it while they have ``HEAVY`` places together. A word is
decomposed by taking the longest dictionary gram at each position and leaving
out grams that lie within the one before. All words' grams are indexed under
(gram, position, word length).

For every single edit of a word the grams that it may affect are known: those
that hold the place, and those beside it whose choice the dictionary could
change. A word looks up a cheapest set of its grams that no edit affects
wholly, so every near word shares a list with it. With grams of at most half
the least word length the first and the last gram always are such a set.
Candidates are verified where the lists meet, and only near pairs leave there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pastline.llm.common import stored

LEAST_POINTS, LEAST_COUNT, RATIO, DROP = 6, 5, 5, 199
#: Lengths of grams; the longest is half the least word length at most. Places from which a gram is extended.
GRAM, LONGEST, HEAVY = 2, 3, 64
#: Words of a task that decomposes them.
PART = 1 << 14
#: Bytes of text taken at a time, bytes of partial counts kept, and length up to which checksums go word-parallel.
CHUNK, KEPT, SHORT = 4 << 20, 32 << 20, 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def _checksums(state: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of ``data[start:start + size]`` carried on from the checksums ``state``."""
    order = np.argsort(-size, kind="stable")
    crc, start, size = ~state[order], start[order], size[order]
    left = -size
    for j in range(int(min(size[0], SHORT)) if len(size) else 0):
        n = int(np.searchsorted(left, -j, "left"))  # words longer than j
        crc[:n] = _CRC[(crc[:n] ^ data[start[:n] + j]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~crc
    for k in range(int(np.searchsorted(left, -SHORT, "left"))):  # the rest of the longer ones
        out[order[k]] = zlib.crc32(data[start[k] + SHORT:start[k] + size[k]].tobytes(), int(out[order[k]]))
    return out


def runs_counted(ids: list[int | None], texts: list[bytes], least: int = LEAST_POINTS, drop: int = DROP) -> pa.Table:
    """(word, n) of some documents: their letter runs, lower-cased, of ``least`` code points or more after deletion."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    low = data | np.uint8(0x20)
    ascii_ = (low >= 97) & (low <= 122)
    lead = data == 0xC3  # first byte of U+00C0 to U+00FF, and of nothing else
    letter = ascii_ | lead
    letter[1:] |= lead[:-1]
    data = np.where(ascii_, low, data)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], letter.view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    points = np.concatenate(([0], np.cumsum(~lead)))
    n_points = points[end] - points[start]
    long = n_points >= least
    start, end, n_points = start[long], end[long], n_points[long]
    size = end - start
    of = np.searchsorted(np.cumsum(sizes + 1), start, "right")
    seeds = np.fromiter((zlib.crc32(b"%s:" % (b"" if i is None else b"%d" % i)) for i in ids), np.uint32, len(ids))
    crc = _checksums(seeds[of], data, start, size)
    hit = crc % np.uint32(drop) == 0
    # whole runs, laid end to end
    keep = np.zeros(len(data) + 1, np.int8)
    keep[start[~hit]] += 1
    keep[end[~hit]] -= 1
    packed = data[np.cumsum(keep[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate(([0], np.cumsum(size[~hit])))
    whole = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(packed.tobytes()))
    cut = []
    for s, e, c in zip(start[hit].tolist(), end[hit].tolist(), crc[hit].tolist()):
        run = data[s:e].tobytes().decode()
        at = c % len(run)
        if len(run) > least:
            cut.append(run[:at] + run[at + 1:])
    counted = pa.chunked_array([whole, pa.array(cut, pa.large_string())]).value_counts()
    return pa.table({"word": counted.field("values"), "n": counted.field("counts").cast(pa.int64())})


def word_counts(docs: DataFrame, least: int = LEAST_POINTS, count: int = LEAST_COUNT, drop: int = DROP) -> DataFrame:
    """(word, n): words of ``least`` code points with ``count`` occurrences or more.

    Partial counts are merged in the task up to ``KEPT`` bytes and then passed
    on, so neither long texts nor large vocabularies add up in a worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": t.column("word"), "n": t.column("n_sum")})

        def chunks() -> Iterator[tuple[list[int | None], list[bytes]]]:
            ids, texts, size = [], [], 0
            for batch in batches:
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    text = t.as_buffer()
                    ids.append(i)
                    texts.append(text.to_pybytes() if text else b"")
                    size += len(texts[-1])
                    if size >= CHUNK:
                        yield ids, texts
                        ids, texts, size = [], [], 0
            if ids:
                yield ids, texts

        for ids, texts in chunks():
            held.append(runs_counted(ids, texts, least, drop))
            if sum(t.nbytes for t in held) > KEPT:
                held[:] = [merged()]
                if held[0].nbytes > KEPT / 2:
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
        if held:
            yield from merged().to_batches(max_chunksize=1 << 16)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


# -- variable-length grams -------------------------------------------------

def gram_dictionary(words: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(gram, n): the grams of the frequency-pruned trie over ``words`` (word).

    Its size is bounded by the alphabet of 90 letters: 90 ** 2 grams of two
    letters and 90 ** 3 of three at most, however many words there are.
    """
    places = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    grams = places.select(F.explode(F.array(*[F.expr(f"substring(word, at, {q})") for q in range(GRAM, LONGEST + 1)])).alias("gram"), "at", "word")
    grams = grams.filter(F.length("gram") >= GRAM).dropDuplicates(["word", "at", "gram"])  # the last places give a short gram twice
    counts = stored(grams.groupBy("gram").agg(F.count("*").alias("n")), "gram-counts")
    kept = counts.filter(F.length("gram") == GRAM)
    level = kept
    for q in range(GRAM + 1, LONGEST + 1):
        kids = counts.filter(F.length("gram") == q).withColumn("parent", F.expr(f"substring(gram, 1, {q - 1})")).join(
            level.filter(F.col("n") > heavy).select(F.col("gram").alias("parent")), "parent")
        rising = Window.partitionBy("parent").orderBy("n", "gram")  # one row per letter
        level = kids.withColumn("folded", F.sum("n").over(rising)).filter(F.col("folded") > heavy).select("gram", "n")
        kept = kept.unionByName(level)
    return kept


class Grams:
    """Decomposition of words by a gram dictionary, and what an edit can affect."""

    def __init__(self, dictionary: dict[str, int]):
        self.n = dictionary
        self.heads = {g[:i] for g in dictionary for i in range(1, len(g))}
        self.tails = {g[i:] for g in dictionary for i in range(1, len(g))}

    def cut(self, word: str) -> list[tuple[int, int]]:
        """Spans (start, end) of the word's grams."""
        out, last = [], 0
        for at in range(len(word) - GRAM + 1):
            end = next((at + q for q in range(min(LONGEST, len(word) - at), GRAM, -1) if word[at:at + q] in self.n), at + GRAM)
            if end > last:
                out.append((at, end))
                last = end
        return out

    def affected(self, word: str, spans: list[tuple[int, int]], gap: bool) -> list[int]:
        """Per edit, the bit set of the grams it may affect: an insertion before each place (``gap``), or a change of each letter.

        Beside the grams that hold the place: those left of it from where the
        letters up to the place begin a longer gram, those right of it up to
        where the letters behind the place end one.
        """
        size, out = len(word), []
        for at in range(size + gap):
            after = at if gap else at + 1
            low = next((q for q in range(max(0, at - LONGEST + 1), at) if word[q:at] in self.heads), at)
            high = next((e for e in range(min(size, after + LONGEST - 1), after, -1) if word[after:e] in self.tails), after)
            bits = 0
            for k, (s, e) in enumerate(spans):
                held = s < at < e if gap else s <= at < e
                if held or (e <= at and s >= low) or (s >= after and e <= high):
                    bits |= 1 << k
            out.append(bits)
        return out

    def probes(self, word: str, spans: list[tuple[int, int]], gap: bool) -> list[int]:
        """Numbers of the cheapest two or three grams of which no edit affects all; without such, all grams."""
        edits = set(self.affected(word, spans, gap))
        cost = [self.n.get(word[s:e], 0) for s, e in spans]
        best = None
        for m in (2, 3):
            for some in combinations(range(len(spans)), m):
                price = sum(cost[k] for k in some)
                if best is None or price < best[0]:
                    mask = sum(1 << k for k in some)
                    if all(mask & ~e for e in edits):
                        best = price, some
        if best is None:
            raise ValueError(f"grams of up to {LONGEST} letters are too long for a word of {len(word)}")
        return list(best[1])


def letters(word: str) -> int:
    """Bit set of the word's letters; a single edit changes two bits at most."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


POSTED = "gram string, at long, size long, asks boolean, word string, n long, letters long"
NAMES = [c.split()[0] for c in POSTED.split(", ")]


def gram_lists(words: DataFrame, dictionary: dict[str, int]) -> DataFrame:
    """Postings of the words' grams, and look-ups (``asks``) for near words of the same length or one letter longer."""
    shared = words.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(shared.value)
        for batch in batches:
            out: list[tuple] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans, size, bits = grams.cut(word), len(word), letters(word)
                out += [(word[s:e], s, size, False, word, n, bits) for s, e in spans]
                out += [(word[slice(*spans[k])], spans[k][0], size, True, word, n, bits) for k in grams.probes(word, spans, False)]
                for k in grams.probes(word, spans, True):
                    s, e = spans[k]
                    out += [(word[s:e], s + shift, size + 1, True, word, n, bits) for shift in (0, 1)]
                if len(out) > 1 << 15:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], NAMES)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], NAMES)

    parts = -(-words.count() // PART) or 1  # the table is small in bytes, its decomposition is not
    return words.select("word", "n").repartition(parts).mapInArrow(run, POSTED)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways: all pairs of ``words`` (word, n) one inserted, deleted or replaced letter apart."""
    dictionary = {r.gram: r.n for r in gram_dictionary(words).collect()}  # bounded by the alphabet
    lists = stored(gram_lists(words, dictionary), "gram-lists")
    asked = lists.filter("asks").select("gram", "at", "size", "word", "n", "letters")
    held = lists.filter("not asks").select("gram", "at", "size", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("letters").alias("other_letters"))
    # of two words of one length the smaller asks
    once = (F.length("word") < F.col("size")) | (F.col("word") < F.col("other"))
    near = (F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2) & (F.levenshtein("word", "other", 1) == 1)
    pairs = asked.join(held, ["gram", "at", "size"]).filter(once & near).select("word", "n", "other", "other_n").distinct()
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word on the way from form to form, by pointer doubling."""
    ways = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = stored(further, "roots")
        moved, ways = further.filter("moved").limit(1).count(), further.select("word", "root")
        if not moved:
            return ways


def spelling_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``docs`` (reads doc_id and text; others are ignored).

    Columns: word, form, root, n, n_near, form_n. Words are the maximal runs
    of letters, lower-cased (A-Z only), of 6 code points and 5 occurrences or
    more, counted after one letter was deleted from the run where 199 divides
    the crc32 of ``<doc_id>:<run>``. Null texts have none; a null doc_id is
    written as nothing in that key; rows that repeat count each. A word's form
    is its near word of largest n (ties: the smallest) where that is ``ratio``
    times the word's own or more. An empty table gives an empty result.
    """
    words = stored(word_counts(docs), "words")
    pairs = stored(near_pairs(words), "near-words")
    best = pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
    best = best.select("word", "n_near", F.when(-F.col("best.rank") >= ratio * F.col("n"), F.struct(
        F.col("best.other").alias("form"), (-F.col("best.rank")).alias("form_n"))).alias("to")).select("word", "n_near", "to.form", "to.form_n")
    best = stored(best, "forms")
    root = roots(best.filter("form is not null"))
    return words.join(best, "word", "left").join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


SQL = """
WITH RECURSIVE
bits(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
d AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) AS h FROM r WHERE length(run) >= 6 GROUP BY ALL),
c AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2),
             lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8)))::BIGINT AS h FROM d, crc),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM c)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM v, range(20000) x(i) WHERE i < length(word)),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN v b ON a.rest = b.word
      UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
f AS (SELECT word, count(*) AS n_near, first(CASE WHEN other_n >= 5 * n THEN other END ORDER BY other_n DESC, other) AS form,
             first(CASE WHEN other_n >= 5 * n THEN other_n END ORDER BY other_n DESC, other) AS form_n FROM p GROUP BY word),
w AS (SELECT v.word, form, n, coalesce(n_near, 0) AS n_near, form_n FROM v LEFT JOIN f USING (word)),
walk(word, reached, form) AS (SELECT word, word, form FROM w UNION ALL SELECT walk.word, walk.form, w.form FROM walk JOIN w ON w.word = walk.form)
SELECT w.word, w.form, reached AS root, n, n_near, form_n FROM w JOIN walk ON walk.word = w.word AND walk.form IS NULL
"""
