"""Toxicity from the nearest labelled examples.

Documents are TF-IDF vectors over all words of the examples, each word weighed
by how far it tells the examples' classes apart (no word is left out); the
``K`` examples with the highest cosine vote on a document, each with its
cosine as weight. The vote becomes a probability by an isotonic fit on all
labelled rows of the sample; an example is scored as if it were none.

What is bounded (documented parameters): at most ``PER_CLASS`` labelled rows
of each class train the classifier, ``EXAMPLES`` of them per class are the
examples; words of no example are not part of the vectors. Everything else
covers all data: document frequencies are counted over every document,
class sizes over every label, and every whole text is scored.

The search is exact. Examples lie in blocks; for a word and a block the index
keeps the largest weight, so the sum over a document's words bounds any score
in the block. The ``FIRST`` blocks by bound are scored, then at once all
others whose bound can change the top ``K``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pastline.llm.common import held_out, source_table, stored

PER_CLASS, EXAMPLES = 4096, 1024
K, BLOCK, FIRST = 15, 32, 4
#: Weight of a word that says nothing of the classes; chance alone gives about 1.
LEAST = 0.1
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")


def _words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, place, text) of the training sample, and the labels of each class over all training rows.

    Held-out rows are never read. A document with several labels is toxic if one says so.
    """
    told = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    told = stored(told, "toxic-labels")
    sizes = {int(r[0]): r[1] for r in told.groupBy("toxic").count().collect()}  # two classes
    picked = None
    for label in (0, 1):
        some = told.filter(F.col("toxic") == label).select("doc_id", "toxic", F.xxhash64("doc_id").alias("place")).orderBy("place", "doc_id").limit(per_class)
        picked = some if picked is None else picked.union(some)
    # 2 * per_class rows of three numbers
    rows = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "place", "text")
    return stored(rows, "toxic-sample"), sizes


def vocabulary(chosen: DataFrame) -> list[str]:
    """All words of the examples (reads text), sorted."""
    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = {w for t in batch.column(0).to_pylist() for w in _words(t)}
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string())], ["word"])

    # the words of at most 2 * examples texts
    return sorted(r[0] for r in chosen.select("text").mapInArrow(distinct_words, "word string").distinct().collect())


def telling(size: int, examples: list[tuple[int, int, list[int], list[int]]], share: np.ndarray) -> np.ndarray:
    """For each word the root of its chi-square over the examples' classes, ``LEAST`` at least; 1 with one class only.

    ``share`` is what an example counts.
    """
    n1, n0 = (float(sum(x for x, e in zip(share, examples) if e[1] == c)) for c in (1, 0))
    if not n1 or not n0:
        return np.ones(size)
    a, b = np.zeros(size), np.zeros(size)  # examples of either class with the word
    for x, (_, toxic, term, _) in zip(share, examples):
        (a if toxic else b)[term] += x
    n = n1 + n0
    spread = (a + b) * (n - a - b) * n1 * n0
    root = np.sqrt(n / np.where(spread > 1e-9, spread, np.inf)) * np.abs(a * (n0 - b) - b * (n1 - a))
    return np.maximum(root, LEAST)


def counted(docs: DataFrame, words: list[str], *keep: str) -> DataFrame:
    """The columns ``keep`` with ``term`` and ``tf``: the words ``words`` in each whole text, sorted."""
    number = {w: i for i, w in enumerate(words)}
    schema = pa.schema([("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.get
        for batch in batches:
            terms, counts = [], []
            for text in batch.column(batch.num_columns - 1):
                hits = [i for i in map(get, _words(text.as_py())) if i is not None]
                t, c = np.unique(np.array(hits, np.int32), return_counts=True)
                terms.append(t.tolist())
                counts.append(c.tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(terms, schema[0].type), pa.array(counts, schema[1].type)],
                                             [*batch.schema.names[:-1], "term", "tf"])

    some = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema[:-1])
    return some.mapInArrow(run, f"{kept}, term array<int>, tf array<int>")


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers from each start to before its stop, one range after the other."""
    size = stop - start
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class BlockMaxIndex:
    """Unit TF-IDF vectors of the examples, and per word and block of them the largest weight, both sparse."""

    def __init__(self, idf: np.ndarray, examples: list[tuple[int, int, list[int], list[int]]], block: int = BLOCK):
        self.idf, self.block = idf.astype(np.float32), block
        rows = [(np.array(term, np.int32), self.weights(term, tf)) for _, _, term, tf in examples]
        # like examples side by side, so that bounds are tight: by strongest word, then strength
        lead = [int(t[w.argmax()]) if len(t) else -1 for t, w in rows]
        order = np.lexsort(([-w.max(initial=0) for _, w in rows], lead)).astype(np.int64)
        self.place_of = np.argsort(order)  # of the examples as given
        self.ids = np.array([e[0] for e in examples], np.int64)[order]
        self.toxic = np.array([e[1] for e in examples], np.float64)[order]
        term = np.concatenate([np.empty(0, np.int32), *(rows[i][0] for i in order)])
        place = np.repeat(np.arange(len(examples)), [len(rows[i][0]) for i in order])
        weight = np.concatenate([np.empty(0, np.float32), *(rows[i][1] for i in order)])
        self.blocks = max(1, -(-len(examples) // block))
        #: Examples with a word.
        self.examples_with = np.bincount(term, minlength=len(idf))
        # postings by word and place; those of a word in a block are a pair
        by_word = np.lexsort((place, term))
        self.term, self.place, self.weight = term[by_word], place[by_word], weight[by_word]
        pair, self.pair_at = np.unique(self.term.astype(np.int64) * self.blocks + self.place // block, return_index=True)
        self.most = np.maximum.reduceat(self.weight, self.pair_at) if len(pair) else np.empty(0, np.float32)
        self.pair_at = np.append(self.pair_at, len(self.term))
        self.pair_block = pair % self.blocks
        self.pairs_of = np.searchsorted(pair, np.arange(len(idf) + 1) * self.blocks)

    @property
    def vectors(self) -> np.ndarray:
        """The examples as a full matrix."""
        out = np.zeros((len(self.ids), len(self.idf)), np.float32)
        out[self.place, self.term] = self.weight
        return out

    def weights(self, term: list[int], tf: list[int]) -> np.ndarray:
        w = (1 + np.log(np.array(tf, np.float32))) * self.idf[np.array(term, np.int32)]
        return w / max(float(np.sqrt((w * w).sum())), 1e-12)

    def nearest(self, term: list[int], tf: list[int], k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Exact top k by cosine above zero: (places, cosines), ties by place.

        The example at ``without`` is no candidate, and words that only it has
        are taken as unknown, as they would be without it.
        """
        term, tf = np.array(term, np.int32), np.array(tf, np.int32)
        if without >= 0:
            known = self.examples_with[term] > np.isin(term, self.term[self.place == without])
            term, tf = term[known], tf[known]
        q = self.weights(term, tf)
        start, stop = self.pairs_of[term], self.pairs_of[term + 1]
        pair, q = _ranges(start, stop), np.repeat(q, stop - start)
        block = self.pair_block[pair]
        bound = np.bincount(block, self.most[pair] * q, minlength=self.blocks)
        place, score = np.empty(0, np.int64), np.empty(0)
        order = np.argsort(-bound, kind="stable")
        for part in (order[:FIRST], order[FIRST:]):
            # float32 sums: a bound is exact to far less than this
            part = part[bound[part] > (score[-1] - 1e-5 if len(score) == k else 0)]
            if len(part):
                visited = np.zeros(self.blocks, bool)
                visited[part] = True
                some = visited[block]
                start, stop = self.pair_at[pair[some]], self.pair_at[pair[some] + 1]
                at = _ranges(start, stop)
                every = np.bincount(self.place[at], self.weight[at] * np.repeat(q[some], stop - start), minlength=len(self.ids))
                if without >= 0:
                    every[without] = 0
                fresh = np.flatnonzero(every)
                if len(fresh) > k:
                    fresh = fresh[every[fresh] >= np.partition(every[fresh], -k)[-k]]
                place, score = np.concatenate([place, fresh]), np.concatenate([score, every[fresh]])
                best = np.lexsort((place, -score))[:k]
                place, score = place[best], score[best]
        return place, score

    def vote(self, place: np.ndarray, score: np.ndarray, k: int = K) -> float:
        """Closeness to toxic less closeness to other neighbours, -1 to 1; far or few neighbours say little."""
        return float((score.astype(np.float64) * (2 * self.toxic[place] - 1)).sum()) / k


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: upper ends of the steps and their values, each smoothed by one row in two."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # end, weight, weighted sum
    for i in order:
        steps.append([x[i], weight[i], weight[i] * y[i]])
        while len(steps) > 1 and (steps[-2][0] == steps[-1][0] or steps[-2][2] * steps[-1][1] >= steps[-1][2] * steps[-2][1]):
            end, w, s = steps.pop()
            steps[-1] = [end, steps[-1][1] + w, steps[-1][2] + s]
    value = np.array([(s + 0.25) / (w + 0.5) for _, w, s in steps])
    return np.array([s[0] for s in steps]), np.maximum.accumulate(value)


SCORED = "doc_id long, held_out boolean, score double, predicted int, vote double, evidence array<struct<doc_id: long, toxic: int, cosine: double>>"


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, examples: int = EXAMPLES) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text); ``labels`` has doc_id, toxic.

    Columns: doc_id, held_out, score, predicted, vote (null without a
    neighbour), evidence (the three nearest examples). A text without a word
    of an example (null and empty ones too) has no neighbour and gets the
    calibrated share of toxic rows among such texts. Without labelled rows of
    both classes every score is the share of toxic labels, 0 without any.
    Repeated rows score alike. The label of a row is never an input of a score
    except as an example.
    """
    docs = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    sample, sizes = labelled_sample(docs, labels, per_class)
    first = Window.partitionBy("toxic").orderBy("place", "doc_id", F.xxhash64("text"))
    # 2 * per_class rows
    sample = stored(sample.withColumn("example", F.row_number().over(first) <= examples), "toxic-ranked")
    words = vocabulary(sample.filter("example"))
    vectors = stored(counted(docs, words, "doc_id"), "toxic-vectors")
    n = vectors.count()
    df = np.zeros(len(words))
    for term, c in vectors.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # one row per word of the examples
        df[term] = c
    idf = np.log((n + 1) / (df + 1)) + 1
    known = counted(sample, words, "place", "doc_id", "toxic", "example").collect()  # 2 * per_class rows
    known = sorted(((r.place, r.doc_id, r.toxic, list(r.term), list(r.tf), r.example) for r in known))
    index_rows, rest = ([r[1:5] for r in known if r[5] == chosen] for chosen in (True, False))
    index = BlockMaxIndex(idf * telling(len(words), index_rows, np.ones(len(index_rows))), index_rows)
    # an example is scored without itself, so either class has rows here whatever the sizes
    trial = [(*r[1:], int(at)) for r, at in zip(index_rows, index.place_of)] + [(*r[1:], -1) for r in rest]
    # weights restore the share of each class among all training labels
    per = {c: sizes.get(c, 0) / max(1, sum(r[0] == c for r in trial)) for c in (0, 1)}
    scale = max(1, len(trial)) / max(1.0, sum(per[r[0]] for r in trial))
    votes, labels_, weights, none = [], [], [], [0.0, 0.0]
    for label, term, tf, own in trial:
        place, score = index.nearest(term, tf, without=own) if term else (np.empty(0), np.empty(0))
        if len(place):
            votes.append(index.vote(place, score))
            labels_.append(label)
            weights.append(per[label] * scale)
        else:
            none[label] += per[label] * scale
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    no_neighbour = (none[1] + prior) / (sum(none) + 1)
    ends, values = isotonic(np.array(votes), np.array(labels_, float), np.array(weights)) if votes else (np.array([1.0]), np.array([prior]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_vectors: dict[bytes, tuple] = {}
        for batch in batches:
            out = []
            for term, tf in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                key = xxhash.xxh3_128_digest(np.array([term, tf], np.int32).tobytes())
                got = known_vectors.get(key)
                if got is None:
                    place, score = index.nearest(term, tf) if term else (np.empty(0, np.int64), np.empty(0))
                    if len(place):
                        vote = index.vote(place, score)
                        p = float(values[min(int(np.searchsorted(ends, vote)), len(values) - 1)])
                        near = [{"doc_id": int(index.ids[i]), "toxic": int(index.toxic[i]), "cosine": min(1.0, float(s))} for i, s in zip(place[:3], score[:3])]
                    else:
                        vote, p, near = None, no_neighbour, []
                    got = known_vectors[key] = (min(1.0, max(0.0, p)), vote, near)
                    if len(known_vectors) > 100_000:
                        known_vectors.clear()
                out.append(got)
            p = [x[0] for x in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array([int(x >= THRESHOLD) for x in p], pa.int32()),
                 pa.array([x[1] for x in out], pa.float64()),
                 pa.array([x[2] for x in out], pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))],
                ["doc_id", "held_out", "score", "predicted", "vote", "evidence"])

    return vectors.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "term", "tf").mapInArrow(run, SCORED)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(source_table(spark, sf_dir, "documents", "doc_id", "text"), source_table(spark, sf_dir, "labels", "doc_id", "toxic"))
