"""Language identification in two steps: family first, then one against one.

A text is a vector of hashed byte 2- and 3-grams (letters lower-cased, other
ASCII as blanks; square roots of counts, unit length). The family is the one
with the nearest centroid. Within it a linear support vector machine for each
pair of its languages votes; ties go to the larger sum of margins.

Bounded, as documented parameters: ``PER_LANG`` labelled rows of each
language train the classifier and at most ``MAX_LANGS`` languages are learned
(more raise an error). Each pair's machine is fitted in a Spark task of its
own. Every whole text is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pastline.llm.common import held_out, stored

PER_LANG, MAX_LANGS, BITS = 400, 500, 12
#: Languages of one family by ISO 639-1 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg sr mk pl cs sk sl hr bs",
    "baltic": "lt lv", "celtic": "ga cy gd br", "hellenic": "el",
    "indo-aryan": "hi ur bn pa mr gu ne si", "iranian": "fa ku tg ps",
    "turkic": "tr az kk ky uz tk tt", "uralic": "fi et hu",
    "semitic": "ar he mt am", "sinitic": "zh", "japonic": "ja", "koreanic": "ko",
    "dravidian": "ta te kn ml", "austronesian": "id ms tl jv mg", "tai": "th lo", "vietic": "vi km",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = regex.compile(r"\p{L}")
_BLANK = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].split("_")[0].lower(), lang)


def vector(text: str, bits: int = BITS) -> np.ndarray:
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_BLANK)
    b = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", np.uint8).astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    shift = np.uint32(32 - bits)
    counts = np.bincount(((two + np.uint32(1 << 24)) * np.uint32(2654435761)) >> shift, minlength=1 << bits)
    if len(three):
        counts = counts + np.bincount((three * np.uint32(2246822519)) >> shift, minlength=1 << bits)
    v = np.sqrt(counts.astype(np.float32))
    return v / max(float(np.sqrt((v * v).sum())), 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30, seed: int = 1) -> np.ndarray:
    """L2-loss linear SVM by dual coordinate descent; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, alpha, diag = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(axis=1) + 0.5 / c
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / c
            step = max(alpha[i] - g / diag[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w


def training_sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """(lang, text) of at most ``per_lang`` rows of each language that are not held out.

    Languages are thinned by a hash to about twice the bound before the rows
    are ranked, so no language is sorted as a whole.
    """
    rows = docs.filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id"))).select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("h"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r.lang, F.lit(min(1.0, 2.0 * per_lang / r.n))).otherwise(share)
    thin = rows.filter(F.col("h") < share * float(1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    picked = thin.withColumn("rank", rank).filter(F.col("rank") <= per_lang).select("doc_id").distinct()
    # per_lang * MAX_LANGS ids at most
    return docs.join(F.broadcast(picked), "doc_id").filter("lang is not null and text is not null").select("lang", "text")


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, family string"


def identify_language(docs: DataFrame, per_lang: int = PER_LANG, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text, lang; lang only of training rows).

    Columns: doc_id, held_out, lang_pred, score, family. Null texts and texts
    without a letter are ``und`` with score 0, as is every text when there is
    no training row. Repeated rows are predicted alike.
    """
    docs = docs.selectExpr("cast(doc_id as long) as doc_id", "text", "cast(lang as string) as lang")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([vector(t, bits).tobytes() for t in texts], pa.binary())], ["lang", "v"])

    sample = stored(training_sample(docs, per_lang).mapInArrow(vectors, "lang string, v binary"), "lang-sample")

    def centroid(rows: pa.Table) -> pa.Table:
        mean = np.mean([np.frombuffer(v.as_py(), np.float32) for v in rows.column("v")], axis=0, dtype=np.float64)
        return pa.table({"lang": rows.column("lang").slice(0, 1), "w": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})

    centroids = {r.lang: np.frombuffer(r.w, np.float32) for r in sample.groupBy("lang").applyInArrow(centroid, "lang string, w binary").collect()}
    langs = sorted(centroids)
    families = sorted({family_of(x) for x in langs})
    pairs = [(a, b) for a, b in combinations(langs, 2) if family_of(a) == family_of(b)]

    def fit(rows: pa.Table) -> pa.Table:
        pair = rows.column("pair")[0].as_py()
        x = np.stack([np.frombuffer(v.as_py(), np.float32) for v in rows.column("v")])
        y = np.where(np.array(rows.column("lang").to_pylist()) == pairs[pair][0], 1.0, -1.0)
        return pa.table({"pair": pa.array([pair], pa.int32()), "w": pa.array([linear_svm(x, y).astype(np.float32).tobytes()], pa.binary())})

    machines = {}
    if pairs:
        of = {x: [i for i, p in enumerate(pairs) if x in p] for x in langs}
        choice = F.create_map(*[y for x in langs for y in (F.lit(x), F.array(*[F.lit(i) for i in of[x]]).cast("array<int>"))])
        per_pair = sample.select(F.explode(choice[F.col("lang")]).alias("pair"), "lang", "v")
        machines = {r.pair: np.frombuffer(r.w, np.float32) for r in per_pair.groupBy("pair").applyInArrow(fit, "pair int, w binary").collect()}

    centre = np.stack([np.mean([centroids[x] for x in langs if family_of(x) == f], axis=0) for f in families]) if langs else None
    if centre is not None:
        centre = centre / np.linalg.norm(centre, axis=1, keepdims=True)
    members = [[x for x in langs if family_of(x) == f] for f in families]
    inside = [[(p[0], p[1], machines[i]) for i, p in enumerate(pairs) if family_of(p[0]) == f] for f in families]

    def predict(text: str | None) -> tuple[str, float, str | None]:
        if centre is None or not text or _LETTER.search(text) is None:
            return "und", 0.0, None
        v = vector(text, bits)
        near = centre @ v
        f = int(near.argmax())
        odds = np.exp(20 * (near - near[f]))
        score = float(1 / odds.sum())
        if len(members[f]) == 1:
            return members[f][0], score, families[f]
        votes = dict.fromkeys(members[f], 0)
        margins = dict.fromkeys(members[f], 0.0)
        for a, b, w in inside[f]:
            m = float(v @ w[:-1] + w[-1])
            votes[a if m > 0 else b] += 1
            margins[a] += m
            margins[b] -= m
        best = max(members[f], key=lambda x: (votes[x], margins[x]))
        return best, score / (1 + float(np.exp(-2 * margins[best] / (len(members[f]) - 1)))), families[f]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in told], pa.string()),
                 pa.array([x[1] for x in told], pa.float64()), pa.array([x[2] for x in told], pa.string())],
                ["doc_id", "held_out", "lang_pred", "score", "family"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, PREDICTED)
