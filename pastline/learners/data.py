"""Learner inputs: label codes, feature vectors, class weights (M10),
expanding-window folds (V1), stratified contiguous folds, subsamples (M12, M13).

Everything here is a column expression or one small aggregate; the
``VectorUDT`` column is built only at the learner boundary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline import presets
from pastline.operators.stats import value_prefix

LABEL = "label"
FEATURES = "features"
WEIGHT = "w"


def label_code(outcome: str | Column) -> Column:
    """outcome letter -> learner code (A=0, D=1, H=2)."""
    col = F.col(outcome) if isinstance(outcome, str) else outcome
    m = F.create_map(*[F.lit(x) for k, v in presets.OUTCOME_CODE.items() for x in (k, v)])
    return F.element_at(m, col).cast("double")


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


#: Rows of a stored part: not fewer than LEAST unless there is one part, not more than MOST.
LEAST, MOST = 1 << 14, 1 << 18


def parts_for(spark: SparkSession, rows: int) -> int:
    """Parts for ``rows`` that many passes follow: a few per core while a part
    keeps LEAST rows, and as many as needed for at most MOST."""
    few = min(-(-rows // LEAST), 8 * spark.sparkContext.defaultParallelism)
    return max(1, few, -(-rows // MOST))


def class_counts(df: DataFrame, label: str = LABEL) -> dict[float, int]:
    """One row per class: bounded by the number of classes."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def balanced_weights(counts: dict[float, int]) -> dict[float, float]:
    """``n / (k * n_c)`` per class."""
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * m) for c, m in counts.items()}


def with_weights(df: DataFrame, weights: dict[float, float], label: str = LABEL, out: str = WEIGHT) -> DataFrame:
    m = F.create_map(*[F.lit(x) for c, w in weights.items() for x in (float(c), float(w))])
    return df.withColumn(out, F.element_at(m, F.col(label).cast("double")))


def expanding_folds(n: int, k: int) -> list[tuple[int, int, int]]:
    """V1: ``(fold, test_start, test_end)`` on a dense 0-based order: fold i
    trains on ids ``< test_start`` and tests ``[test_start, test_end)``."""
    size = n // (k + 1)
    return [(i, n - (k - i) * size, n - (k - i) * size + size) for i in range(k)]


def fold_frames(df: DataFrame, seq: str, n: int, k: int):
    """Yield ``(fold, train_df, test_df)`` by filters on the dense order."""
    for i, a, b in expanding_folds(n, k):
        yield i, df.where(F.col(seq) < a), df.where((F.col(seq) >= a) & (F.col(seq) < b))


def stratified_fold_col(df: DataFrame, *, label: str, seq: str, k: int) -> tuple[DataFrame, Column]:
    """Contiguous stratified folds without shuffling: per class, rows in
    ``seq`` order are cut into k blocks whose sizes follow a round-robin of
    the sorted labels. The within-class positions come from the prefix counts
    (no window over a whole class); of them only the blocks' ends are needed,
    so the rows take no join: the fold is an expression of label and ``seq``.
    Rows without either are left out."""
    counts = dict(sorted(class_counts(df.where(F.col(label).isNotNull()), label).items()))
    start, alloc = 0, {}
    for c, n_c in counts.items():
        # how many positions p in [start, start + n_c) have p % k == i (closed form)
        sizes = [(start + n_c - 1 - i) // k - (start - 1 - i) // k for i in range(k)]
        alloc[c] = sizes
        start += n_c
    known = df.where(F.col(label).isNotNull() & F.col(seq).isNotNull())
    if not alloc:
        return known, F.lit(None).cast("int")
    pos = value_prefix(known.select(F.col(label).alias("_c"), F.col(seq).cast("double").alias("_s")), keys=["_c"], value="_s")
    bounds = {c: [sum(sizes[: i + 1]) for i in range(k)] for c, sizes in alloc.items()}
    # a block ends before the first seq whose position reaches its bound: one number per class and block
    first = pos.agg(*[F.min(F.when((F.col("_c") == c) & (F.col("before_n") >= b), F.col("_s"))).alias(f"b{j}_{i}")
                      for j, (c, ends) in enumerate(bounds.items()) for i, b in enumerate(ends)]).first()
    at, fold = F.col(seq).cast("double"), None
    for j, c in enumerate(bounds):
        e = None
        for i in range(k):
            end = first[f"b{j}_{i}"]
            cond = F.lit(True) if end is None else at < F.lit(end)
            e = F.when(cond, F.lit(i)) if e is None else e.when(cond, F.lit(i))
        fold = F.when(F.col(label) == c, e) if fold is None else fold.when(F.col(label) == c, e)
    return known, fold


def hash_uniform(*cols: Column) -> Column:
    """A seeded uniform of 53 bits in [0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def uniform_sample(df: DataFrame, n: int, *, key: str, seed: int = 42) -> DataFrame:
    """N rows without replacement, deterministic (hash order; top-k per task)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def stratified_sample(df: DataFrame, n: int, *, key: str, label: str = LABEL, seed: int = 42) -> DataFrame:
    """Exact stratified subsample of n rows (class shares kept, largest
    remainders), rows kept in their original order. The per-class quota is
    applied as a hash-rank threshold: each class takes its ``q_c`` smallest
    hashes (a top-k per class; the k are bounded by n)."""
    counts = class_counts(df, label)
    tot = sum(counts.values())
    raw = {c: n * m / tot for c, m in counts.items()}
    q = {c: int(v) for c, v in raw.items()}
    for c in sorted(raw, key=lambda c: raw[c] - q[c], reverse=True)[: n - sum(q.values())]:
        q[c] += 1
    parts = [df.where(F.col(label) == c).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(k)
             for c, k in q.items() if k > 0]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

