"""Sweeps whose candidates share their passes (V2, L2).

The statistics of every expanding fold of a Gaussian naive Bayes come from one
aggregate: the rows are cut at the folds' starts, each block has count, mean
and variance per class, and a fold's train part is the blocks before it, merged
on the driver (blocks x classes x columns numbers). The smoothing only shifts
variances, so all candidates of all folds are then scored in one more job.
"""

from __future__ import annotations

import statistics
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.learners import models as L
from pastline.learners.data import LABEL, expanding_folds
from pastline.operators import metrics as M


def merged(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, means and population variances of the union of (count, means, variances)."""
    n, mean, var = parts[0]
    for m, mu, v in parts[1:]:
        total, shift = n + m, mu - mean
        var = (n * var + m * v + n * m / total * shift ** 2) / total
        mean, n = mean + shift * m / total, total
    return n, mean, var


def nb_folds(train: DataFrame, cols: Sequence[str], smoothing: Sequence[float], *, seq: str, n: int, k: int = 5) -> list[dict[float, L.GaussianNB]]:
    """Per expanding fold the fitted models, by smoothing; one aggregate over ``train``."""
    cols, folds = list(cols), expanding_folds(n, k)
    block = sum((F.when(F.col(seq) >= a, 1).otherwise(0) for _, a, _ in folds), F.lit(0))
    stats = train.where(F.col(seq) < n).groupBy(block.alias("_block"), LABEL).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)])
    parts: dict[int, list] = {}
    for r in stats.collect():  # one row per block and class
        parts.setdefault(r["_block"], []).append((int(r[LABEL]), (r["n"], np.array([r[f"m{i}"] for i in range(len(cols))]), np.array([r[f"v{i}"] for i in range(len(cols))]))))
    out = []
    for i in range(k):
        before = [p for b in range(i + 1) for p in parts.get(b, [])]
        by_class = {c: merged([p for d, p in before if d == c]) for c in sorted({d for d, _ in before})}
        total, _, var = merged(list(by_class.values()))
        out.append({e: L.GaussianNB(cols, {c: m / total for c, (m, _, _) in by_class.items()}, {c: mu.tolist() for c, (_, mu, _) in by_class.items()},
                                    {c: (v + e * var.max()).tolist() for c, (_, _, v) in by_class.items()}) for e in smoothing})
    return out


def nb_curve(train: DataFrame, cols: Sequence[str], smoothing: Sequence[float], *, seq: str, n: int, k: int = 5) -> list[dict]:
    """V2 over the smoothing of L2: ``value, fold_mean, fold_std`` (population deviation) of the macro F1, best marked."""
    models, scored = nb_folds(train, cols, smoothing, seq=seq, n=n, k=k), None
    for (i, a, b), fitted in zip(expanding_folds(n, k), models):
        rows = train.where((F.col(seq) >= a) & (F.col(seq) < b))
        # the largest log score of each candidate, the first of equals: no probabilities are needed
        rows = rows.select(F.col(LABEL).cast("int").alias("label"), *[F.array(*fitted[e].log_joint()).alias(f"_s{j}") for j, e in enumerate(smoothing)])
        part = rows.select(F.lit(i).alias("fold"), "label", F.explode(F.array(*[
            F.struct(F.lit(j).alias("candidate"), (F.array_position(f"_s{j}", F.array_max(f"_s{j}")) - 1).cast("int").alias("pred"))
            for j in range(len(smoothing))])).alias("s")).select("fold", "label", "s.*")
        scored = part if scored is None else scored.unionByName(part)
    by = ["candidate", "fold"]
    got = {(r["candidate"], r["fold"]): r["f1_macro"] for r in M.summary(M.confusion_counts(scored, by=by), by=by).collect()}  # one row per candidate and fold
    out = [{"value": e, "fold_mean": statistics.fmean(f), "fold_std": statistics.pstdev(f)}
           for j, e in enumerate(smoothing) for f in [[got[j, i] for i in range(k) if (j, i) in got]]]
    best = max(out, key=lambda r: r["fold_mean"])["value"] if out else None
    return [r | {"best": r["value"] == best} for r in out]
