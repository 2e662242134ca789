"""Temporal validation and hyper-parameter search.

The driver loops over (parameter, fold); every fit and every score is a
distributed Spark job. Folds are filters on a dense chronological order,
so no data is copied per fold.
"""

from __future__ import annotations

import itertools
import random
import statistics
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.learners.data import LABEL, fold_frames
from pastline.learners.models import prob_cols
from pastline.learners.parallel import pmap
from pastline.operators import metrics as M


def evaluate(model, df: DataFrame, *, with_probs: bool = True) -> dict:
    """V5..V8 on one frame: accuracy, macro F1, recall of class 1 (the draw),
    kappa, macro AUC and log loss. The rows are scored once and kept for the
    aggregates; the class table comes from their confusion counts."""
    names = prob_cols(model.k)
    scored = model.transform(df).select(F.col(LABEL).cast("int").alias(LABEL), *names, "pred").persist()
    try:
        counts = M.confusion_counts(scored)
        s = M.summary(counts).first()
        recall = M.per_class(counts).where(F.col("cls") == 1).select("recall").first()
        out = {"f1_macro": s["f1_macro"], "accuracy": s["accuracy"], "kappa": s["kappa"],
               "recall_D": float(recall[0]) if recall else 0.0}
        if with_probs:
            out["roc_auc"] = M.auc_macro(M.auc_ovr(scored, label=LABEL, p_cols=names)).first()[0]
            out["log_loss"] = M.log_loss(scored, label=LABEL, p_cols=names).first()[0]
        return out
    finally:
        scored.unpersist()


def macro_f1(model, df: DataFrame) -> float:
    scored = model.transform(df).select(F.col(LABEL).cast("int").alias(LABEL), "pred")
    return M.summary(M.confusion_counts(scored)).first()["f1_macro"]


def validation_curve(fit: Callable[[DataFrame, object], object], values: Sequence, train: DataFrame, *,
                     seq: str, n: int, k: int = 5) -> list[dict]:
    """V2: train and fold scores per value; mean and population deviation."""
    folds = list(fold_frames(train, seq, n, k))

    def one(args):
        v, (_, tr, te) = args
        m = fit(tr, v)
        return v, macro_f1(m, tr), macro_f1(m, te)

    res = pmap(one, [(v, f) for v in values for f in folds], workers=4)
    rows = []
    for v in values:
        tr_s = [a for vv, a, _ in res if vv == v]
        te_s = [b for vv, _, b in res if vv == v]
        rows.append({"value": str(v), "train_mean": statistics.fmean(tr_s), "fold_mean": statistics.fmean(te_s),
                     "fold_std": statistics.pstdev(te_s)})
    return rows


def best_of(rows: list[dict], key: str = "fold_mean") -> dict:
    """First maximum (ties keep the earlier value)."""
    best = rows[0]
    for r in rows[1:]:
        if r[key] > best[key]:
            best = r
    return best


def grid(space: Mapping[str, Sequence]) -> list[dict]:
    keys = list(space)
    return [dict(zip(keys, combo)) for combo in itertools.product(*[space[k] for k in keys])]


def random_draws(space: Mapping[str, object], n_iter: int, seed: int = 42) -> list[dict]:
    """V4: seeded draws. A space entry is a list (choice), ``("uniform",
    loc, scale)`` meaning [loc, loc+scale], or ``("randint", lo, hi)`` (hi excluded)."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n_iter):
        d = {}
        for k, spec in space.items():
            if isinstance(spec, tuple) and spec[0] == "uniform":
                d[k] = spec[1] + rnd.random() * spec[2]
            elif isinstance(spec, tuple) and spec[0] == "randint":
                d[k] = rnd.randrange(spec[1], spec[2])
            else:
                d[k] = rnd.choice(list(spec))
        out.append(d)
    return out


def search(fit: Callable[..., object], candidates: list[dict], train: DataFrame, *, seq: str, n: int,
           k: int = 5) -> tuple[dict, list[dict]]:
    """V3/V4: mean fold macro F1 per candidate over expanding folds; returns
    the best candidate (first on ties) and all rows."""
    folds = list(fold_frames(train, seq, n, k))
    res = pmap(lambda a: macro_f1(fit(a[1][1], **candidates[a[0]]), a[1][2]),
               [(i, f) for i in range(len(candidates)) for f in folds], workers=4)
    rows = []
    for i, cand in enumerate(candidates):
        scores = res[i * len(folds):(i + 1) * len(folds)]
        rows.append({"params": cand, "fold_mean": statistics.fmean(scores), "fold_std": statistics.pstdev(scores)})
    return best_of(rows)["params"], rows


def leak_probe(metrics_by_model: Mapping[str, dict], max_accuracy: float = 0.65) -> list[dict]:
    """Validation accuracy of simple models must stay below a plausible ceiling."""
    return [{"model": m, "accuracy": v["accuracy"], "f1_macro": v["f1_macro"],
             "suspicious": v["accuracy"] > max_accuracy} for m, v in metrics_by_model.items()]
