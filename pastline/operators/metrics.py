"""Evaluation, significance and model registry.

Every metric starts from one distributed aggregate - the confusion counts
``(label, pred) -> n`` (at most k*k rows), per-class log-likelihood sums,
or per-(class, score) counts with prefix sums - and finishes on that small
table. Predictions of several models are scored in one pass over a long
table ``(id, model, label, pred, p0..pk)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pastline.functions.special import signed_rank_upper_tail
from pastline.operators.stats import value_prefix

EPS = 2.220446049250313e-16  # machine epsilon of float64: the log-loss clip


def argmax_class(p_cols: Sequence[str]) -> Column:
    """Index of the largest probability; the first index wins on ties."""
    best = F.array_max(F.array(*[F.struct(F.col(c).alias("p"), F.lit(-i).alias("neg_i"))
                                 for i, c in enumerate(p_cols)]))
    return (-best["neg_i"]).cast("int")


def confusion_counts(df: DataFrame, *, label: str = "label", pred: str = "pred",
                     by: Sequence[str] = ()) -> DataFrame:
    """``by..., label, pred, n`` - the only pass over the rows."""
    return df.groupBy(*by, label, pred).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame, labels: Sequence, *, label: str = "label", pred: str = "pred",
                     by: Sequence[str] = ()) -> DataFrame:
    """V9: one row per true label, raw counts ``n_<p>`` and row shares ``r_<p>``."""
    g = counts.groupBy(*by, label).agg(*[F.sum(F.when(F.col(pred) == p, F.col("n")).otherwise(0)).alias(f"n_{p}")
                                         for p in labels])
    tot = sum((F.col(f"n_{p}") for p in labels), F.lit(0))
    return g.select(*by, label, *[F.col(f"n_{p}").cast("bigint") for p in labels],
                    *[F.round(F.try_divide(F.col(f"n_{p}"), tot), 6).alias(f"r_{p}") for p in labels])


def per_class(counts: DataFrame, labels: Sequence | None = None, *, label: str = "label", pred: str = "pred",
              by: Sequence[str] = ()) -> DataFrame:
    """V5: per class tp, support, predicted count, precision, recall, f1
    (zero division -> 0). ``labels=None`` uses the observed labels (true or
    predicted); a fixed list keeps absent labels with zeros."""
    long = counts.select(*by, F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.col("n").alias("sup"), F.lit(0).cast("bigint").alias("pr"),
                 F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).cast("bigint").alias("sup"), F.col("n").alias("pr"),
                 F.lit(0).cast("bigint").alias("tp")))).alias("s")).select(*by, "s.*")
    g = long.groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("sup").alias("support"),
                                     F.sum("pr").alias("predicted"))
    if labels is not None:
        g = g.where(F.col("cls").isin(*labels))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    g = g.withColumns({"precision": prec.cast("double"), "recall": rec.cast("double")})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return g.withColumn("f1", f1)


def summary(counts: DataFrame, labels: Sequence | None = None, *, label: str = "label", pred: str = "pred",
            by: Sequence[str] = ()) -> DataFrame:
    """V5 + V6: accuracy, macro and weighted precision/recall/F1 and Cohen's
    kappa per ``by`` group, from the confusion counts only.

    With a fixed ``labels`` list, an absent label counts as 0 in the macro
    mean (it is kept with zero support)."""
    pc = per_class(counts, labels, label=label, pred=pred, by=by)
    k = F.count(F.lit(1)) if labels is None else F.lit(len(labels))
    sup = F.sum("support")
    agg = pc.groupBy(*by).agg(
        (F.sum("precision") / k).alias("macro_precision"), (F.sum("recall") / k).alias("macro_recall"),
        (F.sum("f1") / k).alias("f1_macro"),
        (F.sum(F.col("precision") * F.col("support")) / sup).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / sup).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / sup).alias("weighted_f1"),
        sup.alias("n"), (F.sum("tp") / sup).alias("accuracy"),
        (F.sum(F.col("support") * F.col("predicted")) / (sup * sup)).alias("_pe"))
    return agg.withColumn("kappa", F.when(F.col("_pe") < 1, (F.col("accuracy") - F.col("_pe")) / (1 - F.col("_pe")))
                          .otherwise(F.lit(0.0))).drop("_pe")


def log_loss(df: DataFrame, *, label: str, p_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """V8: mean of ``-ln p(true class)``, p clipped to [eps, 1-eps]."""
    pt = F.element_at(F.array(*[F.col(c) for c in p_cols]), F.col(label).cast("int") + 1)
    clipped = F.least(F.greatest(pt, F.lit(EPS)), F.lit(1 - EPS))
    return df.groupBy(*by).agg(F.avg(-F.ln(clipped)).alias("log_loss"))


def _score_long(df: DataFrame, label: str, p_cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    return df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(i).alias("cls"), F.col(c).cast("double").alias("s"),
                 (F.col(label) == i).cast("long").alias("pos"), (F.col(label) != i).cast("long").alias("neg"))
        for i, c in enumerate(p_cols)])).alias("x")).select(*by, "x.*")


def auc_ovr(df: DataFrame, *, label: str, p_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """V7: one-vs-rest ROC-AUC per class (ties count one half) and the macro mean:
    ``sum_v pos(v) * (neg below v + neg(v) / 2) / (P * N)`` over distinct scores."""
    long = _score_long(df, label, p_cols, by)
    vp = value_prefix(long, keys=[*by, "cls"], value="s", sums=["pos", "neg"])
    per = vp.groupBy(*by, "cls").agg(
        (F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)) /
         (F.sum("pos") * F.sum("neg"))).alias("auc"))
    return per


def auc_macro(per_class_auc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return per_class_auc.groupBy(*by).agg(F.avg("auc").alias("roc_auc"))


def roc_points(df: DataFrame, *, label: str, p_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per class and distinct score threshold t: fpr and tpr of ``s >= t``."""
    long = _score_long(df, label, p_cols, by).withColumn("s", -F.col("s"))  # descending
    vp = value_prefix(long, keys=[*by, "cls"], value="s", sums=["pos", "neg"])
    # totals per class from the prefix table (one row per distinct score)
    tot = vp.groupBy(*by, "cls").agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    j = vp.join(tot, [*by, "cls"])
    return j.select(*by, "cls", (-F.col("s")).alias("threshold"),
                    ((F.col("before_neg") + F.col("neg")) / F.col("_N")).alias("fpr"),
                    ((F.col("before_pos") + F.col("pos")) / F.col("_P")).alias("tpr"))


def block_f1(df: DataFrame, *, block: Column, labels: Sequence, label: str = "label", pred: str = "pred",
             by: Sequence[str] = (), min_rows: int = 50) -> DataFrame:
    """Macro F1 over a fixed label list per (by, block), blocks with at
    least ``min_rows`` rows."""
    d = df.withColumn("_block", block)
    counts = confusion_counts(d, label=label, pred=pred, by=[*by, "_block"])
    s = summary(counts, labels, label=label, pred=pred, by=[*by, "_block"])
    return s.where(F.col("n") >= min_rows).select(*by, F.col("_block").alias("block"), "n", "f1_macro")


def wilcoxon_greater(blocks: DataFrame, *, model_col: str, model: str, baseline: str,
                     block: str = "block", score: str = "f1_macro") -> dict:
    """One-sided Wilcoxon signed-rank test (model > baseline) over
    blocks present for both; zero differences dropped; exact tail by
    counting. Pairing and average ranks of |d| run in Spark on the block
    table; the exact tail is computed on the driver from (n, W)."""
    a = blocks.where(F.col(model_col) == model).select(block, F.col(score).alias("_a"))
    b = blocks.where(F.col(model_col) == baseline).select(block, F.col(score).alias("_b"))
    d = a.join(b, block).select(block, (F.col("_a") - F.col("_b")).alias("d")).where(F.col("d") != 0)
    w = Window.orderBy(F.abs(F.col("d")))  # the block table: a few dozen rows
    r = d.select("d", F.rank().over(w).alias("_r"),
                 F.count(F.lit(1)).over(Window.partitionBy(F.abs(F.col("d")))).alias("_t"))
    r = r.withColumn("rank", F.col("_r") + (F.col("_t") - 1) / 2.0)
    row = r.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("d") > 0, F.col("rank")).otherwise(0.0)).alias("W"),
                F.avg("d").alias("mean_diff")).first()
    n, wstat = int(row["n"]), float(row["W"] or 0.0)
    p = signed_rank_upper_tail(wstat, n) if n > 0 else 1.0
    return {"model": model, "baseline": baseline, "n_blocks": n, "W": wstat,
            "p_value": p, "mean_diff": float(row["mean_diff"] or 0.0)}


def soft_vote(long_probs: DataFrame, *, id_col: str, models: Sequence[str], p_cols: Sequence[str],
              model_col: str = "model") -> DataFrame:
    """Mean class probabilities of frozen models per id; argmax."""
    g = long_probs.where(F.col(model_col).isin(*models)).groupBy(id_col).agg(
        *[F.avg(c).alias(c) for c in p_cols])
    return g.withColumn("pred", argmax_class(p_cols))


def register(registry: DataFrame | None, new: DataFrame, key: str = "model") -> DataFrame:
    """Upsert by key - old rows whose key is in ``new`` are replaced."""
    if registry is None:
        return new
    return registry.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def proposed(table: DataFrame, *, family_col: str = "family", family: str = "ensemble",
             val_col: str = "val_f1_macro", test_col: str = "test_f1_macro", name: str = "model") -> DataFrame:
    """Best validation score inside the family, else over all models;
    a missing validation score falls back to the test score; first on ties."""
    score = F.coalesce(F.col(val_col), F.col(test_col))
    fam = table.where(F.col(family_col) == family)
    pool = fam if fam.limit(1).count() > 0 else table
    return pool.orderBy(F.desc(score), name).limit(1)
