"""Attribution (X1, X2) as batch jobs: every permuted or partially-revealed
row is generated with array expressions and scored in ONE ``transform``;
results come from one ``groupBy``. No per-column driver loop of jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.learners.data import FEATURES, LABEL
from pastline.learners.models import prob_cols
from pastline.operators import metrics as M
from pastline.operators.history import dense_order
from pastline.sources.scratch import stored


#: Scored points per task: rows are few and multiply, so they are dealt by the points they become.
POINTS = 1 << 18


def _replace_at(arr, idx, val):
    """``arr`` with element ``idx`` (0-based) replaced by ``val``."""
    return F.transform(arr, lambda x, i: F.when(i == idx, val).otherwise(x))


def permutation_importance(model, df: DataFrame, *, id_col: str, names: Sequence[str], repeats: int = 5,
                           seed: int = 42) -> DataFrame:
    """Drop in macro F1 when one column is shuffled, mean and deviation
    over repeats. A shuffle pairs the order of the ids with an order by a hash
    (ids break ties, so every row has exactly one donor in each repeat; ids
    must differ, of any ordered type), then every (repeat, column) copy is
    scored in a single batch."""
    d = df.select(id_col, F.col(LABEL).cast("int").alias(LABEL), vector_to_array(FEATURES).alias("_a"))
    base = M.summary(M.confusion_counts(model.transform(df.select(FEATURES, LABEL))
                                        .select(F.col(LABEL).cast("int").alias(LABEL), "pred"))).first()["f1_macro"]
    own = stored(dense_order(d, time=id_col, tie=[], out="_pos"), "own-order")
    n = own.count()
    reps = own.select(id_col, F.col("_a").alias("_da"), F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_r"))
    reps = reps.withColumn("_h", F.xxhash64(F.col(id_col), F.col("_r"), F.lit(seed)))
    # each repeat holds n rows, so a row's place in its repeat is its place among all less the repeats before
    donor = dense_order(reps, time="_r", tie=["_h", id_col], out="_hp")
    donor = donor.select("_r", (F.col("_hp") - F.col("_r") * F.lit(n)).alias("_pos"), "_da")
    k = len(names)
    # a pair becomes k points: dealt so that a task scores POINTS of them, however small the pairs are
    pairs = own.join(donor.repartition(max(1, -(-n * repeats * k // POINTS)), "_pos"), "_pos")
    copies = pairs.select(LABEL, "_r", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_c"), "_a", "_da")
    copies = copies.select(LABEL, "_r", "_c", array_to_vector(_replace_at(F.col("_a"), F.col("_c"),
                                                                         F.col("_da")[F.col("_c")])).alias(FEATURES))
    scored = model.transform(copies).select(LABEL, "_r", "_c", "pred")
    f1 = M.summary(M.confusion_counts(scored, by=["_r", "_c"]), by=["_r", "_c"])
    nm = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (i, n)])
    return (f1.groupBy("_c").agg(F.avg(F.lit(base) - F.col("f1_macro")).alias("importance_mean"),
                                 F.stddev_pop(F.lit(base) - F.col("f1_macro")).alias("importance_std"))
            .select(F.element_at(nm, F.col("_c")).alias("feature"), "importance_mean", "importance_std")
            .orderBy(F.desc("importance_mean"), "feature"))


def shapley_sampled(model, rows: DataFrame, baseline: Sequence[float], *, id_col: str, names: Sequence[str],
                    permutations: int = 8, seed: int = 42) -> DataFrame:
    """Sampled-permutation Shapley values against a baseline point.

    Each (row, permutation) walks the features in permutation order, moving
    them from the baseline to the row's values; all ``rows x permutations x
    (d+1)`` points are scored in one transform. A feature's contribution is
    the change in class probability at its step; per row and permutation
    they add up to ``f(x) - f(baseline)`` exactly."""
    d = len(names)
    base = F.array(*[F.lit(float(b)) for b in baseline])
    x = rows.select(id_col, vector_to_array(FEATURES).alias("_x"))
    # dealt by the points the rows become; all that follows is grouped by the id, so this is the one exchange of rows
    x = x.repartition(max(1, -(-x.count() * permutations * (d + 1) // POINTS)), id_col)
    perm = x.select(id_col, "_x", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("_m"))
    # a seeded permutation of 0..d-1 per (row, m): sort indices by a hash
    order = F.transform(F.array_sort(F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda j: F.struct(F.xxhash64(F.col(id_col), F.col("_m"), j, F.lit(seed)).alias("h"), j.alias("j")))),
        lambda s: s["j"])
    perm = perm.withColumn("_o", order)
    # the place of each feature in the permutation
    rank = F.transform(F.array_sort(F.transform("_o", lambda j, i: F.struct(j.alias("j"), i.alias("i")))), lambda s: s["i"])
    perm = perm.withColumn("_rank", rank)
    steps = perm.select(id_col, "_m", "_x", "_o", "_rank", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("_s"))
    # features whose position in the permutation is < step take the row's value
    revealed = F.transform("_x", lambda v, j: F.when(F.get("_rank", j) < F.col("_s"), v).otherwise(base[j]))
    pts = steps.select(id_col, "_m", "_s", F.when(F.col("_s") > 0, F.col("_o")[F.col("_s") - 1]).alias("_feat"),
                       array_to_vector(F.when(F.col("_s") == 0, base).otherwise(revealed)).alias(FEATURES))
    probs = prob_cols(model.k)
    sc = model.transform(pts).select(id_col, "_m", "_s", "_feat", *probs)
    from pyspark.sql import Window
    w = Window.partitionBy(id_col, "_m").orderBy("_s")  # d+1 rows per (row, permutation)
    contrib = sc.select(id_col, "_m", "_feat", *[(F.col(p) - F.lag(p).over(w)).alias(f"c_{p}") for p in probs])
    contrib = contrib.where(F.col("_feat").isNotNull())
    nm = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (i, n)])
    per_row = contrib.groupBy(id_col, "_feat").agg(*[F.avg(f"c_{p}").alias(f"phi_{p}") for p in probs])
    return per_row.select(id_col, F.element_at(nm, F.col("_feat")).alias("feature"), *[f"phi_{p}" for p in probs])


def shapley_summary(phi: DataFrame, top: int = 15) -> DataFrame:
    """Mean |value| per feature, averaged over classes; top features."""
    values = [c for c in phi.columns if c.startswith("phi_")]
    mean_abs = sum((F.avg(F.abs(F.col(c))) for c in values), F.lit(0.0)) / len(values)
    return phi.groupBy("feature").agg(mean_abs.alias("mean_abs_shap")).orderBy(F.desc("mean_abs_shap"),
                                                                              "feature").limit(top)


def shapley_linear(coef: Sequence[Sequence[float]], means: Sequence[float], rows: DataFrame, *, id_col: str,
                   names: Sequence[str]) -> DataFrame:
    """X2, linear closed form: ``w_cj * (x_j - mean_j)`` on each class logit."""
    x = rows.select(id_col, vector_to_array(FEATURES).alias("_x"))
    out = x.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"),
                 *[(F.lit(float(coef[c][j])) * (F.col("_x")[j] - F.lit(float(means[j])))).alias(f"phi_p{c}")
                   for c in range(len(coef))])
        for j, n in enumerate(names)])).alias("s"))
    return out.select(id_col, "s.*")
