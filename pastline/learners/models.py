"""Learners (L1 to L13, L15, L16) behind one small interface.

Each fitted model's ``transform(df)`` adds class probabilities ``p0..p{k-1}``
and ``pred`` (argmax, first on ties); ``k``, the number of classes, comes from
the labels of the fit and stays with the model. Fitting is distributed by Spark
(``pyspark.ml`` tree/linear solvers aggregate over executors); loops that
grow a plan (boosting, SAMME) checkpoint their running scores into the
shared checkpoint folder every few rounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest, OneVsRestModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pastline.learners.data import (
    FEATURES, LABEL, WEIGHT, balanced_weights, class_counts, hash_uniform, with_weights,
)
from pastline.learners.parallel import fits_at_once, pmap
from pastline.operators.metrics import EPS, argmax_class
from pastline.sources.scratch import stored

#: the depth beyond which Spark's trees refuse to fit
MAX_DEPTH = 30


def n_classes(df: DataFrame) -> int:
    """Labels are the codes 0..k-1: one more than the largest label of the rows."""
    return int(df.agg(F.max(LABEL)).first()[0]) + 1


def room_for(df: DataFrame) -> int:
    """How many fits over the rows of ``df`` run together (see :mod:`pastline.learners.parallel`)."""
    first = df.select(FEATURES).first()
    return fits_at_once(df.sparkSession, df.count(), first[0].size) if first else 1


def prob_cols(k: int) -> list[str]:
    return [f"p{i}" for i in range(k)]


def _item(arr: str, i: int) -> Column:
    """Entry ``i`` of an array column; 0 for a class that a part of the rows did not have."""
    return F.coalesce(F.get(F.col(arr), F.lit(i)), F.lit(0.0))


def _depth(max_depth: int) -> int:
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} is beyond the {MAX_DEPTH} levels that Spark's trees can have")
    return max_depth


def _softmax(scores: Sequence[Column]) -> list[Column]:
    m = F.greatest(*scores)
    ex = [F.exp(s - m) for s in scores]
    tot = ex[0]
    for e in ex[1:]:
        tot = tot + e
    return [(e / tot) for e in ex]


def _with_probs(df: DataFrame, probs: Sequence[Column]) -> DataFrame:
    names = prob_cols(len(probs))
    return df.withColumns(dict(zip(names, probs))).withColumn("pred", argmax_class(names))


def _true_prob(probs: Sequence[Column]) -> Column:
    """The probability given to a row's own label; 0 for a label that the fit never saw."""
    return F.coalesce(F.get(F.array(*probs), F.col(LABEL).cast("int")), F.lit(0.0))


# ------------------------------------------------------------------ L1, L2

@dataclass
class Majority:
    """L1: always the most frequent train class; one-hot probabilities."""
    cls: int
    k: int

    def transform(self, df: DataFrame) -> DataFrame:
        return _with_probs(df, [F.lit(1.0 if i == self.cls else 0.0) for i in range(self.k)])


def fit_majority(train: DataFrame) -> Majority:
    counts = class_counts(train)
    return Majority(int(max(sorted(counts), key=lambda c: counts[c])), int(max(counts)) + 1)


@dataclass
class GaussianNB:
    """L2: per-class mean and population variance plus ``smoothing * max
    variance``; log-density as one column expression."""
    cols: list[str]
    priors: dict[int, float]
    means: dict[int, list[float]]
    vars: dict[int, list[float]]

    @property
    def k(self) -> int:
        return max(self.priors) + 1

    def log_joint(self) -> list[Column]:
        """Per class the log of prior times density; next to nothing for a class without rows."""
        scores = []
        for c in range(self.k):
            if c not in self.priors:
                scores.append(F.lit(-1e300))
                continue
            s = F.lit(math.log(self.priors[c]))
            for x, mu, v in zip(self.cols, self.means[c], self.vars[c]):
                s = s + F.lit(-0.5 * math.log(2 * math.pi * v)) - (F.col(x) - F.lit(mu)) ** 2 / F.lit(2 * v)
            scores.append(s)
        return scores

    def transform(self, df: DataFrame) -> DataFrame:
        return _with_probs(df, _softmax(self.log_joint()))


def nb_stats(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per class count, mean and population variance of each column (one aggregate)."""
    return train.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"),
                                    *[F.avg(c).alias(f"m_{c}") for c in cols],
                                    *[F.var_pop(c).alias(f"v_{c}") for c in cols])


def fit_gaussian_nb(train: DataFrame, cols: Sequence[str], var_smoothing: float = 1e-9) -> GaussianNB:
    cols = list(cols)
    rows = nb_stats(train, cols).collect()  # one row per class
    gv = train.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    eps = var_smoothing * max(float(gv[c] or 0.0) for c in cols)
    n = sum(r["n"] for r in rows)
    return GaussianNB(cols, {int(r[LABEL]): r["n"] / n for r in rows},
                      {int(r[LABEL]): [float(r[f"m_{c}"]) for c in cols] for r in rows},
                      {int(r[LABEL]): [float(r[f"v_{c}"]) + eps for c in cols] for r in rows})


# ------------------------------------------------------------------ Spark ml wrappers

@dataclass
class SparkProb:
    """A fitted ``pyspark.ml`` classifier with a probability column."""
    model: object

    @property
    def k(self) -> int:
        return self.model.numClasses

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df).withColumn("_pa", vector_to_array("probability"))
        out = out.drop("rawPrediction", "probability", "prediction")
        return _with_probs(out, [_item("_pa", i) for i in range(self.k)]).drop("_pa")


@dataclass
class SparkMargins:
    """One-vs-rest margins turned into probabilities by a softmax (no native probability)."""
    model: object

    @property
    def k(self) -> int:
        return len(self.model.models)

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df).withColumn("_ra", vector_to_array("rawPrediction"))
        out = out.drop("rawPrediction", "prediction")
        return _with_probs(out, _softmax([F.col("_ra")[i] for i in range(self.k)])).drop("_ra")


def weighted(train: DataFrame, balanced: bool) -> DataFrame:
    if not balanced:
        return train.withColumn(WEIGHT, F.lit(1.0))
    return with_weights(train, balanced_weights(class_counts(train)))


def fit_logreg(train: DataFrame, C: float = 1.0, balanced: bool = True, max_iter: int = 200) -> SparkProb:
    """L3: multinomial L2 logistic regression with sklearn's C: ``regParam = 1/(C*sum(w))``."""
    t = weighted(train, balanced).select(FEATURES, LABEL, WEIGHT)
    sw = t.agg(F.sum(WEIGHT)).first()[0]
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, family="multinomial",
                            regParam=1.0 / (C * sw), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=1e-6)
    return SparkProb(lr.fit(t))  # the solver keeps its own blocks of the rows; persisting them as well holds all twice


def fit_tree(train: DataFrame, max_depth: int = 5, min_leaf: int = 20, impurity: str = "gini",
             balanced: bool = True, seed: int = 42) -> SparkProb:
    """L4: decision tree (binned splits), class-balanced weights."""
    t = weighted(train, balanced)
    dt = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, impurity=impurity,
                                maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf, seed=seed)
    return SparkProb(dt.fit(t))


def fit_forest(train: DataFrame, n_trees: int = 50, max_depth: int = 10, min_leaf: int = 5,
               features: str = "sqrt", balanced: bool = True, seed: int = 42) -> SparkProb:
    """Random forest."""
    t = weighted(train, balanced)
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, numTrees=n_trees,
                                maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf,
                                featureSubsetStrategy=features, seed=seed)
    return SparkProb(rf.fit(t))


def fit_linear_svm(train: DataFrame, C: float = 1.0, balanced: bool = True, max_iter: int = 50,
                   tol: float = 1e-4) -> SparkMargins:
    """One-vs-rest linear SVM with class-balanced weights."""
    t = weighted(train, balanced).select(FEATURES, LABEL, WEIGHT)
    sw = t.agg(F.sum(WEIGHT)).first()[0]
    svc = LinearSVC(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, regParam=1.0 / (C * sw),
                    maxIter=max_iter, tol=tol, standardization=False)
    ovr = OneVsRest(classifier=svc, featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT)

    def against_rest(c):
        return svc.fit(t.withColumn("_one", (F.col(LABEL) == c).cast("double")), {svc.labelCol: "_one"})

    # the k binary problems are independent; each solver keeps its own blocks of the rows, so the rows
    # are not persisted beside them, as OneVsRest.fit would, and only as many run together as fit
    k = n_classes(t)
    models = pmap(against_rest, range(k), workers=min(8, k, room_for(t)))
    return SparkMargins(ovr._copyValues(OneVsRestModel(models=models)))


# ------------------------------------------------------------------ L10

@dataclass
class Calibrated:
    """Sigmoid calibration of one-vs-rest margins, averaged over folds."""
    members: list[tuple[object, list[tuple[float, float]]]]
    k: int

    def transform(self, df: DataFrame) -> DataFrame:
        # margins of every member as columns, then sigmoid, normalise, average
        out = df
        for j, (ovr, ab) in enumerate(self.members):
            out = ovr.transform(out).withColumn(f"_r{j}", vector_to_array("rawPrediction")).drop(
                "rawPrediction", "prediction")
        probs = [F.lit(0.0)] * self.k
        for j, (_, ab) in enumerate(self.members):
            sig = [1 / (1 + F.exp(F.lit(a) * F.col(f"_r{j}")[c] + F.lit(b))) for c, (a, b) in enumerate(ab)]
            tot = sum(sig[1:], sig[0])
            # a member whose folds lacked a class adds nothing to it
            probs = [p + (sig[c] / tot / len(self.members) if c < len(sig) else F.lit(0.0))
                     for c, p in enumerate(probs)]
        return _with_probs(out, probs).drop(*[f"_r{j}" for j in range(len(self.members))])


def sigmoids(margins: DataFrame, counts: dict[float, int], k: int, rounds: int = 40,
             tol: float = 1e-9) -> list[tuple[float, float]]:
    """Per class the ``(a, b)`` of ``1 / (1 + exp(a r + b))`` that fits the margins ``_r[class]`` best.

    Targets are smoothed, ``(n_pos + 1) / (n_pos + 2)`` and ``1 / (n_neg + 2)``,
    so a minimum exists for separable margins too. Newton's method with halved
    steps; a round is one aggregate for all classes."""
    n = sum(counts.values())
    pos = [counts.get(float(c), 0) for c in range(k)]
    at = [(0.0, math.log((p + 1) / (n - p + 1))) for p in pos]  # slope and intercept on r
    base: list = [None] * k  # the accepted point: loss, slope, intercept, step
    for _ in range(rounds):
        sums = []
        for c, (w, b) in enumerate(at):
            r = F.col("_r")[c]
            z = F.lit(w) * r + F.lit(b)
            t = F.when(F.col(LABEL) == c, (pos[c] + 1) / (pos[c] + 2)).otherwise(1 / (n - pos[c] + 2))
            p = 1 / (1 + F.exp(-z))
            h = p * (1 - p)
            sums += [F.sum(F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - t * z), F.sum((p - t) * r),
                     F.sum(p - t), F.sum(h * r * r), F.sum(h * r), F.sum(h)]
        row = margins.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        moved = False
        for c in range(k):
            loss, gw, gb, hww, hwb, hbb = row[6 * c: 6 * c + 6]
            if base[c] is None or loss <= base[c][0]:
                hww, hbb = hww + 1e-12, hbb + 1e-12
                det = hww * hbb - hwb * hwb
                step = ((hbb * gw - hwb * gb) / det, (hww * gb - hwb * gw) / det) if det > 0 else (gw, gb)
                base[c] = (loss, *at[c], step)
            else:  # overshot: half the step from the accepted point
                base[c] = (*base[c][:3], (base[c][3][0] / 2, base[c][3][1] / 2))
            _, w, b, (dw, db) = base[c]
            if max(abs(dw), abs(db)) > tol * (1 + abs(w) + abs(b)):
                at[c], moved = (w - dw, b - db), True
            else:
                at[c] = (w, b)
        if not moved:
            break
    return [(-w, -b) for _, w, b, _ in base]


def fit_calibrated_svm(train: DataFrame, fold: Column, k: int = 3, C: float = 1.0, max_iter: int = 50) -> Calibrated:
    """Fit the SVM on k-1 folds, a per-class sigmoid on the held-out margins.
    ``fold`` is a deterministic column of ``train``, which each fit reads anew."""
    train = train.select(FEATURES, LABEL, fold.alias("_cfold"))
    fold = F.col("_cfold")

    def member(f):
        tr, ho = train.where(fold != f), train.where(fold == f)
        svm = fit_linear_svm(tr, C=C, max_iter=max_iter)
        m = svm.model.transform(ho).withColumn("_r", vector_to_array("rawPrediction"))
        m = m.select("_r", LABEL).persist()
        try:
            return svm.model, sigmoids(m, class_counts(ho), svm.k)
        finally:
            m.unpersist()

    classes = n_classes(train)
    members = pmap(member, range(k), workers=min(k, max(1, room_for(train) // classes)))
    return Calibrated(members, classes)


# ------------------------------------------------------------------ L8

@dataclass
class FourierFeatures:
    """Random Fourier features ``sqrt(2/D) cos(x W + b)`` for an RBF kernel,
    computed in Arrow batches (one matrix product per batch)."""
    W: np.ndarray
    b: np.ndarray

    def transform(self, df: DataFrame, in_col: str = FEATURES, out: str = "rff") -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        W, b = self.W, self.b
        scale = math.sqrt(2.0 / W.shape[1])

        @F.pandas_udf("array<double>")
        def rff(x):  # x: pandas Series of numpy arrays
            X = np.stack(x.to_numpy())
            Z = scale * np.cos(X @ W + b)
            import pandas as pd
            return pd.Series(list(Z))

        return df.withColumn(out, array_to_vector(rff(vector_to_array(in_col))))


@dataclass
class OnFourier:
    """A linear model on random Fourier features."""
    features: FourierFeatures
    inner: SparkProb

    @property
    def k(self) -> int:
        return self.inner.k

    def transform(self, df: DataFrame) -> DataFrame:
        return self.inner.transform(self.features.transform(df).drop(FEATURES).withColumnRenamed("rff", FEATURES))


def fit_rff_svm(train: DataFrame, d: int, gamma: float = 0.01, n_features: int = 200, C: float = 1.0,
                seed: int = 42):
    rng = np.random.default_rng(seed)
    ff = FourierFeatures(rng.normal(0.0, math.sqrt(2 * gamma), size=(d, n_features)),
                         rng.uniform(0, 2 * math.pi, size=n_features))
    t = ff.transform(train).drop(FEATURES).withColumnRenamed("rff", FEATURES)
    inner = fit_logreg(t, C=C)

    return OnFourier(ff, inner)


# ------------------------------------------------------------------ L7

@dataclass
class Samme:
    """SAMME boosting of shallow balanced trees."""
    k: int
    members: list[tuple[object, float]] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        votes = [F.lit(0.0)] * self.k
        out = df
        for j, (m, a) in enumerate(self.members):
            out = m.transform(out).withColumnRenamed("prediction", f"_y{j}").drop("rawPrediction", "probability")
            votes = [v + F.when(F.col(f"_y{j}") == c, F.lit(a)).otherwise(0.0) for c, v in enumerate(votes)]
        tot = sum(a for _, a in self.members) or 1.0
        return _with_probs(out, [v / tot for v in votes]).drop(*[f"_y{j}" for j in range(len(self.members))])


def fit_samme(train: DataFrame, rounds: int = 10, rate: float = 1.0, depth: int = 3, checkpoint_every: int = 5,
              seed: int = 42) -> Samme:
    """Each round's hits and misses are persisted until the next round's are
    there; one aggregate gives the error and the sum of the new weights."""
    counts = class_counts(train)
    cw = balanced_weights(counts)
    cwm = F.create_map(*[F.lit(x) for c, w in cw.items() for x in (float(c), float(w))])
    k, n = int(max(counts)) + 1, sum(counts.values())
    d = train.select(FEATURES, LABEL).withColumn("_sw", F.lit(1.0 / n))
    model, held = Samme(k), None
    for m in range(rounds):
        fit_in = d.withColumn(WEIGHT, F.col("_sw") * F.element_at(cwm, F.col(LABEL)))
        tree = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxDepth=_depth(depth),
                                      seed=seed + m).fit(fit_in)
        pr = tree.transform(d).select(FEATURES, LABEL, "_sw", (F.col("prediction") != F.col(LABEL)).alias("_miss"))
        pr = pr.checkpoint() if (m + 1) % checkpoint_every == 0 else pr.persist()
        missed, total = pr.agg(F.sum(F.when(F.col("_miss"), F.col("_sw")).otherwise(0.0)), F.sum("_sw")).first()
        if held is not None:
            held.unpersist()
        held, err = pr, missed / total
        if err <= 0:
            model.members.append((tree, 1.0))
            break
        if err >= 1 - 1.0 / k:
            break
        alpha = rate * (math.log((1 - err) / err) + math.log(k - 1))
        model.members.append((tree, alpha))
        grown = total - missed + missed * math.exp(alpha)
        d = pr.select(FEATURES, LABEL, (F.col("_sw") * F.when(F.col("_miss"), F.lit(math.exp(alpha) / grown))
                                        .otherwise(1.0 / grown)).alias("_sw"))
    if held is not None:
        held.unpersist()
    return model


# ------------------------------------------------------------------ L11 to L13

@dataclass
class Boost:
    """Softmax gradient boosting with second-order leaf values
    ``-sum(g) / (sum(h) + lambda)`` (leaf values kept as literal maps)."""
    rate: float
    k: int
    trees: list[list[tuple[object, dict[float, float]]]] = field(default_factory=list)

    def scores(self, df: DataFrame, rounds: int | None = None) -> DataFrame:
        out = df.withColumns({f"_f{c}": F.lit(0.0) for c in range(self.k)})
        for r, per_class in enumerate(self.trees[: rounds]):
            for c, (tree, leaves) in enumerate(per_class):
                leaf = f"_leaf{r}_{c}"
                out = tree.setLeafCol(leaf).setPredictionCol(f"_tp{r}_{c}").transform(out)
                lm = F.create_map(*[F.lit(x) for k_, v in leaves.items() for x in (float(k_), float(v))])
                out = out.withColumn(f"_f{c}", F.col(f"_f{c}") + F.lit(self.rate) *
                                     F.coalesce(F.element_at(lm, F.col(leaf)), F.lit(0.0))).drop(leaf, f"_tp{r}_{c}")
        return out

    def transform(self, df: DataFrame, rounds: int | None = None) -> DataFrame:
        out = self.scores(df, rounds)
        raw = [f"_f{c}" for c in range(self.k)]
        return _with_probs(out, _softmax([F.col(c) for c in raw])).drop(*raw)


BOOST_PRESETS = {
    # depth-wise trees, L2 leaf penalty, row subsampling
    "depthwise": dict(depth=4, min_leaf=1, lam=1.0, rate=0.1, subsample=0.8),
    # many small leaves, larger minimum leaf size
    "leafwise": dict(depth=6, min_leaf=40, lam=0.0, rate=0.05, subsample=1.0),
    # symmetric-depth style: deeper L2, slower rate
    "ordered": dict(depth=5, min_leaf=1, lam=3.0, rate=0.08, subsample=1.0),
}


def fit_boost(train: DataFrame, val: DataFrame | None = None, *, rounds: int = 20, depth: int = 4,
              min_leaf: int = 1, lam: float = 1.0, rate: float = 0.1, subsample: float = 1.0,
              balanced: bool = True, early_stop: int = 50, checkpoint_every: int = 5, seed: int = 42,
              id_col: str = "match_id") -> tuple[Boost, int]:
    """Returns the model and the number of rounds kept (early stopping on
    the validation log loss when ``val`` is given). Row subsampling keeps a
    row in a round when a seeded hash of its id falls below the rate.

    Train and validation scores are carried as columns and updated with
    each round's trees only (no re-scoring through earlier rounds). A round
    keeps one frame, the rows with their leaves in its trees: it gives the
    leaf values of all classes in one aggregate and, with them, the next
    round's scores. The lineage is cut by storing the frame every
    ``checkpoint_every`` rounds. Frames are kept on the executors' disks: their
    memory is left to the copies of the rows that Spark's trees make, of as
    many classes at a time as fit."""
    k, at_once = n_classes(train), room_for(train)
    f = [f"_f{c}" for c in range(k)]
    zero = [F.lit(0.0).alias(c) for c in f]
    base = [id_col, FEATURES, LABEL, WEIGHT]
    first = weighted(train, balanced).select(*base, *zero).persist(StorageLevel.DISK_ONLY)
    t, held = first, first
    v = val.select(FEATURES, LABEL, *zero).persist(StorageLevel.DISK_ONLY) if val is not None else None
    model = Boost(rate, k)
    best, best_r, since = float("inf"), 0, 0

    def leaved(df, regs):
        for c, reg in enumerate(regs):
            df = reg.setLeafCol(f"_leaf{c}").setPredictionCol(f"_tp{c}").transform(df).drop(f"_tp{c}")
        return df

    def moved(df, per_class, keep):
        new = []
        for c, (_, leaves) in enumerate(per_class):
            lm = F.create_map(*[F.lit(x) for k_, v_ in leaves.items() for x in (float(k_), float(v_))])
            new.append((F.col(f[c]) + F.lit(rate) * F.coalesce(F.element_at(lm, F.col(f"_leaf{c}")), F.lit(0.0))).alias(f[c]))
        return df.select(*keep, *new)

    for r in range(rounds):
        probs = _softmax([F.col(c) for c in f])
        taken = hash_uniform(F.col(id_col), F.lit(seed + r)) < subsample if subsample < 1.0 else F.lit(True)
        g = [(probs[c] - (F.col(LABEL) == c).cast("double")) * F.col(WEIGHT) for c in range(k)]
        h = [F.greatest(probs[c] * (1 - probs[c]), F.lit(1e-16)) * F.col(WEIGHT) for c in range(k)]

        def fit_class(c):
            tc = t.where(taken).select(FEATURES, g[c].alias("_g"), h[c].alias("_h")).withColumn("_t", -F.col("_g") / F.col("_h"))
            return DecisionTreeRegressor(featuresCol=FEATURES, labelCol="_t", weightCol="_h", maxDepth=depth,
                                         minInstancesPerNode=min_leaf, seed=seed + r).fit(tc)

        regs = pmap(fit_class, range(k), workers=min(8, k, at_once))  # the k class trees of a round are independent
        lt = leaved(t, regs)
        lt = stored(lt, "boost-round") if (r + 1) % checkpoint_every == 0 else lt.persist(StorageLevel.DISK_ONLY)
        # one row per class and leaf (at most 2^depth): the leaf values come back as literal maps
        sums = lt.where(taken).select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"_leaf{c}").alias("leaf"), g[c].alias("g"), h[c].alias("h"))
                                                          for c in range(k)])).alias("s")).groupBy("s.c", "s.leaf").agg(F.sum("s.g").alias("g"), F.sum("s.h").alias("h"))
        leaves: list[dict] = [{} for _ in range(k)]
        for row in sums.collect():
            leaves[row["c"]][row["leaf"]] = -row["g"] / (row["h"] + lam)
        held.unpersist()  # the aggregate has passed over all rows of the new frame
        per_class = list(zip(regs, leaves))
        model.trees.append(per_class)
        held, t = lt, moved(lt, per_class, base)
        if v is not None:
            nv = moved(leaved(v, regs), per_class, [FEATURES, LABEL]).persist(StorageLevel.DISK_ONLY)
            pt = _true_prob(_softmax([F.col(c) for c in f]))
            loss = nv.agg(F.avg(-F.ln(F.least(F.greatest(pt, F.lit(EPS)), F.lit(1 - EPS))))).first()[0]
            v.unpersist()
            v = nv
            if loss < best - 1e-12:
                best, best_r, since = loss, r + 1, 0
            else:
                since += 1
                if since >= early_stop:
                    break
        else:
            best_r = r + 1
    held.unpersist()
    if v is not None:
        v.unpersist()
    model.trees = model.trees[:best_r]
    return model, best_r


def boost_log_loss(model: Boost, df: DataFrame) -> float:
    out = model.transform(df.select(FEATURES, LABEL))
    pt = _true_prob([F.col(p) for p in prob_cols(model.k)])
    return out.agg(F.avg(-F.ln(F.least(F.greatest(pt, F.lit(EPS)), F.lit(1 - EPS))))).first()[0]


# ------------------------------------------------------------------ L15, L16

@dataclass
class Stacked:
    """Base models' probabilities -> balanced logistic meta model."""
    bases: list[object]
    meta: SparkProb | None
    k: int

    def meta_features(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        out = df
        cols = []
        for j, b in enumerate(self.bases):
            own = prob_cols(b.k)
            out = b.transform(out).withColumns({f"_s{j}_{c}": F.col(own[c]) if c < b.k else F.lit(0.0)
                                                for c in range(self.k)}).drop(*own, "pred")
            cols += [f"_s{j}_{c}" for c in range(self.k)]
        return out.withColumn("_meta", array_to_vector(F.array(*[F.col(c) for c in cols]))).drop(*cols)

    def transform(self, df: DataFrame) -> DataFrame:
        m = self.meta_features(df).withColumnRenamed(FEATURES, "_orig").withColumnRenamed("_meta", FEATURES)
        return self.meta.transform(m).drop(FEATURES).withColumnRenamed("_orig", FEATURES)


def fit_stacking(train: DataFrame, fold: Column, base_fits: Sequence, k: int = 5) -> Stacked:
    """Out-of-fold probabilities of each base (contiguous stratified folds),
    a balanced logistic meta model on them, bases refit on all train rows.
    ``fold`` is a deterministic column of ``train``, which each fit reads anew;
    the out-of-fold rows are stored. Folds and refits run together as far as
    the copies of their rows fit the executors."""
    t = train.withColumn("_fold", fold)
    classes, at_once = n_classes(t), room_for(t)

    def fold_oof(f):
        tr, ho = t.where(F.col("_fold") != f), t.where(F.col("_fold") == f)
        fitted = [fit(tr) for fit in base_fits]
        out = Stacked(fitted, None, classes).meta_features(ho).select("_meta", LABEL)
        return stored(out, "out-of-fold")

    oof_parts = pmap(fold_oof, range(k), workers=min(k, at_once))
    oof = oof_parts[0]
    for p in oof_parts[1:]:
        oof = oof.unionByName(p)
    meta = fit_logreg(oof.withColumnRenamed("_meta", FEATURES), C=1.0)
    full = t.drop("_fold")
    return Stacked(pmap(lambda fit: fit(full), base_fits, workers=min(len(base_fits), at_once)), meta, classes)
