"""Learners beat the majority baseline on a separable label; seeded runs repeat;
folds and samples have the contract shapes."""

import random

import pytest
from pyspark.sql import functions as F

from pastline.learners import data as D
from pastline.learners import models as L
from pastline.learners import search as V


@pytest.fixture(scope="module")
def xy(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        a, b, c = rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)
        score = [a - b, 0.3 * c, b - a]
        label = float(max(range(3), key=lambda k: score[k]))
        rows.append((i, a, b, c, label))
    df = spark.createDataFrame(rows, "match_id long, a double, b double, c double, label double")
    df = D.assemble(df, ["a", "b", "c"]).withColumn("seq", F.col("match_id"))
    return df.where("match_id < 600").checkpoint(), df.where("match_id >= 600").checkpoint()


@pytest.mark.parametrize("name", ["logreg", "tree", "forest", "nb", "samme", "boost", "svm"])
def test_learner_beats_majority(xy, name):
    tr, va = xy
    base = V.evaluate(L.fit_majority(tr), va)["f1_macro"]
    fit = {"logreg": lambda t: L.fit_logreg(t, C=1.0), "tree": lambda t: L.fit_tree(t, max_depth=4, min_leaf=5),
           "forest": lambda t: L.fit_forest(t, n_trees=10, max_depth=5, min_leaf=5),
           "nb": lambda t: L.fit_gaussian_nb(t, ["a", "b", "c"]), "samme": lambda t: L.fit_samme(t, rounds=4),
           "boost": lambda t: L.fit_boost(t, None, rounds=4, depth=3)[0],
           "svm": lambda t: L.fit_linear_svm(t, C=0.05)}[name]
    m = fit(tr)
    got = V.evaluate(m, va)
    assert got["f1_macro"] > base + 0.2
    # probabilities sum to one
    s = m.transform(va).select((F.col("p0") + F.col("p1") + F.col("p2")).alias("s")).agg(
        F.min("s"), F.max("s")).first()
    assert s[0] == pytest.approx(1.0, abs=1e-9) and s[1] == pytest.approx(1.0, abs=1e-9)


def test_same_seed_same_result(xy):
    tr, va = xy
    a = V.evaluate(L.fit_forest(tr, n_trees=8, seed=5), va)
    b = V.evaluate(L.fit_forest(tr, n_trees=8, seed=5), va)
    assert a == b


def test_expanding_folds_arithmetic():
    folds = D.expanding_folds(191_099, 5)
    assert folds[0][1] == 31_854 and folds[0][2] - folds[0][1] == 31_849
    assert folds[-1][2] == 191_099


def test_stratified_folds_and_sample(spark, xy):
    tr, _ = xy
    j, fold = D.stratified_fold_col(tr, label="label", seq="seq", k=5)
    counts = {(r[0], r[1]): r[2] for r in j.groupBy("label", fold.alias("f")).count().collect()}
    for c in {k[0] for k in counts}:
        sizes = [counts.get((c, f), 0) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    s = D.stratified_sample(tr, 100, key="match_id")
    assert s.count() == 100
    u = D.uniform_sample(tr, 50, key="match_id")
    assert u.count() == 50 and u.select("match_id").distinct().count() == 50


@pytest.mark.parametrize("k, name", [(2, "logreg"), (2, "tree"), (2, "boost"), (2, "svm"), (4, "logreg"), (4, "nb"),
                                     (4, "samme"), (4, "boost"), (4, "stacking")])
def test_class_count_comes_from_the_labels(spark, k, name):
    rnd = random.Random(k)
    rows = [(i, rnd.gauss(3.0 * (i % k == 1), 0.6), rnd.gauss(3.0 * (i % k == 2), 0.6),
             rnd.gauss(3.0 * (i % k == 3), 0.6), float(i % k)) for i in range(400)]
    df = D.assemble(spark.createDataFrame(rows, "match_id long, a double, b double, c double, label double")
                    .coalesce(2), ["a", "b", "c"])
    fit = {"logreg": lambda t: L.fit_logreg(t), "tree": lambda t: L.fit_tree(t, max_depth=4, min_leaf=5),
           "nb": lambda t: L.fit_gaussian_nb(t, ["a", "b", "c"]), "samme": lambda t: L.fit_samme(t, rounds=4),
           "boost": lambda t: L.fit_boost(t, None, rounds=2, depth=3)[0], "svm": lambda t: L.fit_linear_svm(t, C=1.0),
           "stacking": lambda t: L.fit_stacking(t, F.floor(F.col("match_id") / k) % 2, [
               lambda u: L.fit_tree(u, max_depth=4, min_leaf=5), lambda u: L.fit_gaussian_nb(u, ["a", "b", "c"])],
               k=2)}[name]
    m = fit(df)
    assert m.k == k
    out = m.transform(df)
    assert f"p{k - 1}" in out.columns and f"p{k}" not in out.columns
    assert {r[0] for r in out.select("pred").distinct().collect()} == set(range(k))
    assert V.evaluate(m, df, with_probs=k == 2)["accuracy"] > 0.85


def test_a_part_without_the_last_class(spark):
    """A fit that never saw a class gives it probability 0 beside fits that did."""
    rows = [(i, float(i % 3), float(i % 3)) for i in range(90)]
    df = D.assemble(spark.createDataFrame(rows, "match_id long, a double, label double"), ["a"])
    # fold 0 holds every row of class 2: the bases fitted without it know two classes
    m = L.fit_stacking(df, F.when(F.col("label") == 2, 0).otherwise((F.col("match_id") / 3).cast("int") % 2),
                       [lambda t: L.fit_tree(t, max_depth=2, min_leaf=1)], k=2)
    assert m.k == 3
    sums = m.transform(df).agg(F.count_if((F.col("p0") + F.col("p1") + F.col("p2")).between(1 - 1e-9, 1 + 1e-9))).first()
    assert sums[0] == 90


def test_calibration_sigmoids_are_at_the_minimum(spark):
    """The gradient of the smoothed loss vanishes per class, separable margins included."""
    import numpy as np
    rnd = random.Random(9)
    rows = [([rnd.gauss(1.5 * (i % 3 == 0), 1), 1.0 if i % 3 == 1 else -1.0, rnd.gauss(0, 2)], float(i % 3))
            for i in range(300)]
    df = spark.createDataFrame(rows, "_r array<double>, label double").coalesce(2)
    ab = L.sigmoids(df, {0.0: 100, 1.0: 100, 2.0: 100}, 3)
    r, y = np.array([x[0] for x in rows]), np.array([x[1] for x in rows])
    for c, (a, b) in enumerate(ab):
        p = 1 / (1 + np.exp(a * r[:, c] + b))
        t = np.where(y == c, 101 / 102, 1 / 202)
        assert abs(((p - t) * r[:, c]).sum()) < 1e-5 and abs((p - t).sum()) < 1e-5


def test_depth_beyond_the_limit_is_an_error(xy):
    with pytest.raises(ValueError):
        L.fit_tree(xy[0], max_depth=40)


def test_out_of_bag_curve(xy):
    from pastline.learners.bagging import oob_curve
    rows = oob_curve(xy[0], id_col="match_id", n_trees=5, report_at=[1, 5], max_depth=5, min_leaf=5)
    assert [r[0] for r in rows] == [1, 5] and rows[1][1] < 0.5
    # a row is out of one bag with probability 1/e, out of at least one of five with 1 - (1 - 1/e)^5
    assert 150 < rows[0][2] < 290 and rows[1][2] > 480


def test_permutation_importance_with_ids_beyond_double(spark, xy):
    from pastline.operators import explain as X
    tr, va = xy
    m = L.fit_tree(tr, max_depth=4, min_leaf=5)
    big = va.withColumn("match_id", F.col("match_id") + F.lit(1 << 60))
    r = {x["feature"]: x["importance_mean"] for x in X.permutation_importance(
        m, big, id_col="match_id", names=["a", "b", "c"], repeats=2).collect()}
    # the label weighs c at 0.3 of a and b
    assert set(r) == {"a", "b", "c"} and min(r["a"], r["b"]) > 2 * r["c"] > 0


def test_shapley_adds_up(xy):
    """Per row and class the values add up to f(x) - f(baseline)."""
    from pyspark.ml.functions import array_to_vector

    from pastline.operators import explain as X
    tr, va = xy
    m = L.fit_tree(tr, max_depth=4, min_leaf=5)
    rows = va.where("match_id < 610")
    phi = X.shapley_sampled(m, rows, [0.0, 0.0, 0.0], id_col="match_id", names=["a", "b", "c"], permutations=3)
    got = {r[0]: r[1:] for r in phi.groupBy("match_id").agg(*[F.sum(f"phi_p{c}") for c in range(3)]).collect()}
    at = {r[0]: r[1:] for r in m.transform(rows).select("match_id", "p0", "p1", "p2").collect()}
    zero = va.limit(1).select(array_to_vector(F.array(*[F.lit(0.0)] * 3)).alias("features"))
    f0 = m.transform(zero).select("p0", "p1", "p2").first()
    for i, vals in got.items():
        assert vals == pytest.approx([a - b for a, b in zip(at[i], f0)], abs=1e-9)


def test_logistic_gradient_is_zero(xy):
    """At the fit, the gradient of the balanced, penalised loss vanishes."""
    import numpy as np
    tr, _ = xy
    m = L.fit_logreg(tr, C=1.0, max_iter=500)
    W, b = m.model.coefficientMatrix.toArray(), m.model.interceptVector.toArray()
    pdf = tr.select("a", "b", "c", "label").toPandas()
    X, y = pdf[["a", "b", "c"]].to_numpy(), pdf["label"].to_numpy().astype(int)
    n = np.bincount(y, minlength=3)
    w = (len(y) / (3 * n))[y]
    z = X @ W.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    g = ((p - np.eye(3)[y]) * w[:, None]).T @ X + W
    assert np.abs(g).max() < 0.1
