"""What the learners move and keep: one exchange for an order, no join for folds, points dealt over tasks."""

import os
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pastline.learners import data as D
from pastline.learners import models as L
from pastline.learners import neighbours as N
from pastline.operators import explain as X
from pastline.operators import history as H
from pastline.session import ensure_checkpoint_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, n=240, d=3, seed=1):
    draw = random.Random(seed)
    made = [(i, i, [draw.random() for _ in range(d)]) for i in range(n)]
    made = [(i, s, x, float(int(3 * x[0])) if draw.random() < 0.9 else float(draw.randrange(3))) for i, s, x in made]
    return spark.createDataFrame(made, "match_id long, seq long, x array<double>, label double").withColumn("features", array_to_vector("x"))


def checkpoints(spark):
    return {os.path.join(d, f) for d, _, fs in os.walk(ensure_checkpoint_dir(spark)) for f in fs if "/rdd-" in d}


def test_order_needs_no_second_exchange(spark):
    values = [3, 1, None, 2, 1, 5, None, 4] * 5
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "match_date int, match_id long")
    out = H.dense_order(df, buckets=7)
    assert "Exchange" not in plan(out) and "Window" not in plan(out)
    want = sorted(range(len(values)), key=lambda i: (values[i] is None, values[i] or 0, i))
    assert [r.match_id for r in out.orderBy("seq").collect()] == want
    assert sorted(r.seq for r in out.collect()) == list(range(len(values)))
    assert H.dense_order(df.limit(0), buckets=3).collect() == []


def test_order_stores_more_than_it_moves(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate([3, 1, 2])], "match_date int, match_id long")
    out = H.dense_order(df, buckets=2, then=lambda d: d.withColumn("wide", F.concat_ws("-", "match_date", "match_id")))
    assert [(r.seq, r.wide) for r in out.orderBy("seq").collect()] == [(0, "1-1"), (1, "2-2"), (2, "3-0")]
    assert out.columns == ["match_date", "match_id", "wide", "seq"]


def test_carries_meet_rows_where_they_are(spark):
    made = [(i, i // 4, 1, "H", float(i % 3), 1.0, i % 2 == 0) for i in range(60)]
    long = spark.createDataFrame(made, "match_id long, match_date int, entity int, venue string, gf double, ga double, won boolean")
    long = long.withColumn("match_date", F.timestamp_seconds(F.col("match_date") * 86400))
    out = H.entity_history(long, segment_rows=10)
    assert out.count() == 60
    # one exchange, of the light keys' rows: the summary of the segments is read, not computed beside them
    assert plan(out).count("Exchange hashpartitioning") == 1


def test_closed_forms_need_no_order(spark):
    from pastline.plans import q_learn as Q
    from tests.conftest import SF001
    x, names = Q.learn_rows(spark, SF001)
    assert "Exchange" not in plan(x)
    y, same, _ = Q.learn_data(spark, SF001)
    assert names == same and sorted(y.columns) == sorted([*x.columns, "seq"])
    assert {tuple(r) for r in x.drop("features").collect()} == {tuple(r) for r in y.select(x.drop("features").columns).collect()}


def test_folds_need_no_join(spark):
    df = rows(spark)
    t, fold = D.stratified_fold_col(df, label="label", seq="seq", k=5)
    out = t.withColumn("f", fold)
    assert "Join" not in plan(out) and "Exchange" not in plan(out)
    by_class = {}
    for r in out.orderBy("seq").collect():
        by_class.setdefault(r.label, []).append(r.f)
    start = 0
    for c in sorted(by_class):
        got, n = by_class[c], len(by_class[c])
        assert got == sorted(got)  # contiguous blocks
        assert [got.count(i) for i in range(5)] == [sum(p % 5 == i for p in range(start, start + n)) for i in range(5)]
        start += n


def test_parts_follow_rows(spark):
    assert D.parts_for(spark, 0) == 1 and D.parts_for(spark, D.LEAST) == 1
    assert 1 < D.parts_for(spark, 40 * D.LEAST) <= 40
    assert D.parts_for(spark, 10 ** 5 * D.MOST) == 10 ** 5


def test_shapley_is_dealt_by_points(spark, monkeypatch):
    monkeypatch.setattr(X, "POINTS", 100)
    df, base, names = rows(spark, 40).coalesce(1), [0.5, 0.4, 0.3], ["a", "b", "c"]
    m = L.fit_tree(df, max_depth=4, min_leaf=1)
    phi = X.shapley_sampled(m, df, base, id_col="match_id", names=names, permutations=4)
    assert "array_position" not in plan(phi)  # one place per feature, not a search per point
    assert phi.rdd.getNumPartitions() == 7  # 40 rows x 4 x 4 points; by the rows alone it is one
    at = spark.createDataFrame([(base,)], "x array<double>").withColumn("features", array_to_vector("x"))
    f0 = m.transform(at).first()
    fx = {r.match_id: r for r in m.transform(df).collect()}
    for r in phi.groupBy("match_id").agg(F.sum("phi_p0").alias("s"), F.count("*").alias("n")).collect():
        assert r.n == 3 and r.s == pytest.approx(fx[r.match_id].p0 - f0.p0, abs=1e-9)


def test_permuted_copies_are_dealt_by_points(spark, monkeypatch):
    df, names = rows(spark, 60).coalesce(1), ["a", "b", "c"]
    m = L.fit_tree(df, max_depth=4, min_leaf=1)
    whole = X.permutation_importance(m, df, id_col="match_id", names=names, repeats=3).collect()
    monkeypatch.setattr(X, "POINTS", 60)
    dealt = X.permutation_importance(m, df, id_col="match_id", names=names, repeats=3)
    assert "REPARTITION_BY_NUM" in plan(dealt)
    assert whole[0].feature == "a"
    for r, w in zip(dealt.collect(), whole, strict=True):
        assert r.feature == w.feature and r[1:] == pytest.approx(w[1:], abs=1e-9)


@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e7, 1.0), (1e5, 1e-9), (0.0, 0.0), (1e200, 1e190)])
def test_nearest_equal_full_distances(shift, scale):
    draw = np.random.default_rng(3)
    a = shift + scale * np.vstack([draw.normal(size=(40, 5)), draw.integers(0, 2, size=(40, 5))])
    ids = draw.permutation(80)
    far = np.zeros((80, 80))
    with np.errstate(over="ignore"):
        for x in a.T:
            far += np.square(x[:, None] - x[None, :])
        i, j, d = N.nearest_in(a, ids, a, ids, 5)
    far[np.arange(80), np.arange(80)] = np.inf
    want = [(p, q, far[p, q]) for p in range(80) for q in sorted(range(80), key=lambda q: (far[p, q], ids[q]))[:5] if np.isfinite(far[p, q])]
    assert list(zip(i.tolist(), j.tolist(), d.tolist())) == want


def test_fits_leave_nothing_behind(spark):
    from pastline.learners.bagging import oob_curve
    df = rows(spark)
    held, files = spark.sparkContext._jsc.getPersistentRDDs().size(), checkpoints(spark)
    m, kept = L.fit_boost(df, df, rounds=6, depth=2, subsample=0.8)
    assert kept == 6 and L.boost_log_loss(m, df) < 0.9
    assert [r[0] for r in oob_curve(df, id_col="match_id", n_trees=5, report_at=[1, 4], max_depth=3)] == [1, 4]
    t, fold = D.stratified_fold_col(df, label="label", seq="seq", k=3)
    L.fit_stacking(t, fold, [lambda r: L.fit_tree(r, max_depth=3)], k=3)
    L.fit_calibrated_svm(t, fold, k=3, max_iter=3)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held
    assert checkpoints(spark) == files  # rows are read again or stored as Parquet, never checkpointed


def persisted_in_memory(spark):
    return [r for r in spark.sparkContext._jsc.getPersistentRDDs().values() if r.getStorageLevel().useMemory()]


def test_fits_run_together_as_far_as_their_copies_fit(spark, monkeypatch):
    from pastline.learners import parallel as P
    assert P.storage_bytes(spark) > 1 << 20
    monkeypatch.setattr(P, "storage_bytes", lambda s: 10 * 1000 * (8 * 3 + P.ROW_BYTES) / P.ROOM)
    assert [P.fits_at_once(spark, n, 3) for n in (1000, 3000, 10 ** 9)] == [10, 3, 1]
    # fits inside of fits that run together share what there is
    assert P.pmap(lambda _: P.fits_at_once(spark, 1000, 3), range(4), workers=2) == [5] * 4
    assert P.pmap(lambda _: P.pmap(lambda _: P.fits_at_once(spark, 1000, 3), range(2), workers=2)[0], range(5), workers=5) == [1] * 5


@pytest.mark.parametrize("room, want", [(0, {"boost": [1] * 2, "calibrated": [1] * 4, "stacking": [1] * 2}),
                                        (1 << 40, {"boost": [3] * 2, "calibrated": [3] * 4, "stacking": [2, 1]})])
def test_memory_is_left_to_the_solvers(spark, monkeypatch, room, want):
    from pastline.learners import parallel as P
    df, seen, held = rows(spark, 90).drop("x").coalesce(1), [], []

    def seeing(fn, items, workers):
        seen.append(workers)
        held.append(len(persisted_in_memory(spark)))
        return P.pmap(fn, items, 1)

    monkeypatch.setattr(P, "storage_bytes", lambda s: room)
    monkeypatch.setattr(L, "pmap", seeing)
    before = len(persisted_in_memory(spark))
    L.fit_boost(df, df, rounds=2, depth=2)
    assert seen == want["boost"] and max(held) == before  # the frames of a fit take no memory of the executors
    del seen[:], held[:]
    t, fold = D.stratified_fold_col(df, label="label", seq="seq", k=3)
    L.fit_calibrated_svm(t, fold, k=3, max_iter=1)
    assert seen == want["calibrated"] and max(held) == before
    del seen[:]
    t, fold = D.stratified_fold_col(df, label="label", seq="seq", k=2)
    L.fit_stacking(t, fold, [lambda r: L.fit_tree(r, max_depth=3)], k=2)
    assert seen == [min(2, max(1, want["stacking"][0])), 1]


def test_one_vs_rest_is_sparks(spark):
    from pyspark.ml.classification import LinearSVC, OneVsRest
    df = rows(spark)
    t = L.weighted(df, True)
    svc = LinearSVC(featuresCol="features", labelCol="label", weightCol="w", regParam=1.0 / t.agg(F.sum("w")).first()[0], maxIter=20, tol=1e-4, standardization=False)
    want = OneVsRest(classifier=svc, featuresCol="features", labelCol="label", weightCol="w").fit(t)
    got = L.fit_linear_svm(df, max_iter=20).model
    assert [m.coefficients.toArray().tolist() for m in got.models] == [m.coefficients.toArray().tolist() for m in want.models]
    assert [r.prediction for r in got.transform(df).orderBy("match_id").collect()] == [r.prediction for r in want.transform(df).orderBy("match_id").collect()]
