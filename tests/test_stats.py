"""Profiles, ranks, bins, bias corrections, special functions, metrics."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pastline.functions.special import chi2_ppf, signed_rank_upper_tail
from pastline.operators import metrics as M
from pastline.operators import profile as PR
from pastline.operators import stats as ST


def test_chi2_and_wilcoxon_published_values():
    assert chi2_ppf(0.999, 6) == pytest.approx(22.458, abs=1e-3)
    assert signed_rank_upper_tail(153, 17) == pytest.approx(7.63e-06, rel=1e-2)
    assert signed_rank_upper_tail(140, 17) == pytest.approx(6.71e-04, rel=1e-2)


def test_average_ranks_with_ties(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 7.0, 1.0]
    df = spark.createDataFrame([("k", v) for v in vals], "k string, v double")
    got = {r["v"]: r["rank"] for r in ST.average_ranks(df, keys=["k"], value="v", ranges=3).collect()}
    want = pd.Series(vals).rank(method="average")
    for v, rk in zip(vals, want):
        assert got[v] == pytest.approx(rk)


def test_spearman_matches_pandas(spark):
    rnd = random.Random(2)
    rows = [(None if rnd.random() < 0.1 else float(rnd.randint(0, 9)), rnd.gauss(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = ST.spearman_pairs(df, ["a", "b"], ranges=7).first()["rho"]
    want = pd.DataFrame(rows, columns=["a", "b"]).corr(method="spearman").loc["a", "b"]
    assert got == pytest.approx(want, abs=1e-12)


def test_right_closed_bins_exclude_lowest_edge(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (25.0,), (25.1,)], "x double")
    got = [r[0] for r in df.select(PR.right_closed_bin(F.col("x"), [0, 25, 50], ["a", "b"])).collect()]
    assert got == [None, "a", "a", "b"]


def test_describe_bias_corrections(spark):
    rnd = random.Random(4)
    xs = [rnd.expovariate(1.0) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    r = PR.describe_block(df, ["x"], digits=9).first()
    s = pd.Series(xs)
    assert r["skew"] == pytest.approx(s.skew(), abs=1e-8)
    assert r["kurtosis"] == pytest.approx(s.kurtosis(), abs=1e-8)
    assert r["p25"] == pytest.approx(s.quantile(0.25), abs=1e-8)
    assert r["std"] == pytest.approx(s.std(), abs=1e-8)


def test_metrics_from_known_confusion(spark):
    # 3-class example with a hand-computed result
    y = [0, 0, 0, 1, 1, 2, 2, 2, 2, 2]
    p = [0, 1, 0, 1, 2, 2, 2, 0, 2, 1]
    df = spark.createDataFrame(list(zip(y, p)), "label int, pred int")
    s = M.summary(M.confusion_counts(df)).first()
    # per class precision/recall
    prec = [2 / 3, 1 / 3, 3 / 4]
    rec = [2 / 3, 1 / 2, 3 / 5]
    f1 = [2 * a * b / (a + b) for a, b in zip(prec, rec)]
    assert s["accuracy"] == pytest.approx(0.6)
    assert s["f1_macro"] == pytest.approx(sum(f1) / 3)
    pe = (3 * 3 + 2 * 3 + 5 * 4) / 100
    assert s["kappa"] == pytest.approx((0.6 - pe) / (1 - pe))


def test_auc_matches_pairwise_count(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(200):
        a, b = rnd.randint(1, 5), rnd.randint(1, 5)
        c = rnd.randint(1, 5)
        t = a + b + c
        rows.append((rnd.randint(0, 2), a / t, b / t, c / t))
    df = spark.createDataFrame(rows, "label int, p0 double, p1 double, p2 double")
    got = {r["cls"]: r["auc"] for r in M.auc_ovr(df, label="label", p_cols=["p0", "p1", "p2"]).collect()}
    for k in range(3):
        pos = [r[1 + k] for r in rows if r[0] == k]
        neg = [r[1 + k] for r in rows if r[0] != k]
        want = sum((x > y) + 0.5 * (x == y) for x in pos for y in neg) / (len(pos) * len(neg))
        assert got[k] == pytest.approx(want)


def test_mahalanobis_against_numpy(spark):
    from pastline.operators import matrix as MX
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 1]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    out, thr = MX.mahalanobis(df, ["a", "b", "c"])
    got = np.array([r["d2"] for r in out.collect()])
    mu, cov = X.mean(0), np.cov(X, rowvar=False)
    inv = np.linalg.inv(cov + 1e-6 * np.eye(3))
    want = np.einsum("ij,jk,ik->i", X - mu, inv, X - mu)
    assert np.allclose(sorted(got), sorted(want))
    assert thr == pytest.approx(16.266, abs=1e-3)
    assert not math.isnan(thr)


def test_one_far_value_leaves_ranges_even(spark):
    """A value far from all others is one more row of the last range."""
    rows = [("a", float(i % 4000)) for i in range(20_000)] + [("a", 1e18), ("a", -1e18), ("b", 3.0)]
    long = spark.createDataFrame(rows, "k string, v double").repartition(4)
    vp = ST.value_prefix(long, keys=["k"], value="v", ranges=8)
    got = {(r["k"], r["v"]): (r["n"], r["before_n"], r["total_n"]) for r in vp.collect()}
    assert got["a", 1e18] == (1, 20_001, 20_002) and got["a", -1e18] == (1, 0, 20_002) and got["b", 3.0] == (1, 0, 1)
    assert all(got["a", float(v)] == (5, 1 + 5 * v, 20_002) for v in range(4000))
    stored = [f for f in vp.inputFiles() if "value-ranges" in f]
    sizes = [spark.read.parquet(f).count() for f in stored]
    assert sum(sizes) == 4003 and max(sizes) < 4 * 4003 / 8


def test_spearman_ranks_once_per_null_mask(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(400):
        gone, x = rnd.random() < 0.3, rnd.gauss(0, 1)
        a = None if gone else round(x, 1)
        rows.append((a, None if gone else float(rnd.randint(0, 5)), round(x + rnd.gauss(0, 1), 1), float(rnd.randint(0, 3)),
                     None if rnd.random() < 0.2 else float(rnd.randint(0, 9)), None if gone or rnd.random() < 0.2 else x))
    cols = ["a", "a2", "b", "b2", "c", "sub"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    of, covers = ST.null_masks(df, cols)
    assert of["a"] == of["a2"] and of["b"] == of["b2"] and len(set(of.values())) == 4
    assert (of["b"], of["c"]) in covers and (of["a"], of["sub"]) in covers and (of["c"], of["a"]) not in covers
    want = pd.DataFrame(rows, columns=cols, dtype=float).corr(method="spearman")
    for r in ST.spearman_pairs(df, cols, ranges=5).collect():
        assert r["rho"] == pytest.approx(want.loc[r["a"], r["b"]], abs=1e-12)


def test_percentiles_of_data_keys(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y", None]), rnd.choice([None, float("nan"), 1.0, 2.0, rnd.gauss(0, 9)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["value"] for r in ST.exact_percentiles(df, ["v"], [0.0, 0.3, 0.5, 1.0], by=["g"], ranges=3).collect()}
    frame = pd.DataFrame(rows, columns=["g", "v"]).dropna()
    want = {(g, p): v.quantile(p) for g, v in frame.groupby("g")["v"] for p in (0.0, 0.3, 0.5, 1.0)}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_kde_counts_far_values(spark):
    import numpy as np
    xs = [0.0] * 30 + [1.0] * 5 + [40.0, 41.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r["i"]: (r["x"], r["density"]) for r in ST.kde_curve(df, "x", grid=37).collect()}
    bw = np.std(xs, ddof=1) * len(xs) ** -0.2
    assert sorted(got) == list(range(37))
    for x, d in got.values():
        assert d == pytest.approx(np.exp(-0.5 * ((x - np.array(xs)) / bw) ** 2).sum() / (len(xs) * bw * np.sqrt(2 * np.pi)), rel=1e-9, abs=0)
