"""Learner, validation, sampling, attribution and scoring queries:
L1 to L13, L16, V1 to V4, V11, V16, M10, M12, M13, X1, X2, I1, I3, S5, S7, S9."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.functions.names import plain_feature
from pastline.learners import data as D
from pastline.learners import models as L
from pastline.learners import search as V
from pastline.operators import explain as X
from pastline.operators import history as H
from pastline.plans import stages as S
from pastline.plans.q_metrics import _summary_sql
from pastline.plans.registry import query, r6

_MEMO: dict = {}


def learn_data(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], int]:
    """Design matrix + label code + dense chronological ``seq`` + feature
    vector, stored once; returns (frame, feature names, n_train)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        p, f = S.prepared(spark, sf_dir), S.features(spark, sf_dir)
        names = p.feature_names()
        # one exchange, of the raw features; the vector is stored with the rows in order, and every pass reads what it needs
        ready = lambda rows: D.assemble(S.labeled_design(spark, sf_dir, rows, ["_at"]), names)
        x = H.dense_order(f, time="match_date", tie="match_id", out="seq", buckets=D.parts_for(spark, f.count()), then=ready)
        n_train = x.where(F.col("split") == "train").count()
        _MEMO[key] = (x, names, n_train)
    return _MEMO[key]


def learn_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The rows of :func:`learn_data` without ``seq``, computed from the stored
    features as they are read: for the few passes of a closed form or a linear
    fit, which ask for no order, nothing is exchanged or stored again."""
    names = S.prepared(spark, sf_dir).feature_names()
    return D.assemble(S.labeled_design(spark, sf_dir, S.features(spark, sf_dir)), names), names


def _split(x: DataFrame, s: str) -> DataFrame:
    return x.where(F.col("split") == s)


def _row(spark, name: str, m: dict, **extra) -> DataFrame:
    d = {"model": name, **{k: float(v) for k, v in m.items()}, **{k: str(v) for k, v in extra.items()}}
    cols = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in d.items())
    return spark.createDataFrame([tuple(d.values())], cols)


def _fit_eval(spark, sf_dir, name, fit, **extra):
    x, names, _ = learn_data(spark, sf_dir)
    model = fit(_split(x, "train"))
    return _row(spark, name, V.evaluate(model, _split(x, "val")), **extra)


_LABELED = S.prepare_sql() + """
, tl as (select match_id, split, match_date,
                case outcome when 'A' then 0 when 'D' then 1 when 'H' then 2 end as label from imp)"""


# ------------------------------------------------------------------ L1, M10, V1, L2

@query("majority", "L1 V5", sql=_LABELED + """
, mj as (select label as m from tl where split = 'train' group by label order by count(*) desc, label limit 1),
v as (select 1 as one, label, (select m from mj) as pred from tl where split = 'val')""" + _summary_sql("v", "one") + """
select round(f1_macro, 6) as f1_macro, round(accuracy, 6) as accuracy, cast(n as bigint) as n from summ""")
def majority(spark, sf_dir):
    x, _, _ = learn_data(spark, sf_dir)
    m = L.fit_majority(_split(x, "train"))
    from pastline.operators import metrics as M
    scored = m.transform(_split(x, "val")).select(F.col(D.LABEL).cast("int").alias("label"), "pred")
    s = M.summary(M.confusion_counts(scored))
    return s.select(r6("f1_macro"), r6("accuracy"), F.col("n").cast("bigint"))


@query("class_weights", "M10", sql=_LABELED + """
select label, count(*) as n,
       round((select count(*) from tl where split = 'train') / (3.0 * count(*)), 6) as weight
from tl where split = 'train' group by label""")
def class_weights(spark, sf_dir):
    x, _, _ = learn_data(spark, sf_dir)
    tr = _split(x, "train")
    counts = D.class_counts(tr)
    w = D.balanced_weights(counts)
    rows = [(int(c), int(counts[c]), round(w[c], 6)) for c in counts]
    return spark.createDataFrame(rows, "label int, n long, weight double")


@query("fold_assignment", "V1", sql=_LABELED + """
, t as (select match_id, row_number() over (order by match_date, match_id) - 1 as seq from tl where split = 'train'),
nn as (select count(*) as n, count(*) // 6 as size from t),
f as (select i as fold, n - (5 - i) * size as a, n - (5 - i) * size + size as b from nn, range(5) r(i))
select t.match_id, f.fold, case when t.seq < f.a then 'train' else 'test' end as role
from t join f on t.seq < f.b""")
def fold_assignment(spark, sf_dir):
    x, _, n = learn_data(spark, sf_dir)
    tr = _split(x, "train").select("match_id", "seq")
    # the fold bounds are five literals: each row explodes into the folds it takes part in
    folds = F.array(*[F.struct(F.lit(i).cast("bigint").alias("fold"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                      for i, a, b in D.expanding_folds(n, 5)])
    j = tr.select("match_id", "seq", F.explode(F.filter(folds, lambda f: F.col("seq") < f["b"])).alias("f"))
    return j.select("match_id", "f.fold", F.when(F.col("seq") < F.col("f.a"), "train").otherwise("test").alias("role"))


_NUM = [f"num__{c}" for c in S.CONTINUOUS]
_NUM_SQL = ", ".join(
    f"(imp.{c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end as num__{c}" for c in S.CONTINUOUS)


@query("nb_params", "L2", sql=S.prepare_sql() + f"""
, x as (select case outcome when 'A' then 0 when 'D' then 1 when 'H' then 2 end as label, {_NUM_SQL}
        from imp cross join sc where split = 'train')
""" + "\nunion all\n".join(
    f"select label, '{c}' as feature, count(*) as n, round(avg({c}), 6) as mean, round(var_pop({c}), 6) as var "
    f"from x group by label" for c in _NUM))
def nb_params(spark, sf_dir):
    x, _, _ = learn_data(spark, sf_dir)
    st = L.nb_stats(_split(x, "train"), _NUM).collect()
    rows = [(int(r[D.LABEL]), c, int(r["n"]), round(float(r[f"m_{c}"]), 6), round(float(r[f"v_{c}"]), 6))
            for r in st for c in _NUM]
    return spark.createDataFrame(rows, "label int, feature string, n long, mean double, var double")


@query("nb_scores", "L2 V11")
def nb_scores(spark, sf_dir):
    x, names, _ = learn_data(spark, sf_dir)
    return _fit_eval(spark, sf_dir, "gaussian_nb", lambda t: L.fit_gaussian_nb(t, names, 1e-9))


# ------------------------------------------------------------------ L3 to L13, L16

@query("logreg", "L3 V11")
def logreg(spark, sf_dir):
    return _fit_eval(spark, sf_dir, "logreg", lambda t: L.fit_logreg(t, C=0.1))


@query("tree", "L4")
def tree(spark, sf_dir):
    return _fit_eval(spark, sf_dir, "tree", lambda t: L.fit_tree(t, max_depth=5, min_leaf=50))


@query("forest", "L5")
def forest(spark, sf_dir):
    return _fit_eval(spark, sf_dir, "forest", lambda t: L.fit_forest(t, n_trees=40, max_depth=8, min_leaf=20))


@query("forest_oob", "L6")
def forest_oob(spark, sf_dir):
    from pastline.learners.bagging import oob_curve
    x, _, _ = learn_data(spark, sf_dir)
    rows = oob_curve(_split(x, "train"), id_col="match_id", n_trees=12, report_at=[4, 8, 12],
                     max_depth=8, min_leaf=20)
    return spark.createDataFrame(rows, "n_trees long, oob_error double, rows_scored long")


@query("samme", "L7")
def samme(spark, sf_dir):
    return _fit_eval(spark, sf_dir, "samme", lambda t: L.fit_samme(t, rounds=8, rate=0.5))


@query("rff_svm", "L8")
def rff_svm(spark, sf_dir):
    x, names, _ = learn_data(spark, sf_dir)
    return _fit_eval(spark, sf_dir, "rff", lambda t: L.fit_rff_svm(t, d=len(names), gamma=0.05, n_features=100))


@query("linear_svm", "L9")
def linear_svm(spark, sf_dir):
    return _fit_eval(spark, sf_dir, "linear_svm", lambda t: L.fit_linear_svm(t, C=0.1))


@query("calibrated", "L9 L10")
def calibrated(spark, sf_dir):
    def fit(t):
        t2, fold = D.stratified_fold_col(t, label=D.LABEL, seq="seq", k=3)
        return L.fit_calibrated_svm(t2.withColumn("_cf", fold), F.col("_cf"), k=3, C=0.1)
    return _fit_eval(spark, sf_dir, "calibrated_svm", fit)


def _boost_query(preset: str):
    def q(spark, sf_dir):
        x, _, _ = learn_data(spark, sf_dir)
        kw = L.BOOST_PRESETS[preset]
        m, kept = L.fit_boost(_split(x, "train"), _split(x, "val"), rounds=12, early_stop=5, **kw)
        return _row(spark, f"boost_{preset}", V.evaluate(m, _split(x, "val")), rounds_kept=kept)
    return q


for _p, _ops in (("depthwise", "L11"), ("leafwise", "L12"), ("ordered", "L13")):
    query(f"softmax_boost_{_p}", f"{_ops} T19 T20")(_boost_query(_p))


@query("stacking", "L16")
def stacking(spark, sf_dir):
    x, names, _ = learn_data(spark, sf_dir)
    bases = [lambda t: L.fit_logreg(t, C=0.1), lambda t: L.fit_tree(t, max_depth=5, min_leaf=50),
             lambda t: L.fit_gaussian_nb(t, names)]

    def fit(t):
        t2, fold = D.stratified_fold_col(t, label=D.LABEL, seq="seq", k=5)
        return L.fit_stacking(t2, fold, bases, k=5)
    return _fit_eval(spark, sf_dir, "stacking", fit)


# ------------------------------------------------------------------ V2 to V4, V16

@query("validation_curve", "V1 V2")
def validation_curve(spark, sf_dir):
    x, _, n = learn_data(spark, sf_dir)
    rows = V.validation_curve(lambda t, v: L.fit_tree(t, max_depth=v, min_leaf=50), [2, 4, 6],
                              _split(x, "train"), seq="seq", n=n, k=3)
    best = V.best_of(rows)["value"]
    return spark.createDataFrame([(r["value"], r["train_mean"], r["fold_mean"], r["fold_std"], r["value"] == best)
                                  for r in rows], "value string, train_mean double, fold_mean double, "
                                                  "fold_std double, best boolean")


@query("grid_search", "V3")
def grid_search(spark, sf_dir):
    x, _, n = learn_data(spark, sf_dir)
    cands = V.grid({"max_depth": [3, 5], "min_leaf": [20, 100]})
    best, rows = V.search(lambda t, **kw: L.fit_tree(t, **kw), cands, _split(x, "train"), seq="seq", n=n, k=3)
    refit = L.fit_tree(_split(x, "train"), **best)  # refit on all train rows
    m = V.evaluate(refit, _split(x, "val"))
    return _row(spark, "tree_grid", m, best=best)


@query("random_search", "V4")
def random_search(spark, sf_dir):
    x, _, n = learn_data(spark, sf_dir)
    space = {"n_trees": [10, 20], "max_depth": ("randint", 3, 9), "features": ["sqrt", "log2", "0.3"]}
    cands = V.random_draws(space, 3, seed=42)
    best, rows = V.search(lambda t, **kw: L.fit_forest(t, min_leaf=20, **kw), cands, _split(x, "train"),
                          seq="seq", n=n, k=3)
    m = V.evaluate(L.fit_forest(_split(x, "train"), min_leaf=20, **best), _split(x, "val"))
    return _row(spark, "forest_random", m, best=best)


@query("leak_probe", "V16 L1 L3")
def leak_probe(spark, sf_dir):
    x, _, _ = learn_data(spark, sf_dir)
    tr, va = _split(x, "train"), _split(x, "val")
    res = {"majority": V.evaluate(L.fit_majority(tr), va), "logreg": V.evaluate(L.fit_logreg(tr, C=0.1), va)}
    rows = V.leak_probe(res)
    return spark.createDataFrame([(r["model"], r["accuracy"], r["f1_macro"], r["suspicious"]) for r in rows],
                                 "model string, accuracy double, f1_macro double, suspicious boolean")


# ------------------------------------------------------------------ M12, M13

@query("stratified_sample", "M12")
def stratified_sample(spark, sf_dir):
    x, _, _ = learn_data(spark, sf_dir)
    s = D.stratified_sample(_split(x, "train"), 500, key="match_id", seed=42)
    return s.groupBy(D.LABEL).agg(F.count(F.lit(1)).alias("n"))


@query("uniform_sample", "M13")
def uniform_sample(spark, sf_dir):
    x, _, _ = learn_data(spark, sf_dir)
    return D.uniform_sample(_split(x, "train"), 600, key="match_id", seed=42).select("match_id", "seq", D.LABEL)


# ------------------------------------------------------------------ X1, X2

@query("permutation_importance", "X1 F14")
def permutation_importance(spark, sf_dir):
    x, names, _ = learn_data(spark, sf_dir)
    m = L.fit_forest(_split(x, "train"), n_trees=20, max_depth=6, min_leaf=20)
    top = X.permutation_importance(m, _split(x, "val"), id_col="match_id", names=names, repeats=5).limit(15)
    return top.withColumn("feature", plain_feature("feature"))


def _baseline(x, names):
    tr = _split(x, "train").select(vector_to_array(D.FEATURES).alias("a"))
    r = tr.agg(*[F.avg(F.col("a")[i]).alias(f"m{i}") for i in range(len(names))]).first()
    return [float(r[f"m{i}"]) for i in range(len(names))]


@query("shapley_sampled", "X2")
def shapley_sampled(spark, sf_dir):
    x, names, _ = learn_data(spark, sf_dir)
    m = L.fit_tree(_split(x, "train"), max_depth=5, min_leaf=50)
    phi = X.shapley_sampled(m, _split(x, "val"), _baseline(x, names), id_col="match_id", names=names, permutations=6)
    return X.shapley_summary(phi, top=15)


@query("shapley_linear", "X2")
def shapley_linear(spark, sf_dir):
    x, names = learn_rows(spark, sf_dir)
    m = L.fit_logreg(_split(x, "train"), C=0.1)
    coef = m.model.coefficientMatrix.toArray().tolist()
    phi = X.shapley_linear(coef, _baseline(x, names), _split(x, "val"), id_col="match_id", names=names)
    return X.shapley_summary(phi, top=15)


# ------------------------------------------------------------------ I1, S5, S7, S9

@query("batch_score", "I1 S5 S7 S9")
def batch_score(spark, sf_dir):
    """Fit and store a model, then score the raw test rows from what the
    stores hold alone: the preparation state read back as a table and the
    model loaded by name."""
    from pastline.learners import store as ST
    from pastline.operators import prepare_table as PT
    x, _, _ = learn_data(spark, sf_dir)
    root = ST.store_root(spark, "batch-models")
    ST.save(spark, L.fit_logreg(_split(x, "train"), C=0.1), root, "logreg")
    state, back = S.stored_preparation(spark, sf_dir), ST.load(spark, root, "logreg")
    rows = S.features(spark, sf_dir).where(F.col("split") == "test")
    ready = PT.assemble(PT.transform(rows, state, S.preparer(), keep=["match_id"]), state)
    return back.transform(ready).select("match_id", *[r6(p) for p in L.prob_cols(back.k)], "pred")
