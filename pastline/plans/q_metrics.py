"""Metric, significance, registry and inference queries over the prediction
table: V5 to V10, V12 to V15, V17, S8, O6, L15, P12, I2, I4, A21, F12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline import presets
from pastline.operators import metrics as M
from pastline.plans.registry import query, r6
from pastline.sources.fixtures import contest, pred
from pastline.sources.scratch import stored

P = ["p0", "p1", "p2"]
LABELS = [0, 1, 2]
CLASS_NAME = {v: k for k, v in presets.OUTCOME_CODE.items()}  # 0 -> A, 1 -> D, 2 -> H

# ------------------------------------------------------------ shared SQL pieces

_SPLIT_SQL = (f"case when year(c.match_date) <= {presets.FIXTURE_TRAIN_END} then 'train' "
              f"when year(c.match_date) between {presets.FIXTURE_VAL_YEARS[0]} and {presets.FIXTURE_VAL_YEARS[1]} "
              f"then 'val' else 'test' end")

_PRED_ROWS = """
, pr as (select *, case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as pred from pred)"""

_MODELS_SQL = f"""
, sp as (select p.*, c.match_date, {_SPLIT_SQL} as split, strftime(c.match_date, '%Y-%m') as month
         from pred p join contest c using (match_id)),
maj as (select label as m from sp where split = 'train' group by label order by count(*) desc, label limit 1),
lp0 as (
  select match_id, split, month, label, 'base' as model, 'single' as family, p0, p1, p2 from sp
  union all
  select match_id, split, month, label, 'sharp', 'single',
         p0 * p0 / (p0 * p0 + p1 * p1 + p2 * p2), p1 * p1 / (p0 * p0 + p1 * p1 + p2 * p2),
         p2 * p2 / (p0 * p0 + p1 * p1 + p2 * p2) from sp
  union all
  select match_id, split, month, label, 'flat', 'single',
         (p0 + 1.0 / 3) / 2, (p1 + 1.0 / 3) / 2, (p2 + 1.0 / 3) / 2 from sp
  union all
  select match_id, split, month, label, 'dummy', 'baseline',
         case when m = 0 then 1.0 else 0.0 end, case when m = 1 then 1.0 else 0.0 end,
         case when m = 2 then 1.0 else 0.0 end from sp cross join maj),
lp as (
  select * from lp0
  union all
  select match_id, split, month, label, 'vote', 'ensemble', avg(p0), avg(p1), avg(p2)
  from lp0 where model in ('base', 'sharp', 'flat') group by match_id, split, month, label),
pr as (select *, case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as pred from lp)"""


def _summary_sql(src: str, by: str, fixed_labels: bool = False) -> str:
    """CTEs cc/pcs/pcf/summ over ``src`` grouped by ``by`` (comma list)."""
    k = "3" if fixed_labels else "count(*)"
    where = "where cls in (0, 1, 2)" if fixed_labels else ""
    return f"""
, cc as (select {by}, label, pred, count(*) as n from {src} group by {by}, label, pred),
pcs as (
  select {by}, cls, sum(tp) as tp, sum(sup) as support, sum(prd) as predicted from (
    select {by}, label as cls, case when label = pred then n else 0 end as tp, n as sup, 0 as prd from cc
    union all
    select {by}, pred, 0, 0, n from cc) x {where}
  group by {by}, cls),
pcf as (
  select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1
  from (select *, coalesce(tp / nullif(predicted, 0), 0) as precision,
               coalesce(tp / nullif(support, 0), 0) as recall from pcs)),
summ as (
  select {by}, sum(precision) / {k} as macro_precision, sum(recall) / {k} as macro_recall,
         sum(f1) / {k} as f1_macro, sum(precision * support) / sum(support) as weighted_precision,
         sum(recall * support) / sum(support) as weighted_recall, sum(f1 * support) / sum(support) as weighted_f1,
         sum(support) as n, sum(tp) / sum(support) as accuracy,
         sum(support * predicted) / (sum(support) * sum(support)) as pe
  from pcf group by {by})"""


def _auc_sql(src: str, by: str) -> str:
    parts = "\n    union all\n    ".join(
        f"select {by}, {i} as cls, p{i} as s, case when label = {i} then 1 else 0 end as pos, "
        f"case when label <> {i} then 1 else 0 end as neg from {src}" for i in LABELS)
    return f"""
, sc as ({parts}),
v as (select {by}, cls, s, sum(pos) as pos, sum(neg) as neg from sc group by {by}, cls, s),
cv as (select *, coalesce(sum(neg) over (partition by {by}, cls order by s
                                         rows between unbounded preceding and 1 preceding), 0) as nb from v),
auc as (select {by}, cls, sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from cv group by {by}, cls)"""


# ------------------------------------------------------------ Spark side

def scored(spark, sf_dir) -> DataFrame:
    """pred rows with split and month (one equi join on the contest id)."""
    c = contest(spark, sf_dir).select("match_id", "match_date")
    p = pred(spark, sf_dir)
    y = F.year("match_date")
    split = (F.when(y <= presets.FIXTURE_TRAIN_END, "train")
             .when((y >= presets.FIXTURE_VAL_YEARS[0]) & (y <= presets.FIXTURE_VAL_YEARS[1]), "val")
             .otherwise("test"))
    return p.join(c, "match_id").select(*p.columns, split.alias("split"),
                                        F.date_format("match_date", "yyyy-MM").alias("month"))


def model_predictions(spark, sf_dir) -> DataFrame:
    """Long prediction table of four derived models and their soft vote."""
    sp = scored(spark, sf_dir)
    key = ["match_id", "split", "month", "label"]
    sq = F.col("p0") * F.col("p0") + F.col("p1") * F.col("p1") + F.col("p2") * F.col("p2")
    maj = (sp.where(F.col("split") == "train").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
           .agg(F.max_by("label", F.struct("n", -F.col("label")))).first()[0])  # one scalar: the train majority class
    base = [F.col(c) for c in P]
    sharp = [F.col(c) * F.col(c) / sq for c in P]
    flat = [(F.col(c) + F.lit(1.0) / 3) / 2 for c in P]
    models = [("base", "single", base), ("sharp", "single", sharp), ("flat", "single", flat),
              ("dummy", "baseline", [F.lit(1.0 if i == maj else 0.0) for i in range(len(P))]),
              ("vote", "ensemble", [(b + h + f) / 3 for b, h, f in zip(base, sharp, flat)])]
    rows = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(fam).alias("family"),
                              *[p.alias(c) for c, p in zip(P, probs)]) for n, fam, probs in models])
    return sp.select(*key, F.explode(rows).alias("m")).select(*key, "m.*").withColumn("pred", M.argmax_class(P))


def pred_rows(spark, sf_dir):
    return pred(spark, sf_dir).withColumn("pred", M.argmax_class(P))


# ------------------------------------------------------------ V5 to V10

@query("confusion", "V9", sql=_PRED_ROWS + """
, cc as (select label, pred, count(*) as n from pr group by label, pred)
select label, """ + ", ".join(f"cast(sum(case when pred = {p} then n else 0 end) as bigint) as n_{p}" for p in LABELS) + ", "
       + ", ".join(f"round(sum(case when pred = {p} then n else 0 end) / sum(n), 6) as r_{p}" for p in LABELS)
       + " from cc group by label")
def confusion(spark, sf_dir):
    return M.confusion_matrix(M.confusion_counts(pred_rows(spark, sf_dir)), LABELS)


@query("prf_report", "V5", sql=_PRED_ROWS + _summary_sql("(select 1 as one, * from pr)", "one") + """
select cls, cast(tp as bigint) as tp, cast(support as bigint) as support, cast(predicted as bigint) as predicted,
       round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1, 6) as f1 from pcf""")
def prf_report(spark, sf_dir):
    pc = M.per_class(M.confusion_counts(pred_rows(spark, sf_dir)))
    return pc.select(F.col("cls"), F.col("tp").cast("bigint"), F.col("support").cast("bigint"),
                     F.col("predicted").cast("bigint"), r6("precision"), r6("recall"), r6("f1"))


@query("kappa", "V5 V6", sql=_PRED_ROWS + _summary_sql("(select 1 as one, * from pr)", "one") + """
select round(accuracy, 6) as accuracy, round(f1_macro, 6) as f1_macro, round(weighted_f1, 6) as weighted_f1,
       round(macro_precision, 6) as macro_precision, round(macro_recall, 6) as macro_recall,
       round((accuracy - pe) / (1 - pe), 6) as kappa from summ""")
def kappa(spark, sf_dir):
    s = M.summary(M.confusion_counts(pred_rows(spark, sf_dir)))
    return s.select(*[r6(c) for c in ("accuracy", "f1_macro", "weighted_f1", "macro_precision",
                                      "macro_recall", "kappa")])


@query("log_loss", "V8 T12", sql="""
select round(avg(-ln(least(greatest(case label when 0 then p0 when 1 then p1 else p2 end, 2.220446049250313e-16),
                             1 - 2.220446049250313e-16))), 6) as log_loss from pred""")
def log_loss(spark, sf_dir):
    return M.log_loss(pred(spark, sf_dir), label="label", p_cols=P).select(r6("log_loss"))


@query("auc_ovr", "V7 W8", sql=_auc_sql("(select 1 as one, * from pred)", "one") + """
select cls, round(auc, 6) as auc from auc""")
def auc_ovr(spark, sf_dir):
    return M.auc_ovr(pred(spark, sf_dir), label="label", p_cols=P).select("cls", r6("auc"))


@query("roc_points", "V10", sql="""
, sc as (""" + "\n union all ".join(
    f"select {i} as cls, p{i} as s, case when label = {i} then 1 else 0 end as pos, "
    f"case when label <> {i} then 1 else 0 end as neg from pred" for i in LABELS) + """),
v as (select cls, s, sum(pos) as pos, sum(neg) as neg from sc group by cls, s)
select cls, round(s, 6) as threshold,
       round(sum(neg) over (partition by cls order by s desc rows between unbounded preceding and current row)
             / sum(neg) over (partition by cls), 6) as fpr,
       round(sum(pos) over (partition by cls order by s desc rows between unbounded preceding and current row)
             / sum(pos) over (partition by cls), 6) as tpr
from v""")
def roc_points(spark, sf_dir):
    r = M.roc_points(pred(spark, sf_dir), label="label", p_cols=P)
    return r.select("cls", r6("threshold"), r6("fpr"), r6("tpr"))


# ------------------------------------------------------------ V12 to V17, S8, O6

_TABLE_SQL = _MODELS_SQL + _summary_sql("pr", "model, family, split") + _auc_sql("pr", "model, family, split") + """
, ll as (select model, family, split,
                avg(-ln(least(greatest(case label when 0 then p0 when 1 then p1 else p2 end, 2.220446049250313e-16),
                              1 - 2.220446049250313e-16))) as log_loss
         from pr group by model, family, split),
am as (select model, family, split, avg(auc) as roc_auc from auc group by model, family, split),
f1c as (select model, family, split,
               max(case when cls = 2 then f1 end) as f1_H, max(case when cls = 1 then f1 end) as f1_D,
               max(case when cls = 0 then f1 end) as f1_A, max(case when cls = 1 then recall end) as recall_D
        from pcf group by model, family, split),
tbl as (
  select t.model, t.family, v.f1_macro as val_f1_macro, t.f1_macro as test_f1_macro, t.accuracy as test_acc,
         coalesce(f.f1_H, 0) as test_f1_H, coalesce(f.f1_D, 0) as test_f1_D, coalesce(f.f1_A, 0) as test_f1_A,
         coalesce(f.recall_D, 0) as test_recall_D, (t.accuracy - t.pe) / (1 - t.pe) as test_kappa,
         a.roc_auc as test_roc_auc, l.log_loss as test_logloss
  from summ t
  left join summ v on v.model = t.model and v.split = 'val'
  join f1c f on f.model = t.model and f.split = 'test'
  join am a on a.model = t.model and a.split = 'test'
  join ll l on l.model = t.model and l.split = 'test'
  where t.split = 'test')"""

_TABLE_COLS = ["val_f1_macro", "test_f1_macro", "test_acc", "test_f1_H", "test_f1_D", "test_f1_A",
               "test_recall_D", "test_kappa", "test_roc_auc", "test_logloss"]


def model_table_df(spark, sf_dir) -> DataFrame:
    # read by five aggregates below: computed once
    return model_table_of(stored(model_predictions(spark, sf_dir).where(F.col("split").isin("val", "test")), "predictions"))


def model_table_of(lp: DataFrame) -> DataFrame:
    """V12 + V17 + J5 from a long prediction table (val and test rows of any models)."""
    by = ["model", "family", "split"]
    counts = M.confusion_counts(lp, by=by)
    summ = M.summary(counts, by=by)
    pc = M.per_class(counts, by=by).groupBy(*by).agg(
        *[F.max(F.when(F.col("cls") == code, F.col("f1"))).alias(f"f1_{name}") for name, code in
          presets.OUTCOME_CODE.items()],
        F.max(F.when(F.col("cls") == presets.OUTCOME_CODE["D"], F.col("recall"))).alias("recall_D"))
    auc = M.auc_macro(M.auc_ovr(lp, label="label", p_cols=P, by=by), by=by)
    ll = M.log_loss(lp, label="label", p_cols=P, by=by)
    test = (summ.where(F.col("split") == "test").join(pc, by).join(auc, by).join(ll, by)
            .select("model", "family", F.col("f1_macro").alias("test_f1_macro"), F.col("accuracy").alias("test_acc"),
                    *[F.coalesce(F.col(f"f1_{n}"), F.lit(0.0)).alias(f"test_f1_{n}") for n in ("H", "D", "A")],
                    F.coalesce(F.col("recall_D"), F.lit(0.0)).alias("test_recall_D"),
                    F.col("kappa").alias("test_kappa"), F.col("roc_auc").alias("test_roc_auc"),
                    F.col("log_loss").alias("test_logloss")))
    val = summ.where(F.col("split") == "val").select("model", F.col("f1_macro").alias("val_f1_macro"))
    return test.join(val, "model", "left")  # J5: validation score looked up by model name, absent ones null


@query("model_table", "V12 V17 J5", sql=_TABLE_SQL + "\nselect model, family, "
       + ", ".join(f"round({c}, 6) as {c}" for c in _TABLE_COLS) + " from tbl")
def model_table(spark, sf_dir):
    t = model_table_df(spark, sf_dir)
    return t.select("model", "family", *[r6(c) for c in _TABLE_COLS]).orderBy(F.desc("test_f1_macro"))


@query("registry_upsert", "S8", sql=_TABLE_SQL + """
select model, family, case when model = 'dummy' then 1 else 2 end as batch,
       round(test_f1_macro, 6) as test_f1_macro, round(test_acc, 6) as test_acc from tbl""")
def registry_upsert(spark, sf_dir):
    """Two registrations; the second replaces the row of the model in both."""
    t = stored(model_table_df(spark, sf_dir), "model-table")
    early = t.where(F.col("model").isin("base", "dummy")).withColumn("batch", F.lit(1)).withColumn(
        "test_acc", F.when(F.col("model") == "dummy", F.col("test_acc")))
    late = t.where(F.col("model") != "dummy").withColumn("batch", F.lit(2))
    reg = M.register(M.register(None, early), late)
    return reg.select("model", "family", "batch", r6("test_f1_macro"), r6("test_acc"))


@query("proposed_model", "V13 O6", sql=_TABLE_SQL + """
, pool as (select * from tbl where family = 'ensemble' or not exists (select 1 from tbl where family = 'ensemble'))
select model, family, round(coalesce(val_f1_macro, test_f1_macro), 6) as score
from pool order by coalesce(val_f1_macro, test_f1_macro) desc, model limit 1""")
def proposed_model(spark, sf_dir):
    p = M.proposed(model_table_df(spark, sf_dir))
    return p.select("model", "family", r6(F.coalesce("val_f1_macro", "test_f1_macro"), "score"))


@query("monthly_f1", "V14 T13", sql=_MODELS_SQL + _summary_sql(
    "(select * from pr where split = 'test')", "model, month", fixed_labels=True) + """
select model, month as block, cast(n as bigint) as n, round(f1_macro, 6) as f1_macro from summ where n >= 50""")
def monthly_f1(spark, sf_dir):
    lp = model_predictions(spark, sf_dir).where(F.col("split") == "test")
    b = M.block_f1(lp, block=F.col("month"), labels=LABELS, by=["model"], min_rows=50)
    return b.select("model", "block", "n", r6("f1_macro"))


@query("wilcoxon", "V15")
def wilcoxon(spark, sf_dir):
    lp = model_predictions(spark, sf_dir).where(F.col("split") == "test")
    blocks = M.block_f1(lp, block=F.col("month"), labels=LABELS, by=["model"], min_rows=50)
    rows = [M.wilcoxon_greater(blocks, model_col="model", model="vote", baseline=b) for b in ("dummy", "base")]
    return spark.createDataFrame(rows, "model string, baseline string, n_blocks long, W double, "
                                       "p_value double, mean_diff double")


# ------------------------------------------------------------ L15, P12, I2, I4, A21

@query("soft_vote", "L15", sql=_MODELS_SQL + """
select match_id, round(p0, 6) as p0, round(p1, 6) as p1, round(p2, 6) as p2, pred from pr where model = 'vote'""")
def soft_vote(spark, sf_dir):
    lp = model_predictions(spark, sf_dir).where(F.col("model") != "vote")
    v = M.soft_vote(lp, id_col="match_id", models=["base", "sharp", "flat"], p_cols=P)
    return v.select("match_id", *[r6(c) for c in P], "pred")


@query("hit_rate", "I4 A21", sql=_MODELS_SQL + """
select model, count(*) filter (where pred = label) as hits, count(label) as known,
       round(count(*) filter (where pred = label) / count(label), 6) as hit_rate
from pr where split = 'test' group by model""")
def hit_rate(spark, sf_dir):
    lp = model_predictions(spark, sf_dir).where(F.col("split") == "test")
    return lp.groupBy("model").agg(
        F.count_if(F.col("pred") == F.col("label")).alias("hits"), F.count("label").alias("known")).withColumn(
        "hit_rate", F.round(F.col("hits") / F.col("known"), 6))


@query("label_codes", "F12", sql="""
select match_id, label,
       case label when 2 then 'H' when 1 then 'D' when 0 then 'A' end as outcome
from pred""")
def label_codes(spark, sf_dir):
    code_to_name = F.create_map(*[F.lit(x) for k, v in presets.OUTCOME_CODE.items() for x in (v, k)])
    return pred(spark, sf_dir).select("match_id", "label", F.element_at(code_to_name, F.col("label")).alias("outcome"))
