"""Profiling queries: A1 to A14, A19, A20, F5, F9 to F11, F13, O3 to O5, P3, P4, P9,
P10, ST1 to ST15, J9, W8, M7, M9."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pastline import presets
from pastline.operators import contract as P
from pastline.operators import matrix as MX
from pastline.operators import profile as PR
from pastline.operators import stats as ST
from pastline.plans import stages as S
from pastline.plans.registry import query, r6
from pastline.sources.fixtures import CONTEST_COLUMNS, contest
from pastline.sources.tables import read_table

FEATS = ["home_rating", "away_rating", "form_home", "form_away", "rating_diff", "form_diff"]
DESCRIBE = FEATS + ["home_score", "away_score"]
MAHA = ["home_rating", "away_rating", "form_home", "form_away"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Spark type names of the contest view (schema metadata for the oracle text)
CONTEST_TYPES = {"match_id": "bigint", "division": "string", "match_date": "timestamp_ntz", "home": "int",
                 "away": "int", "home_score": "bigint", "away_score": "bigint", "home_rating": "double",
                 "away_rating": "double", "form_home": "double", "form_away": "double"}

ABS_EDGES = [0, 500, 1000, 2500, 5000, 100000]
ABS_LABELS = ["0-500", "500-1000", "1000-2500", "2500-5000", ">5000"]
SIGNED_EDGES = [-100000, -5000, -2500, -1000, -500, 0, 500, 1000, 2500, 5000, 100000]
FORM_EDGES = [-0.1, 0.5, 2, 4, 6, 30]
FORM_LABELS = ["0", "1-2", "3-4", "5-6", ">6"]

CX_SQL = """
, cx as (
  select *, home_rating - away_rating as rating_diff, form_home - form_away as form_diff,
         case when home_score > away_score then 'H' when home_score < away_score then 'A'
              when home_score = away_score then 'D' end as outcome
  from contest)"""


def cx(spark, sf_dir):
    c = contest(spark, sf_dir)
    return c.withColumns({**P.differences({"rating_diff": ("home_rating", "away_rating"),
                                           "form_diff": ("form_home", "form_away")}),
                          "outcome": P.outcome_from_scores("home_score", "away_score")})


def _union(parts):
    return "\nunion all\n".join(parts)


# ---------------------------------------------------------------- A1 to A4

@query("column_profile", "A1", sql=CX_SQL + "\n" + _union([
    f"select '{c}' as column_name, '{t}' as dtype, count(*) as n_rows, "
    f"round(100.0 * count({c}) / count(*), 6) as non_null_pct, count(distinct {c}) as n_distinct from contest"
    for c, t in CONTEST_TYPES.items()]))
def column_profile(spark, sf_dir):
    return PR.column_profile(contest(spark, sf_dir), CONTEST_COLUMNS)


@query("first_rows", "O5", sql="""
select match_id, division, match_date, home, away, home_score, away_score, round(home_rating, 6) as home_rating
from contest order by match_date, match_id limit 5""")
def first_rows(spark, sf_dir):
    """The first rows in chronological order (top-k per task, then over the tasks)."""
    return contest(spark, sf_dir).orderBy("match_date", "match_id").limit(5).select(
        "match_id", "division", "match_date", "home", "away", "home_score", "away_score", r6("home_rating"))


@query("null_rate_by_year", "A5", sql="""
select year(match_date) as year, count(*) as n_rows,
       round(100.0 * (count(*) - count(home_rating)) / count(*), 6) as home_null_pct,
       round(100.0 * (count(*) - count(away_rating)) / count(*), 6) as away_null_pct
from contest group by year(match_date)""")
def null_rate_by_year(spark, sf_dir):
    """A5: share of missing ratings per calendar year."""
    g = contest(spark, sf_dir).groupBy(F.year("match_date").alias("year"))
    return PR.null_rates(g, ["home_rating", "away_rating"], ["home_null_pct", "away_null_pct"]).orderBy("year")


@query("null_profile", "A3 O3", sql=_union([
    f"select '{c}' as column_name, count(*) - count({c}) as null_count, "
    f"round(100.0 * (count(*) - count({c})) / count(*), 6) as null_pct from contest" for c in CONTEST_COLUMNS]))
def null_profile(spark, sf_dir):
    return PR.null_profile(contest(spark, sf_dir), CONTEST_COLUMNS)


@query("null_buckets", "A4", sql="select * from (select *, case when null_pct > 50 then '>50' "
       "when null_pct > 20 and null_pct <= 50 then '20-50' when null_pct < 5 then '<5' end as bucket from ("
       + _union([f"select '{c}' as column_name, count(*) - count({c}) as null_count, "
                 f"round(100.0 * (count(*) - count({c})) / count(*), 6) as null_pct from contest"
                 for c in CONTEST_COLUMNS]) + ")) where bucket is not null")
def null_buckets(spark, sf_dir):
    return PR.null_buckets(PR.null_profile(contest(spark, sf_dir), CONTEST_COLUMNS))


@query("null_totals", "A3 A6", sql=f"""
select cast(sum({" + ".join(f"case when {c} is null then 1 else 0 end" for c in CONTEST_COLUMNS)}) as bigint) as null_cells,
       count(*) * {len(CONTEST_COLUMNS)} as cells,
       round(100.0 * sum({" + ".join(f"case when {c} is null then 1 else 0 end" for c in CONTEST_COLUMNS)})
             / (count(*) * {len(CONTEST_COLUMNS)}), 6) as null_cells_pct
from contest""")
def null_totals(spark, sf_dir):
    return PR.null_totals(contest(spark, sf_dir), CONTEST_COLUMNS).select(
        F.col("null_cells").cast("bigint").alias("null_cells"), F.col("cells").cast("bigint").alias("cells"),
        "null_cells_pct")


@query("table_shape", "A2 O5", sql=f"""
select count(*) as n_rows, min(match_date) as first_time, max(match_date) as last_time,
       count(distinct division) as n_groups,
       (select count(*) from (select home from contest union select away from contest)) as n_entities,
       {len(CONTEST_COLUMNS)} as n_columns
from contest""")
def table_shape(spark, sf_dir):
    return PR.table_shape(contest(spark, sf_dir), time="match_date", group="division", entities=["home", "away"])


# ---------------------------------------------------------------- P3, P4

_TAX_VALUES = ", ".join(f"('{c}', '{g}')" for c, g in presets.FIXTURE_TAXONOMY.items())
_NULL_PCT_SQL = _union([
    f"select '{c}' as column_name, round(100.0 * (count(*) - count({c})) / count(*), 6) as null_pct from contest"
    for c in CONTEST_COLUMNS])


@query("taxonomy_profile", "P3 A1", sql=f"""
, tax(column_name, column_group) as (values {_TAX_VALUES}),
np as ({_NULL_PCT_SQL})
select np.column_name, coalesce(t.column_group, 'unclassified') as column_group, np.null_pct
from np left join tax t using (column_name)
""".replace(", tax(column_name", ", tax(column_name"))
def taxonomy_profile(spark, sf_dir):
    prof = PR.null_profile(contest(spark, sf_dir), CONTEST_COLUMNS).select("column_name", "null_pct")
    return P.classify_columns(prof, P.taxonomy_table(spark, presets.FIXTURE_TAXONOMY))


@query("drop_decisions", "P4", sql=f"""
, tax(column_name, column_group) as (values {_TAX_VALUES}),
np as ({_NULL_PCT_SQL}),
c as (select np.column_name, coalesce(t.column_group, 'unclassified') as column_group, np.null_pct
      from np left join tax t using (column_name)),
r as (select *, case when column_group = 'key' then 'key' when column_group = 'target' then 'target'
                     when column_group in ('safe_pre', 'context') and null_pct <= 50 then 'known before the contest'
                     when column_group in ('safe_pre', 'context') then 'too many nulls'
                     when column_group = 'outcome_raw' then 'history input only'
                     when column_group = 'unclassified' then 'unclassified'
                     else 'known only afterwards' end as reason from c)
select column_name, column_group, null_pct,
       case when reason in ('key', 'target', 'known before the contest', 'history input only') then 'keep'
            else 'drop' end as decision, reason
from r""")
def drop_decisions(spark, sf_dir):
    prof = PR.null_profile(contest(spark, sf_dir), CONTEST_COLUMNS).select("column_name", "null_pct")
    cl = P.classify_columns(prof, P.taxonomy_table(spark, presets.FIXTURE_TAXONOMY))
    return P.drop_decisions(cl, keep_groups=["safe_pre", "context"]).select(
        "column_name", "column_group", "null_pct", "decision", "reason")


# ---------------------------------------------------------------- A9 to A12, A7, ST15

def _describe_sql(c):
    q = ", ".join(f"round_even(quantile_cont({c}, {p}), 3) + 0.0 as {PR._pname(p)}" for p in PR.PCTS)
    return (f"select '{c}' as column_name, cast(count({c}) as double) as count, round_even(avg({c}), 3) + 0.0 as mean, "
            f"round_even(stddev_samp({c}), 3) + 0.0 as std, round_even(min({c}), 3) + 0.0 as min, {q}, "
            f"round_even(max({c}), 3) + 0.0 as max, round_even(skewness({c}), 3) + 0.0 as skew, "
            f"round_even(kurtosis({c}), 3) + 0.0 as kurtosis, "
            f"round_even(100.0 * (1 - count({c}) / count(*)), 3) + 0.0 as pct_null from cx")


@query("describe_block", "A9 A10 T7 T14", sql=CX_SQL + "\n" + _union([_describe_sql(c) for c in DESCRIBE]))
def describe_block(spark, sf_dir):
    return PR.describe_block(cx(spark, sf_dir), DESCRIBE)


@query("positive_share", "A11", sql=CX_SQL + "\n" + _union([
    f"select '{c}' as column_name, round(avg(case when {c} > 0 then 1.0 else 0.0 end), 6) as positive_share "
    f"from cx where {c} is not null" for c in ["rating_diff", "form_diff"]]))
def positive_share(spark, sf_dir):
    return PR.positive_share(cx(spark, sf_dir), ["rating_diff", "form_diff"]).select(
        "column_name", F.col("positive_share").cast("double").alias("positive_share"))


@query("class_balance", "A7 O6", sql=CX_SQL + """
, g as (select outcome, count(*) as n from cx where outcome is not null group by outcome)
select outcome, n, round(n / (select sum(n) from g), 6) as share,
       round((select max(n) from g) / (select min(n) from g), 6) as imbalance_ratio,
       (select arg_max(outcome, n) from g) as majority,
       (select arg_min(outcome, n) from g) as minority,
       round((select sum((n / (select sum(n) from g)) * (n / (select sum(n) from g))) from g), 6) as chance_accuracy
from g""")
def class_balance(spark, sf_dir):
    return PR.class_balance(cx(spark, sf_dir), "outcome")


_CM = ["home_rating", "away_rating", "rating_diff", "form_diff"]


@query("class_means", "A12", sql=CX_SQL + "\n" + _union([
    f"select outcome, '{c}' as column_name, round(avg({c}), 6) as mean, round(median({c}), 6) as median "
    f"from cx where outcome is not null group by outcome" for c in _CM]))
def class_means(spark, sf_dir):
    return PR.class_stats(cx(spark, sf_dir), "outcome", _CM).withColumnRenamed("s.column_name", "column_name")


@query("class_monotone", "ST15", sql=CX_SQL + "\n, m as (" + _union([
    f"select outcome, '{c}' as column_name, round(avg({c}), 6) as mean from cx where outcome is not null "
    f"group by outcome" for c in _CM]) + """)
select column_name, max(case when outcome = 'H' then mean end) as mean_H,
       max(case when outcome = 'D' then mean end) as mean_D, max(case when outcome = 'A' then mean end) as mean_A,
       max(case when outcome = 'H' then mean end) > max(case when outcome = 'D' then mean end)
         and max(case when outcome = 'D' then mean end) > max(case when outcome = 'A' then mean end) as monotone
from m group by column_name""")
def class_monotone(spark, sf_dir):
    st = PR.class_stats(cx(spark, sf_dir), "outcome", _CM)
    return PR.class_monotone(st, "outcome", presets.OUTCOME_ORDER)


# ---------------------------------------------------------------- A13, A14, F5

def _bin_case(x, edges, labels):
    return "case " + " ".join(f"when {x} > {lo} and {x} <= {hi} then '{lab}'"
                              for (lo, hi), lab in zip(zip(edges, edges[1:]), labels)) + " end"


def _ord_case(x, edges):
    return "case " + " ".join(f"when {x} > {lo} and {x} <= {hi} then {i}"
                              for i, (lo, hi) in enumerate(zip(edges, edges[1:]))) + " end"


def _rate_sql(x, edges, labels):
    rates = ", ".join(
        f"round(case when count(*) filter (where outcome = '{c}') > 0 "
        f"then count(*) filter (where outcome = '{c}') / cast(count(outcome) as double) end, 6) as rate_{c}"
        for c in presets.OUTCOME_ORDER)
    return CX_SQL + f"""
, b as (select {_bin_case(x, edges, labels)} as bin, {_ord_case(x, edges)} as bin_order, outcome
        from cx where {x} is not null and outcome is not null)
select bin, bin_order, count(*) as n, {rates} from b where bin is not null group by bin, bin_order"""


def _signed_labels():
    return [f"({lo}, {hi}]" for lo, hi in zip(SIGNED_EDGES, SIGNED_EDGES[1:])]


def _rate_spark(spark, sf_dir, x, edges, labels):
    d = cx(spark, sf_dir).where(F.col("outcome").isNotNull())
    return PR.rate_table(d, x=x, edges=edges, labels=labels, target="outcome", classes=presets.OUTCOME_ORDER)


@query("rate_by_abs_gap", "F5 A13 ST14 T6", sql=_rate_sql("abs(rating_diff)", ABS_EDGES, ABS_LABELS))
def rate_by_abs_gap(spark, sf_dir):
    return _rate_spark(spark, sf_dir, F.abs(F.col("rating_diff")), ABS_EDGES, ABS_LABELS)


@query("rate_by_signed_gap", "F5 A13", sql=_rate_sql("rating_diff", SIGNED_EDGES, _signed_labels()))
def rate_by_signed_gap(spark, sf_dir):
    return _rate_spark(spark, sf_dir, F.col("rating_diff"), SIGNED_EDGES, _signed_labels())


@query("rate_by_form_gap", "F5 A13", sql=_rate_sql("abs(form_diff)", FORM_EDGES, FORM_LABELS))
def rate_by_form_gap(spark, sf_dir):
    return _rate_spark(spark, sf_dir, F.abs(F.col("form_diff")), FORM_EDGES, FORM_LABELS)


@query("draw_rate_summary", "A14", sql=CX_SQL + f"""
, b as (select {_bin_case("abs(rating_diff)", ABS_EDGES, ABS_LABELS)} as bin, outcome
        from cx where rating_diff is not null and outcome is not null),
t as (select bin, count(*) filter (where outcome = 'D') / cast(count(*) as double) as rate_D
      from b where bin is not null group by bin)
select round((select avg(case when outcome = 'D' then 1.0 else 0.0 end) from cx where outcome is not null), 6)
         as overall_rate_D,
       round(max(case when rate_D > 0 then rate_D end), 6) as max_bin_rate_D from t""")
def draw_rate_summary(spark, sf_dir):
    d = cx(spark, sf_dir).where(F.col("outcome").isNotNull())
    t = PR.rate_table(d, x=F.abs(F.col("rating_diff")), edges=ABS_EDGES, labels=ABS_LABELS,
                      target="outcome", classes=presets.OUTCOME_ORDER)
    overall = d.agg(F.round(F.avg((F.col("outcome") == "D").cast("double")), 6)).first()[0]
    return t.agg(F.max("rate_D").alias("max_bin_rate_D")).select(
        F.lit(overall).cast("double").alias("overall_rate_D"), "max_bin_rate_D")


# ---------------------------------------------------------------- ST1 to ST4, W8

def _pairs_sql(fn):
    return _union([f"select '{a}' as a, '{b}' as b, {fn(a, b)} from cx" for a, b in ST.pairs(FEATS)])


@query("pearson", "ST1 J9", sql=CX_SQL + "\n" + _pairs_sql(lambda a, b: f"round(corr({a}, {b}), 6) as r"))
def pearson(spark, sf_dir):
    return ST.pearson_pairs(cx(spark, sf_dir), FEATS).select("a", "b", r6("r"))


@query("redundant_pairs", "ST3 J9", sql=CX_SQL + "\n, p as (" + _pairs_sql(lambda a, b: f"corr({a}, {b}) as r")
       + """)
select a, b, round(r, 6) as r, case when abs(r) > 0.9 then 'high' else 'moderate' end as level
from p where abs(r) > 0.7""")
def redundant_pairs(spark, sf_dir):
    return ST.redundant_pairs(ST.pearson_pairs(cx(spark, sf_dir), FEATS)).select("a", "b", r6("r"), "level")


@query("point_biserial", "ST4", sql=CX_SQL + "\n" + _union([
    f"select '{c}' as column_name, round(corr({c}, case when outcome = 'H' then 1.0 else 0.0 end), 6) as r from cx"
    for c in FEATS]))
def point_biserial(spark, sf_dir):
    return ST.point_biserial(cx(spark, sf_dir), FEATS, F.col("outcome") == "H").select("column_name", r6("r"))


def _spearman_sql(a, b):
    return f"""select '{a}' as a, '{b}' as b, round(corr(ra, rb), 6) as rho from (
  select (rank() over (order by {a}) + rank() over (order by {a}) + count(*) over (partition by {a}) - 1) / 2.0 as ra,
         (rank() over (order by {b}) + rank() over (order by {b}) + count(*) over (partition by {b}) - 1) / 2.0 as rb
  from cx where {a} is not null and {b} is not null)"""


@query("spearman", "ST2 W8", sql=CX_SQL + "\n" + _union([_spearman_sql(a, b) for a, b in ST.pairs(FEATS)]))
def spearman(spark, sf_dir):
    return ST.spearman_pairs(cx(spark, sf_dir), FEATS).select("a", "b", r6("rho"))


@query("average_rank", "W8", sql="""
select l_quantity as value, count(*) as n,
       (min(rk) + min(rk) + count(*) - 1) / 2.0 as rank
from (select l_quantity, rank() over (order by l_quantity) as rk from lineitem)
group by l_quantity""")
def average_rank(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity"])
    long = li.select(F.lit("l_quantity").alias("k"), F.col("l_quantity").alias("v"))
    return ST.average_ranks(long, keys=["k"], value="v").select(
        F.col("v").alias("value"), "n", F.col("rank").cast("double").alias("rank"))


# ---------------------------------------------------------------- ST5, ST6, P10, F11

def _iqr_sql(c):
    return f"""select '{c}' as column_name, round(q1, 6) as q1, round(q3, 6) as q3, round(lo, 6) as lo,
       round(hi, 6) as hi, n_outliers, round(100.0 * n_outliers / nn, 6) as pct_outliers from (
  select q1, q3, lo, hi, (select count(*) from lineitem where {c} < lo or {c} > hi) as n_outliers,
         (select count({c}) from lineitem) as nn
  from (select q1, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi
        from (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from lineitem)))"""


@query("iqr_outliers", "ST5", sql="\n" + _union([_iqr_sql(c) for c in LI_NUM]))
def iqr_outliers(spark, sf_dir):
    return ST.iqr_stats(read_table(spark, sf_dir, "lineitem", LI_NUM), LI_NUM)


@query("iqr_row_flags", "ST6 P9", sql="""
, q as (select """ + ", ".join(
    f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as lo_{c}, "
    f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as hi_{c}"
    for c in LI_NUM) + """ from lineitem)
select count(*) as n_rows, count(*) filter (where """ + " or ".join(
    f"{c} < lo_{c} or {c} > hi_{c}" for c in LI_NUM) + """) as n_any_outside
from lineitem cross join q""")
def iqr_row_flags(spark, sf_dir):
    li = MX.complete_cases(read_table(spark, sf_dir, "lineitem", LI_NUM), LI_NUM)
    flag = ST.iqr_row_flag(LI_NUM, ST.iqr_fences(li, LI_NUM))
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(flag).alias("n_any_outside"))


@query("sentinels", "P10", sql="""
select count(*) filter (where l_discount = 0) as zero_discount_count, max(l_discount) as zero_discount_max,
       count(*) filter (where l_tax = 0) as zero_tax_count, max(l_tax) as zero_tax_max,
       count(*) filter (where l_quantity = 50) as max_quantity_count, max(l_quantity) as max_quantity_max
from lineitem""")
def sentinels(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_discount", "l_tax", "l_quantity"])
    return P.sentinel_counts(li, {"zero_discount": ("l_discount", 0.0), "zero_tax": ("l_tax", 0.0),
                                  "max_quantity": ("l_quantity", 50.0)})


@query("zscores", "F11", sql=CX_SQL + """
select match_id,
       round((home_rating - avg(home_rating) over ()) / stddev_samp(home_rating) over (), 6) as z_home_rating,
       round((home_rating - avg(home_rating) over ()) / stddev_pop(home_rating) over (), 6) as zp_home_rating,
       round((form_diff - avg(form_diff) over ()) / stddev_samp(form_diff) over (), 6) as z_form_diff
from cx""")
def zscores(spark, sf_dir):
    d = cx(spark, sf_dir).select("match_id", "home_rating", "form_diff")
    z = ST.zscores(d, ["home_rating", "form_diff"], ddof=1, prefix="z_")
    z = ST.zscores(z, ["home_rating"], ddof=0, prefix="zp_")
    return z.select("match_id", r6("z_home_rating"), r6("zp_home_rating"), r6("z_form_diff"))


# ---------------------------------------------------------------- ST7 to ST10

@query("covariance", "ST7 P9", sql=CX_SQL + """
, cc as (select * from cx where """ + " and ".join(f"{c} is not null" for c in MAHA) + ")\n" + _union(
    [f"select '{a}' as a, '{b}' as b, round(covar_samp({a}, {b}), 2) as cov from cc"
     for a, b in [(c, c) for c in MAHA] + ST.pairs(MAHA)]))
def covariance(spark, sf_dir):
    m = MX.moments(cx(spark, sf_dir), MAHA)
    return spark.createDataFrame(MX.covariance_table(m), "a string, b string, cov double").select(
        "a", "b", F.round("cov", 2).alias("cov"))


def _maha(spark, sf_dir):
    d, thr = MX.mahalanobis(cx(spark, sf_dir), MAHA)
    return d, thr


@query("mahalanobis", "ST8")
def mahalanobis(spark, sf_dir):
    d, thr = _maha(spark, sf_dir)
    med = ST.exact_percentiles(d, ["d2"], [0.5]).first()["value"]
    return d.agg(F.count(F.lit(1)).alias("n_complete"), F.count_if("mv_outlier").alias("n_outliers"),
                 F.round(F.min("d2"), 6).alias("d2_min"), F.round(F.avg("d2"), 6).alias("d2_mean"),
                 F.round(F.max("d2"), 6).alias("d2_max")
                 ).withColumns({"d2_median": F.lit(round(med, 6)), "threshold": F.lit(round(thr, 6))})


def _profiled(spark, sf_dir):
    d, thr = _maha(spark, sf_dir)
    z = ST.zscores(d, MAHA, ddof=0, prefix="z_")
    zc = [f"z_{c}" for c in MAHA]
    return z.withColumns({"dominant": MX.dominant_column(zc, MAHA),
                          "archetype": MX.first_match(presets.ARCHETYPE_RULES, presets.ARCHETYPE_OTHER)})


@query("outlier_profile", "ST9 F9 F10 A19")
def outlier_profile(spark, sf_dir):
    z = _profiled(spark, sf_dir).where("mv_outlier")
    a = PR.value_counts(z, "archetype").select(F.lit("archetype").alias("kind"), F.col("archetype").alias("value"), "n")
    b = PR.value_counts(z, "dominant").select(F.lit("dominant").alias("kind"), F.col("dominant").alias("value"), "n")
    return a.unionByName(b)


@query("outlier_overlap", "A20 ST6")
def outlier_overlap(spark, sf_dir):
    d, _ = _maha(spark, sf_dir)
    uni = ST.iqr_row_flag(MAHA, ST.iqr_fences(d, MAHA))
    mv = F.col("mv_outlier")
    return d.agg(F.count_if(mv & uni).alias("both"), F.count_if(mv & ~uni).alias("multivariate_only"),
                 F.count_if(~mv & uni).alias("univariate_only"), F.count_if(~mv & ~uni).alias("neither"))


@query("top_outliers", "O4 ST9")
def top_outliers(spark, sf_dir):
    z = _profiled(spark, sf_dir).where("mv_outlier")
    return z.orderBy(F.desc("d2"), "match_id").limit(8).select(
        "match_id", "match_date", "division", "home", "away", r6("d2"), "dominant", "archetype")


@query("vif", "ST10 F13")
def vif(spark, sf_dir):
    vals = MX.vif(cx(spark, sf_dir), MAHA)
    df = spark.createDataFrame(vals, "column_name string, vif double")
    return df.withColumn("severity", P.severity("vif", 10, 5)).orderBy(F.desc("vif"))


# ---------------------------------------------------------------- ST11 to ST13

@query("histogram", "ST11", sql=CX_SQL + """
select cast(floor(form_home + 0.5) as bigint) as center, count(*) as n from cx where form_home is not null group by 1""")
def histogram(spark, sf_dir):
    return ST.unit_histogram(cx(spark, sf_dir), "form_home").select(F.col("center").cast("bigint"), "n")


@query("histogram_width", "ST11", sql=CX_SQL + """
, mm as (select min(rating_diff) as lo, max(rating_diff) as hi from cx)
select cast(least(floor((rating_diff - lo) / ((hi - lo) / 60)), 59) as int) as bin, count(*) as n
from cx cross join mm where rating_diff is not null group by 1""")
def histogram_width(spark, sf_dir):
    return ST.width_histogram(cx(spark, sf_dir), "rating_diff", 60).select("bin", "n")


@query("kde", "ST12", sql=CX_SQL + """
, s as (select count(form_diff) as n, stddev_samp(form_diff) * pow(count(form_diff), -0.2) as bw,
               min(form_diff) as lo, max(form_diff) as hi from cx),
g as (select i, (lo - 3 * bw) + i * (((hi + 3 * bw) - (lo - 3 * bw)) / 199) as x, bw, n from s, range(200) t(i)),
v as (select form_diff as v, count(*) as c from cx where form_diff is not null group by 1)
select i, round(sum(c * exp(-0.5 * ((x - v) / bw) * ((x - v) / bw)) / (n * bw * sqrt(2 * pi()))), 6) as density
from g cross join v group by i""")
def kde(spark, sf_dir):
    return ST.kde_curve(cx(spark, sf_dir), "form_diff").select(F.col("i").cast("bigint"), r6("density"))


@query("box_data", "ST13", sql=CX_SQL + """
, q as (select outcome, quantile_cont(rating_diff, 0.25) as q1, quantile_cont(rating_diff, 0.5) as median,
               quantile_cont(rating_diff, 0.75) as q3
        from cx where rating_diff is not null and outcome is not null group by outcome)
select q.outcome, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
       round(min(rating_diff) filter (where rating_diff between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6)
         as whisker_lo,
       round(max(rating_diff) filter (where rating_diff between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6)
         as whisker_hi,
       count(*) filter (where not rating_diff between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as n_fliers
from cx join q using (outcome) where rating_diff is not null group by q.outcome, q1, median, q3""")
def box_data(spark, sf_dir):
    d = cx(spark, sf_dir).where(F.col("outcome").isNotNull())
    b = ST.box_stats(d, value="rating_diff", by="outcome")
    return b.select("outcome", *[r6(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_fliers")


# ---------------------------------------------------------------- M7, M9

@query("pca_table", "M7")
def pca_table(spark, sf_dir):
    x = S.design(spark, sf_dir).where(F.col("split") == "train")
    cols = [f"num__{c}" for c in S.CONTINUOUS]
    fit = MX.pca_fit(x, cols)
    cum = np.cumsum(fit.ratio)
    rows = [(i + 1, float(fit.eigenvalues[i]), float(fit.ratio[i]), float(cum[i]),
             fit.k_for(0.95), fit.k_elbow(), int((fit.eigenvalues < 1e-8).sum())) for i in range(len(cols))]
    return spark.createDataFrame(rows, "component int, eigenvalue double, ratio double, cumulative double, "
                                       "k95 int, k_elbow int, near_zero int")


@query("pca_scores", "M9 J7")
def pca_scores(spark, sf_dir):
    x = S.design(spark, sf_dir)
    cols = [f"num__{c}" for c in S.CONTINUOUS]
    fit = MX.pca_fit(x.where(F.col("split") == "train"), cols)
    k = fit.k_for(0.95)
    other = [c for c in x.columns if c.startswith("flags__") or c.startswith("cat__")]
    return fit.project(x, k, keep=["match_id", "split", *other])
