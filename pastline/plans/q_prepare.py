"""Queries for contract, split and train-only preparation:
P1, P2, P5 to P8, F3, F4, F6, F7, F8, A8, A15 to A17, U2, J4, M1 to M6."""

from __future__ import annotations

from pyspark.sql import functions as F

from pastline import presets
from pastline.operators import contract as P
from pastline.operators.split import class_shares, split_summary
from pastline.plans import stages as S
from pastline.plans.registry import query, r6
from pastline.sources.fixtures import contest

KEEP = ["match_id", "division", "match_date", "home", "away", "home_rating", "away_rating",
        "form_home", "form_away", "home_score", "away_score"]


@query("contract_clean", "P1 P2", sql=f"""
select {", ".join(KEEP)} from contest where home_score is not null and away_score is not null
""")
def contract_clean(spark, sf_dir):
    c = P.drop_null_target(contest(spark, sf_dir), ["home_score", "away_score"])
    return P.keep_columns(c, KEEP)


@query("diffs_and_flags", "P5 P6 P7 P8 F6 F8", sql="""
select match_id,
       round(home_rating - away_rating, 6) as rating_diff,
       round(abs(home_rating - away_rating), 6) as rating_gap,
       form_home - form_away as form_diff,
       case when division in ('1-URGENT', '2-HIGH') then 1 else 0 end as is_top_league,
       case when home_rating is null or away_rating is null then 1 else 0 end as rating_missing,
       case when home_score > away_score then 'H' when home_score < away_score then 'A'
            when home_score = away_score then 'D' end as outcome,
       case when home_score > away_score then home when home_score < away_score then away end as winner
from contest
""")
def diffs_and_flags(spark, sf_dir):
    c = contest(spark, sf_dir)
    d = P.differences({"rating_diff": ("home_rating", "away_rating"), "form_diff": ("form_home", "form_away")})
    res = P.outcome_from_scores("home_score", "away_score")
    return c.select(
        "match_id", r6(d["rating_diff"], "rating_diff"), r6(F.abs(d["rating_diff"]), "rating_gap"),
        d["form_diff"].alias("form_diff"),
        P.member_flag("division", presets.FIXTURE_TOP_GROUPS).alias("is_top_league"),
        P.any_null_flag("home_rating", "away_rating").alias("rating_missing"),
        res.alias("outcome"), P.winner("home", "away", res).alias("winner"))


@query("split_labels", "F3 F4", sql=f"""
select match_id, cast(year(match_date) as int) as year,
       case when year(match_date) <= {presets.FIXTURE_TRAIN_END} then 'train'
            when year(match_date) between {presets.FIXTURE_VAL_YEARS[0]} and {presets.FIXTURE_VAL_YEARS[1]} then 'val'
            else 'test' end as split
from contest
""")
def split_labels(spark, sf_dir):
    from pastline.operators.split import add_split
    c = contest(spark, sf_dir).select("match_id", "match_date")
    return add_split(c, time="match_date", train_end=presets.FIXTURE_TRAIN_END,
                     val_years=presets.FIXTURE_VAL_YEARS).select("match_id", "year", "split")


@query("split_summary", "A17", sql=S.features_sql() + """
, g as (select split, count(*) as n_rows, min(match_date) as first_time, max(match_date) as last_time
        from feat group by split)
select split, n_rows, round(100.0 * n_rows / (select count(*) from feat), 6) as share_pct,
       first_time, last_time,
       (select max(last_time) filter (where split = 'train') < min(first_time) filter (where split = 'val')
           and max(last_time) filter (where split = 'val') < min(first_time) filter (where split = 'test')
        from g) as boundary_ok
from g
""")
def split_summary_q(spark, sf_dir):
    return split_summary(S.features(spark, sf_dir), time="match_date")


@query("class_share_by_split", "A8 M6", sql=S.features_sql() + """
select split, count(*) as n_rows,
       round(100.0 * count(*) filter (where outcome = 'H') / count(*), 6) as share_H,
       round(100.0 * count(*) filter (where outcome = 'D') / count(*), 6) as share_D,
       round(100.0 * count(*) filter (where outcome = 'A') / count(*), 6) as share_A
from feat group by split
""")
def class_share_by_split(spark, sf_dir):
    return class_shares(S.features(spark, sf_dir), by="split", target="outcome",
                        classes=presets.OUTCOME_ORDER)


_MED_UNION = " union all ".join(
    [f"select 'column' as stat, '{c}' as grp, round(median({c}), 6) as value from tr" for c in S.MEDIAN_COLS])


@query("train_medians", "A15 A16 U2", sql=S.prepare_sql() + f"""
select 'group' as stat, division as grp, round(med, 6) as value from gmed
union all select 'global', 'all', round(med, 6) from gall
union all {_MED_UNION}
""")
def train_medians(spark, sf_dir):
    p = S.prepared(spark, sf_dir)
    rows = ([("group", g, v) for g, v in p.group_medians.items()] + [("global", "all", p.global_median)]
            + [("column", c, v) for c, v in p.medians.items()])
    df = spark.createDataFrame(rows, "stat string, grp string, value double")  # the fitted state
    return df.select("stat", "grp", r6("value"))


@query("imputed", "M1 J4 F7 P7 P5 M5", sql=S.prepare_sql() + f"""
select match_id, rating_missing, {", ".join(f"round({c}, 6) as {c}" for c in S.CONTINUOUS)} from imp
""")
def imputed(spark, sf_dir):
    p = S.prepared(spark, sf_dir)
    return p.impute(S.features(spark, sf_dir)).select("match_id", "rating_missing", *[r6(c) for c in S.CONTINUOUS])


_NUM = ", ".join(
    f"round(({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end, 6) as num__{c}" for c in S.CONTINUOUS)


@query("scaled", "M2", sql=S.prepare_sql() + f"""
select match_id, {_NUM} from imp cross join sc
""")
def scaled(spark, sf_dir):
    x = S.design(spark, sf_dir)
    return x.select("match_id", *[r6(f"num__{c}") for c in S.CONTINUOUS])


@query("one_hot", "M3", sql=S.features_sql() + """
, cats as (select distinct division from feat where split = 'train' and division is not null),
onehot as (
  select f.match_id, 'cat__division_' || c.division as name,
         cast(case when f.division = c.division then 1 else 0 end as double) as v
  from feat f cross join cats c)
select match_id, name, v from onehot
""")
def one_hot(spark, sf_dir):
    x = S.design(spark, sf_dir)
    cats = [c for c in x.columns if c.startswith("cat__")]
    # long form (id, name, value): the oracle needs no fixed category list
    return x.select("match_id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in cats])).alias("s")).select(
        "match_id", "s.name", "s.v")


@query("design_matrix", "M4 M6", sql=S.prepare_sql() + """
, cats as (select count(distinct division) as k from feat where split = 'train')
select split, count(*) as n_rows, 19 + 2 + (select k from cats) as n_features,
       round(count(*) filter (where outcome = 'H') / count(*), 6) as share_H,
       round(count(*) filter (where outcome = 'D') / count(*), 6) as share_D,
       round(count(*) filter (where outcome = 'A') / count(*), 6) as share_A
from imp group by split
""")
def design_matrix(spark, sf_dir):
    p = S.prepared(spark, sf_dir)
    x = S.design(spark, sf_dir)
    n = F.count(F.lit(1))
    return x.groupBy("split").agg(
        n.alias("n_rows"), F.lit(len(p.feature_names())).cast("bigint").alias("n_features"),
        *[F.round(F.count_if(F.col("outcome") == c) / n, 6).alias(f"share_{c}") for c in presets.OUTCOME_ORDER])


# ---------------------------------------------------------------- the state as a table: M1 to M4, J4, A15, S7

@query("preparation_state", "S7 M1 A15 A16 M2", sql=S.prepare_sql() + f"""
, cat as (select distinct division from feat where split = 'train' and division is not null)
select 'group_median' as kind, '' as name, division as grp, round(med, 6) as value from gmed where division is not null and med is not null
union all select 'global_median', '', null, round(med, 6) from gall
{" ".join(f"union all select 'median', '{c}', null, round({c}, 6) from cmed" for c in S.MEDIAN_COLS)}
{" ".join(f"union all select 'constant', '{c}', null, {v!r}" for c, v in S.CONSTANTS.items())}
{" ".join(f"union all select 'mean', '{c}', null, round(m_{c}, 6) from sc union all select 'scale', '{c}', null, round(case when s_{c} = 0 then 1 else s_{c} end, 6) from sc" for c in S.CONTINUOUS)}
union all select 'category', '', division, row_number() over (order by division) - 1 from cat""")
def preparation_state(spark, sf_dir):
    """The fitted state, read back from the folder it was written to."""
    return S.stored_preparation(spark, sf_dir).select("kind", "name", "grp", r6("value"))


@query("reloaded_design", "S7 M1 M2 M3 J4", sql=S.prepare_sql() + f"""
, cat as (select division, row_number() over (order by division) - 1 as place
          from (select distinct division from feat where split = 'train' and division is not null))
select match_id, {_NUM}, cast(coalesce(cat.place, (select count(*) from cat)) as double) as category
from imp cross join sc left join cat on cat.division = imp.division""")
def reloaded_design(spark, sf_dir):
    """All rows prepared from the reloaded state alone."""
    from pastline.operators import prepare_table as PT
    x = PT.transform(S.features(spark, sf_dir), S.stored_preparation(spark, sf_dir), S.preparer(), keep=["match_id"])
    return x.select("match_id", *[r6(f"num__{c}") for c in S.CONTINUOUS], "category")


# ---------------------------------------------------------------- A6, F14, S1, S2, S9

NEW_FEATURES = [*[f"{v}_{s}" for v in ("home", "away") for s in S.HIST_STATS], "h2h_played", "h2h_home_winrate", "h2h_avg_goals", "is_top_league"]


@query("new_feature_summary", "A6", sql=S.features_sql() + "\n" + "\nunion all\n".join(
    f"select '{c}' as column_name, count(*) - count({c}) as n_null, round(100.0 * (count(*) - count({c})) / count(*), 6) as null_pct, "
    f"round(avg({c}), 6) as mean from feat" for c in NEW_FEATURES))
def new_feature_summary(spark, sf_dir):
    from pastline.operators.profile import feature_summary
    return feature_summary(S.features(spark, sf_dir), NEW_FEATURES)


@query("feature_names", "F14", sql=S.features_sql() + f"""
select name, kind from (values {", ".join(f"('{c}', 'num')" for c in S.CONTINUOUS)}, {", ".join(f"('{c}', 'flags')" for c in S.FLAGS)}) v(name, kind)
union all
select distinct 'division_' || division, 'cat' from feat where split = 'train' and division is not null""")
def feature_names(spark, sf_dir):
    """readable feature names, without the prefix that tells their kind."""
    from pastline.functions.names import feature_kind, plain_feature
    names = spark.createDataFrame([(n,) for n in S.prepared(spark, sf_dir).feature_names()], "raw string")
    return names.select(plain_feature("raw").alias("name"), feature_kind("raw").alias("kind"))


_CSV_SCHEMA = "match_id bigint, division string, match_date timestamp_ntz, home int, away int, home_score bigint, away_score bigint, home_rating double, away_rating double"


@query("csv_source", "S1 S2 S9", sql="""
select division, count(*) filter (where match_id % 500 <> 0) as n_rows, count(*) filter (where match_id % 500 = 0) as n_corrupt,
       count(*) filter (where match_id % 500 <> 0 and home_rating is null) as null_home,
       round(sum(home_rating) filter (where match_id % 500 <> 0), 2) as sum_home,
       round(sum(away_rating) filter (where match_id % 500 <> 0), 2) as sum_away,
       max(match_date) filter (where match_id % 500 <> 0) as last_date
from contest group by division""")
def csv_source(spark, sf_dir):
    """The contest table written as CSV files (half of its missing ratings as
    NaN, one record in 500 with a word for a number) and read back under an
    enforced schema: NaN is null again and the records that do not fit are
    counted by the division that their text names."""
    from pastline.sources import csv_tables as CSV
    from pastline.sources import sinks
    c = contest(spark, sf_dir).withColumn("home_rating", F.when(
        F.col("home_rating").isNull() & (F.col("match_id") % 2 == 0), F.lit(float("nan"))).otherwise(F.col("home_rating")))
    cols = [f.split()[0] for f in _CSV_SCHEMA.split(", ")]
    broken = c.where(F.col("match_id") % 500 == 0).select(*[F.lit("none").alias("home") if x == "home" else F.col(x) for x in cols])
    good_path, bad_path = sinks.stage_root(spark, "contest_csv"), sinks.stage_root(spark, "contest_csv_broken")
    sinks.write_csv(c.where(F.col("match_id") % 500 != 0).select(*cols), good_path, single=False)
    sinks.write_csv(broken, bad_path, single=False)
    rows = CSV.read_csv(spark, [good_path, bad_path], _CSV_SCHEMA)
    fits = F.col(CSV.CORRUPT).isNull()
    division = F.when(fits, F.col("division")).otherwise(F.split(CSV.CORRUPT, ",")[1])
    return rows.groupBy(division.alias("division")).agg(
        F.count_if(fits).alias("n_rows"), F.count_if(~fits).alias("n_corrupt"),
        F.count_if(fits & F.col("home_rating").isNull()).alias("null_home"),
        F.round(F.sum(F.when(fits, F.col("home_rating"))), 2).alias("sum_home"),
        F.round(F.sum(F.when(fits, F.col("away_rating"))), 2).alias("sum_away"),
        F.max(F.when(fits, F.col("match_date"))).alias("last_date"))
