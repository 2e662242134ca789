"""Queries for the rating fill: S2, F1, F2, J1, J2, J8, U3, A5, A22, O4."""

from __future__ import annotations

from pyspark.sql import functions as F

from pastline import presets
from pastline.functions.names import entity_name
from pastline.operators import asof as A
from pastline.plans.registry import query, r6
from pastline.sources.fixtures import RATING_POSITION, contest, ratings
from pastline.sources.tables import read_table

_ASOF_SQL = """
, sides as (
  select match_id, 'H' as venue, home as entity, match_date from contest
  union all
  select match_id, 'A', away, match_date from contest),
m as (
  select s.match_id, s.venue, r.rating,
         row_number() over (partition by s.match_id, s.venue
                            order by r.rating_date desc, r.l_orderkey desc, r.l_linenumber desc,
                                     r.l_partkey desc, r.l_suppkey desc, r.l_extendedprice desc) as rn
  from sides s join ratings r on r.entity = s.entity and r.rating_date <= s.match_date),
a as (
  select match_id, max(case when venue = 'H' then rating end) as home_asof,
         max(case when venue = 'A' then rating end) as away_asof
  from m where rn = 1 group by match_id),
filled as (
  select c.*, coalesce(c.home_rating, a.home_asof) as home_filled,
         coalesce(c.away_rating, a.away_asof) as away_filled
  from contest c left join a using (match_id))"""


def filled(spark, sf_dir):
    return A.asof_fill(contest(spark, sf_dir), ratings(spark, sf_dir), r_position=RATING_POSITION)


@query("asof_fill", "S2 J1 J2", sql=f"""
{_ASOF_SQL}
select match_id, round(home_filled, 6) as home_rating, round(away_filled, 6) as away_rating from filled
""")
def asof_fill(spark, sf_dir):
    return filled(spark, sf_dir).select("match_id", r6("home_rating"), r6("away_rating"))


@query("asof_recovery", "A22 J2", sql=f"""
{_ASOF_SQL}
select count(*) as n_rows,
       count(*) - count(home_rating) as home_null_before, count(*) - count(home_filled) as home_null_after,
       count(*) - count(away_rating) as away_null_before, count(*) - count(away_filled) as away_null_after,
       count(home_filled) - count(home_rating) as home_recovered,
       count(away_filled) - count(away_rating) as away_recovered,
       (select count(*) from ratings) as rating_rows,
       (select count(distinct entity) from ratings) as rating_entities
from filled
""")
def asof_recovery(spark, sf_dir):
    f = filled(spark, sf_dir)
    n = F.count(F.lit(1))
    out = f.agg(
        n.alias("n_rows"),
        (n - F.count("home_rating_before")).alias("home_null_before"),
        (n - F.count("home_rating")).alias("home_null_after"),
        (n - F.count("away_rating_before")).alias("away_null_before"),
        (n - F.count("away_rating")).alias("away_null_after"),
        (F.count("home_rating") - F.count("home_rating_before")).alias("home_recovered"),
        (F.count("away_rating") - F.count("away_rating_before")).alias("away_recovered"),
    )
    r = ratings(spark, sf_dir).agg(F.count(F.lit(1)), F.count_distinct("entity")).first()  # two scalars
    return out.withColumns({"rating_rows": F.lit(r[0]).cast("bigint"), "rating_entities": F.lit(r[1]).cast("bigint")})


@query("entity_coverage", "U3", sql="""
, e as (select home as entity from contest union select away from contest),
r as (select distinct entity from ratings)
select (select count(*) from e) as contest_entities,
       (select count(*) from r) as rated_entities,
       (select count(*) from e where entity in (select entity from r)) as covered_entities,
       round(100.0 * (select count(*) from e where entity in (select entity from r)) / (select count(*) from e), 6)
         as coverage_pct
""")
def entity_coverage(spark, sf_dir):
    return A.coverage(contest(spark, sf_dir), ratings(spark, sf_dir))


@query("unrated_entities", "J8 T16", sql=f"""
{_ASOF_SQL},
rem as (select * from filled where home_filled is null)
select count(*) as home_null_after,
       count(*) filter (where home not in (select distinct entity from ratings)) as absent_from_ratings,
       round(100.0 * count(*) filter (where home not in (select distinct entity from ratings))
             / greatest(count(*), 1), 6) as absent_pct
from rem
""")
def unrated_entities(spark, sf_dir):
    f = filled(spark, sf_dir)
    rem = f.where(F.col("home_rating").isNull()).select("match_id", F.col("home").alias("entity"))
    absent = A.unrated_rows(rem, ratings(spark, sf_dir), key="entity")
    n_absent = absent.agg(F.count(F.lit(1))).first()[0]  # one scalar
    out = rem.agg(F.count(F.lit(1)).alias("home_null_after")).withColumn(
        "absent_from_ratings", F.lit(n_absent).cast("bigint"))
    return out.withColumn("absent_pct", F.round(
        100.0 * F.col("absent_from_ratings") / F.greatest(F.col("home_null_after"), F.lit(1)), 6))


@query("null_rate_by_group", "A5 O4", sql=f"""
{_ASOF_SQL}
select division, round(100.0 * avg(case when home_filled is null then 1.0 else 0.0 end), 6) as null_pct,
       count(*) as n_rows
from filled group by division order by null_pct desc, division limit 12
""")
def null_rate_by_group(spark, sf_dir):
    f = filled(spark, sf_dir)
    g = f.groupBy("division").agg(
        F.round(100.0 * F.avg(F.col("home_rating").isNull().cast("double")), 6).alias("null_pct"),
        F.count(F.lit(1)).alias("n_rows"))
    return g.orderBy(F.desc("null_pct"), "division").limit(12)


@query("name_normalise", "F1 F2", sql="""
select c_custkey,
       coalesce(trim(regexp_replace(
         case when messy = 'Customer#000000007' then 'Customer Seven' else messy end, '\\s+', ' ', 'g')), '') as name
from (select c_custkey,
             case when c_custkey % 11 = 0 then null
                  when c_custkey = 7 then 'Customer#000000007'
                  else concat('  ', replace(c_name, '#', ' \t #  '), ' ') end as messy
      from customer)
""")
def name_normalise(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    k = F.col("c_custkey")
    messy = (F.when(k % 11 == 0, F.lit(None))
             .when(k == 7, F.lit("Customer#000000007"))
             .otherwise(F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit(" \t #  ")), F.lit(" "))))
    aliases = {**presets.ENTITY_ALIASES, "Customer#000000007": "Customer Seven"}
    return c.select("c_custkey", entity_name(messy, aliases).alias("name"))
