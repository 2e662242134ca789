"""Stand-in contest, ratings and prediction tables derived from the given tables.

``contest`` has the shape of a dated two-sided contest table (two entities,
a date, two scores, two ratings with holes, two form values with holes);
``ratings`` is a dated rating history per entity with a position for ties;
``pred`` is a prediction table (label plus three class probabilities).

The Spark builders below and the SQL texts (used by the DuckDB oracle)
define the same rows. All joins are equi joins; the planner chooses the
strategy (AQE turns the customer/supplier side into a broadcast only after
measuring it at run time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.sources.tables import read_table

CONTEST_COLUMNS = [
    "match_id", "division", "match_date", "home", "away", "home_score",
    "away_score", "home_rating", "away_rating", "form_home", "form_away",
]


def contest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    nothing = F.lit(None)
    return j.select(
        k.alias("match_id"),
        F.col("o_orderpriority").alias("division"),
        F.col("o_orderdate").alias("match_date"),
        F.col("c_nationkey").alias("home"),
        ((F.col("c_nationkey") + 1 + k % 24) % 25).cast("int").alias("away"),
        (F.floor("o_totalprice").cast("bigint") % 5).alias("home_score"),
        ((F.col("o_custkey") + k) % 4).alias("away_score"),
        F.when((k % 5).isin(0, 1), nothing).otherwise(F.col("c_acctbal")).alias("home_rating"),
        F.when((k % 7).isin(0, 1, 2), nothing)
         .otherwise(F.col("o_totalprice") / 100).alias("away_rating"),
        F.when(k % 150 == 0, nothing)
         .otherwise((F.col("o_custkey") % 16).cast("double")).alias("form_home"),
        F.when(k % 150 == 0, nothing)
         .otherwise(((F.col("o_custkey") + k) % 16).cast("double")).alias("form_away"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_extendedprice", "l_shipdate"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    j = li.join(s, li.l_suppkey == s.s_suppkey, "inner").where(F.col("s_nationkey") % 5 != 0)
    return j.select(
        F.col("s_nationkey").alias("entity"),
        F.col("l_shipdate").alias("rating_date"),
        (F.col("l_extendedprice") / 100).alias("rating"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )


# Position columns that order equal-date ratings ("last in file order wins").
RATING_POSITION = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def outcome_code(home_score: Column, away_score: Column) -> Column:
    """Label code A=0, D=1, H=2 from the two scores."""
    return (F.when(home_score > away_score, 2)
            .when(home_score == away_score, 1).otherwise(0))


def pred(spark: SparkSession, sf_dir: str, c: DataFrame | None = None) -> DataFrame:
    c = contest(spark, sf_dir) if c is None else c
    m = F.col("match_id")
    a = m % 97 + 1
    b = F.col("home") + 1
    d = m % 83 + 1
    tot = (a + b + d).cast("double")
    return c.select(
        m,
        outcome_code(F.col("home_score"), F.col("away_score")).alias("label"),
        (a / tot).alias("p0"), (b / tot).alias("p1"), (d / tot).alias("p2"),
    )


# Same rows as SQL text for the oracle (DuckDB has the base tables as views).
CONTEST_SQL = """
select o_orderkey as match_id, o_orderpriority as division, o_orderdate as match_date,
       c_nationkey as home,
       cast((c_nationkey + 1 + o_orderkey % 24) % 25 as int) as away,
       cast(floor(o_totalprice) as bigint) % 5 as home_score,
       (o_custkey + o_orderkey) % 4 as away_score,
       case when o_orderkey % 5 in (0,1) then null else c_acctbal end as home_rating,
       case when o_orderkey % 7 in (0,1,2) then null else o_totalprice / 100 end as away_rating,
       case when o_orderkey % 150 = 0 then null else cast(o_custkey % 16 as double) end as form_home,
       case when o_orderkey % 150 = 0 then null else cast((o_custkey + o_orderkey) % 16 as double) end as form_away
from orders join customer on o_custkey = c_custkey
"""

RATINGS_SQL = """
select s_nationkey as entity, l_shipdate as rating_date, l_extendedprice / 100 as rating,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
from lineitem join supplier on l_suppkey = s_suppkey
where s_nationkey % 5 <> 0
"""

PRED_SQL = """
select match_id,
       case when home_score > away_score then 2 when home_score = away_score then 1 else 0 end as label,
       (match_id % 97 + 1) / cast(match_id % 97 + 1 + home + 1 + match_id % 83 + 1 as double) as p0,
       (home + 1)          / cast(match_id % 97 + 1 + home + 1 + match_id % 83 + 1 as double) as p1,
       (match_id % 83 + 1) / cast(match_id % 97 + 1 + home + 1 + match_id % 83 + 1 as double) as p2
from contest
"""


def with_fixtures(sql: str, recursive: bool = False) -> str:
    """Prefix an oracle query with the stand-in views as CTEs."""
    return (f"with {'recursive ' if recursive else ''}contest as ({CONTEST_SQL}), ratings as ({RATINGS_SQL}), "
            f"pred as ({PRED_SQL})\n{sql}")
