"""Queries for past-only history: U1, W1 to W7, A18, J3, O1."""

from __future__ import annotations

from pyspark.sql import functions as F

from pastline.operators import history as H
from pastline.plans.registry import query, r6
from pastline.sources.fixtures import contest
from pastline.sources.tables import read_table

_LONG = """
long as (
  select match_id, match_date, home as entity, 'H' as venue,
         cast(home_score as double) as gf, cast(away_score as double) as ga,
         home_score > away_score as won
  from contest
  union all
  select match_id, match_date, away, 'A', cast(away_score as double), cast(home_score as double),
         away_score > home_score
  from contest)"""


def contest_features(spark, sf_dir, k=5):
    return H.contest_history(contest(spark, sf_dir), k=k)


@query("trailing_mean_5", "S1 U1 W1 A18 J3 O2", sql=f"""
, {_LONG.strip()},
f as (
  select match_id, venue, avg(gf) over w as gf5, avg(ga) over w as ga5
  from long
  window w as (partition by entity order by match_date, match_id rows between 5 preceding and 1 preceding))
select match_id,
       round(max(case when venue = 'H' then gf5 end), 6) as home_gf5,
       round(max(case when venue = 'H' then ga5 end), 6) as home_ga5,
       round(max(case when venue = 'A' then gf5 end), 6) as away_gf5,
       round(max(case when venue = 'A' then ga5 end), 6) as away_ga5
from f group by match_id
""")
def trailing_mean_5(spark, sf_dir):
    df = contest_features(spark, sf_dir)
    return df.select("match_id", *[r6(c) for c in ("home_gf5", "home_ga5", "away_gf5", "away_ga5")])


@query("rest_days", "U1 W2 A18 J3", sql=f"""
, {_LONG.strip()},
f as (
  select match_id, venue,
         cast(floor((epoch_us(match_date) - epoch_us(lag(match_date) over w)) / 86400000000) as double) as rest_days
  from long
  window w as (partition by entity order by match_date, match_id))
select match_id,
       max(case when venue = 'H' then rest_days end) as home_rest_days,
       max(case when venue = 'A' then rest_days end) as away_rest_days
from f group by match_id
""")
def rest_days(spark, sf_dir):
    return contest_features(spark, sf_dir).select("match_id", "home_rest_days", "away_rest_days")


@query("win_streak", "U1 W3 A18 J3", sql=f"""
, {_LONG.strip()},
n as (select *, row_number() over (partition by entity order by match_date, match_id) as rn from long),
f as (
  select match_id, venue,
         cast(rn - 1 - coalesce(max(case when not won then rn end) over (
              partition by entity order by match_date, match_id
              rows between unbounded preceding and 1 preceding), 0) as double) as streak
  from n)
select match_id,
       max(case when venue = 'H' then streak end) as home_win_streak,
       max(case when venue = 'A' then streak end) as away_win_streak
from f group by match_id
""")
def win_streak(spark, sf_dir):
    return contest_features(spark, sf_dir).select("match_id", "home_win_streak", "away_win_streak")


@query("h2h_history", "W4 W5 W6", sql="""
, p as (
  select match_id, home, least(home, away) as lo, match_date, home_score + away_score as g,
         case when home_score > away_score then home when home_score < away_score then away end as winner,
         greatest(home, away) as hi
  from contest),
f as (
  select match_id, home, lo,
         count(*) over w as played,
         sum(case when winner = lo then 1 else 0 end) over w as wlo,
         sum(case when winner = hi then 1 else 0 end) over w as whi,
         sum(g) over w as goals
  from p
  window w as (partition by lo, hi order by match_date, match_id rows between unbounded preceding and 1 preceding))
select match_id,
       cast(played as double) as h2h_played,
       round(case when played > 0 then (case when home = lo then wlo else whi end) / cast(played as double) end, 6)
         as h2h_home_winrate,
       round(case when played > 0 then goals / cast(played as double) end, 6) as h2h_avg_goals
from f
""")
def h2h_history(spark, sf_dir):
    df = H.pair_history(contest(spark, sf_dir))
    return df.select("match_id", "h2h_played", r6("h2h_home_winrate"), r6("h2h_avg_goals"))


@query("dense_order", "W7 O1", sql="""
select match_id, row_number() over (order by match_date, match_id) - 1 as seq from contest
""")
def dense_order(spark, sf_dir):
    return H.dense_order(contest(spark, sf_dir).select("match_id", "match_date")).select("match_id", "seq")


# Wide-key check of W1 to W3: events per user, sub-day timestamps.
_EV_LONG = """
ev as (select event_id, ts, user_id, value, event_type = 'purchase' as won from events)"""


@query("event_history", "W1 W2 W3 (events by user)", sql=f"""
, {_EV_LONG.strip()},
n as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from ev)
select event_id,
       round(avg(value) over (partition by user_id order by ts, event_id rows between 5 preceding and 1 preceding), 6)
         as value5,
       cast(floor((epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id))) / 86400000000)
            as double) as rest_days,
       cast(rn - 1 - coalesce(max(case when not won then rn end) over (
            partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0)
            as double) as win_streak
from n
""")
def event_history(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "event_type"])
    ev = ev.select("event_id", "ts", "user_id", "value", (F.col("event_type") == "purchase").alias("won"))
    out = H.entity_history(ev, entity="user_id", time="ts", tie="event_id", values=("value",), k=5)
    return out.select("event_id", r6("value5"), "rest_days", "win_streak")
