"""As-of join (J1), fill-only-if-null (J2), coverage and anti-membership.

Backward, inclusive as-of join: each left row gets the *last* right row of
the same key with ``right_time <= left_time``. Ties on the right side are
broken by ``right_position`` (greatest position wins: "last in file
order"). The last right row wins even when its value is null (the value is
wrapped in a struct, so ``ignoreNulls`` skips only left rows).

Plan: one union of both sides, one shuffle by key and a running ``last``; the
rows of keys with more than ``segment_rows`` of them are cut into segments by
row count, with a carry from earlier segments built from a summary of one row
per segment. No unbounded per-key partition, no range join, no quadratic
candidate set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pastline.operators.scan import BEFORE, SEGMENT, SEGMENT_ROWS, UPTO, carry_window, in_order, local_window, scan
from pastline.sources.scratch import stored


def asof_join(left: DataFrame, right: DataFrame, *, left_key: str, left_time: str,
              right_key: str, right_time: str, values: Sequence[str],
              right_position: Sequence[str] = (), segment_rows: int = SEGMENT_ROWS,
              out: str = "asof") -> DataFrame:
    """All left columns plus struct ``out`` with ``values`` of the matched right
    row (``out`` is null when the key has no right row at or before the time)."""
    pos = F.struct(*[F.col(c) for c in right_position]) if right_position else F.lit(0)
    lcols = left.columns
    # compare times in the left side's type; no cast when both sides agree
    lt = dict(left.dtypes)[left_time]
    rt_col = F.col(right_time) if dict(right.dtypes)[right_time] == lt else F.col(right_time).cast(lt)
    l_part = left.select(
        F.col(left_key).alias("_k"), F.col(left_time).alias("_t"),
        F.lit(1).alias("_side"), F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    r_part = right.select(
        F.col(right_key).alias("_k"), rt_col.alias("_t"),
        F.lit(0).alias("_side"), pos.alias("_p"), F.struct(*[F.col(v) for v in values]).alias("_r")
    ).where(F.col("_k").isNotNull() & F.col("_t").isNotNull())  # matches nothing otherwise
    u = l_part.unionByName(r_part, allowMissingColumns=True)
    order = in_order("_t", "_side", "_p")

    def windows(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_m", F.last("_r", ignorenulls=True).over(local_window(["_k"], order).rowsBetween(*UPTO)))

    def carries(local: DataFrame) -> DataFrame:
        # the last right row of each segment, also of segments with left rows only
        summary = local.groupBy("_k", SEGMENT).agg(
            F.max_by(F.col("_r"), F.when(F.col("_side") == 0, F.struct("_t", "_p"))).alias("_last"))
        return summary.select("_k", SEGMENT, F.last("_last", ignorenulls=True).over(
            carry_window(["_k"]).rowsBetween(*BEFORE)).alias("_c"))

    def finish(j: DataFrame) -> DataFrame:
        # a left row without key or time is kept and matches nothing
        known = F.col("_k").isNotNull() & F.col("_t").isNotNull()
        return j.where(F.col("_side") == 1).select("_l.*", F.when(known, F.coalesce("_m", "_c")).alias(out))

    return scan(u, ["_k"], order, windows=windows, carries=carries, empty={"_c": F.lit(None).cast(dict(u.dtypes)["_r"])},
                finish=finish, segment_rows=segment_rows)


def fill_from(existing: str | Column, joined: Column) -> Column:
    """Keep the existing value, take the joined one only where it is null."""
    e = F.col(existing) if isinstance(existing, str) else existing
    return F.coalesce(e, joined)


def side_rows(df: DataFrame, *, id_col: str, time: str, sides: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per (id, side) with that side's key: ``(id, venue, key, time)``."""
    return (df.select(id_col, time, F.explode(F.array(*[
                F.struct(F.lit(code).alias("venue"), F.col(c).alias("key")) for code, c in sides])).alias("s"))
              .select(id_col, "s.venue", "s.key", time))


#: Rows per (key, time) from which ratings are reduced to the last one of each before they move.
REDUCED_FROM = 4


def last_per_time(right: DataFrame, *, key: str, time: str, values: Sequence[str], position: Sequence[str],
                  reduced_from: int = REDUCED_FROM) -> DataFrame | None:
    """The row of greatest ``position`` per (key, time): no other can be the
    last one at or before any time. Two passes of partial aggregates: the
    greatest first position column per (key, time), which needs no row to
    move, then the rows that have it. None where there are fewer than
    ``reduced_from`` rows per (key, time), which gains nothing."""
    known = right.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    tops = stored(known.groupBy(F.col(key).alias("_key"), F.col(time).alias("_time")).agg(
        F.max(position[0]).alias("_top"), F.count(F.lit(1)).alias("_n")), "tops")
    size = tops.agg(F.count(F.lit(1)).alias("times"), F.sum("_n").alias("rows")).first()
    if (size["rows"] or 0) < reduced_from * size["times"]:
        return None
    j = known.join(tops.drop("_n"), (F.col(key) == F.col("_key")) & (F.col(time) == F.col("_time"))
                   & F.col(position[0]).eqNullSafe(F.col("_top")), "left_semi")
    last = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(c) for c in position]))
    return stored(j.groupBy(key, time).agg(last.alias("_last")).select(key, time, "_last.*"), "last-per-time")


def with_asof(contest: DataFrame, ratings: DataFrame, *, id_col: str = "match_id",
              time: str = "match_date", home: str = "home", away: str = "away",
              r_key: str = "entity", r_time: str = "rating_date", r_value: str = "rating",
              r_position: Sequence[str] = (), segment_rows: int = SEGMENT_ROWS,
              reduced_from: int = REDUCED_FROM) -> DataFrame:
    """J1 for both sides: contest rows with ``home_asof``, ``away_asof``
    (hash-partitioned by the id, ready for key joins; the greatest value where
    an id repeats, none for a null id).

    A value depends on (key, time) alone, so the as-of join runs over the
    distinct ones and the last rating per (key, time); its answers, a small
    table where times are days, meet the contests by that pair."""
    last = last_per_time(ratings, key=r_key, time=r_time, values=[r_value], position=r_position,
                         reduced_from=reduced_from) if r_position else None
    asked = side_rows(contest, id_col=id_col, time=time, sides=[("H", home), ("A", away)]).select("key", time).where(
        F.col("key").isNotNull() & F.col(time).isNotNull()).distinct()
    m = asof_join(stored(asked, "asked"), ratings if last is None else last, left_key="key", left_time=time, right_key=r_key,
                  right_time=r_time, values=[r_value], right_position=r_position if last is None else (),
                  segment_rows=segment_rows)
    m = stored(m.select(F.col("key").alias("_key"), F.col(time).alias("_time"), F.col(f"asof.{r_value}").alias("_value")), "asof")
    out = contest
    for side, name in ((home, "home_asof"), (away, "away_asof")):
        here = m.withColumnsRenamed({"_key": f"_key_{name}", "_time": f"_time_{name}", "_value": name})
        out = out.join(here, (F.col(side) == F.col(f"_key_{name}")) & (F.col(time) == F.col(f"_time_{name}")), "left").drop(
            f"_key_{name}", f"_time_{name}")
    of_id = Window.partitionBy(id_col)
    return out.withColumns({c: F.when(F.col(id_col).isNotNull(), F.max(c).over(of_id)) for c in ("home_asof", "away_asof")})


def asof_fill(contest: DataFrame, ratings: DataFrame, *, home_value: str = "home_rating",
              away_value: str = "away_rating", **kw) -> DataFrame:
    """J1 + J2 for both sides: contest rows with ``{home,away}_asof`` (the
    as-of value) and the two value columns filled only where null."""
    j = with_asof(contest, ratings, **kw)
    return j.withColumns({
        f"{home_value}_before": F.col(home_value), f"{away_value}_before": F.col(away_value),
        home_value: fill_from(home_value, F.col("home_asof")),
        away_value: fill_from(away_value, F.col("away_asof")),
    })


def entity_sets(contest: DataFrame, ratings: DataFrame, *, home: str = "home", away: str = "away",
                r_key: str = "entity") -> tuple[DataFrame, DataFrame]:
    """Distinct contest entities (home union away) and distinct rated entities."""
    ents = (contest.select(F.explode(F.array(F.col(home), F.col(away))).alias("entity")).distinct())
    rated = ratings.select(F.col(r_key).alias("entity")).distinct()
    return ents, rated


def coverage(contest: DataFrame, ratings: DataFrame, **kw) -> DataFrame:
    """|contest entities|, |rated entities|, |both| and coverage % in one
    full outer join of the two distinct-entity sets and one aggregate."""
    ents, rated = entity_sets(contest, ratings, **kw)
    j = ents.withColumn("_c", F.lit(1)).join(rated.withColumn("_r", F.lit(1)), "entity", "full_outer")
    return (j.agg(F.count("_c").alias("contest_entities"), F.count("_r").alias("rated_entities"),
                  F.count_if(F.col("_c").isNotNull() & F.col("_r").isNotNull()).alias("covered_entities"))
             .withColumn("coverage_pct",
                         F.round(100 * F.try_divide(F.col("covered_entities"), F.col("contest_entities")), 6)))


def unrated_rows(rows: DataFrame, ratings: DataFrame, *, key: str, r_key: str = "entity") -> DataFrame:
    """Rows whose entity has no rating at all (anti join on distinct keys)."""
    rated = ratings.select(F.col(r_key).alias(key)).distinct()
    return rows.join(rated, key, "left_anti")
