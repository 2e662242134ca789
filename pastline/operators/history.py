"""Past-only history features.

* :func:`to_entity_rows` turns one contest row into two entity rows
  (home side, away side) with one ``explode`` - one scan, no union.
* :func:`entity_history` computes, per entity and strictly before each row,
  the trailing mean of the previous ``k`` rows, whole days since the
  previous row and the current win streak, with the segmented scan of
  :mod:`pastline.operators.scan` (one shuffle of the long table).
* :func:`to_contest_rows` pivots the entity rows back to one row per
  contest (``home_*`` / ``away_*``), :func:`pair_history` adds head-to-head
  history per unordered pair, :func:`dense_order` numbers rows in
  chronological order without a single-partition window over the rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pastline.operators.scan import (
    BEFORE, SEGMENT, SEGMENT_ROWS, UPTO, carry_window, in_order, local_window, scan, whole_days_between,
)
from pastline.sources.scratch import stored


def to_entity_rows(df: DataFrame, *, id_col: str = "match_id", time: str = "match_date",
                   home: str = "home", away: str = "away",
                   home_score: str = "home_score", away_score: str = "away_score",
                   result: Column | None = None) -> DataFrame:
    """Two rows per contest, ``(id, time, entity, venue, gf, ga, won)``.

    ``won`` is true only for the side named by the result (``H``/``A``);
    a draw or a missing result is a non-win, as in the reference.
    """
    res = result if result is not None else (
        F.when(F.col(home_score) > F.col(away_score), F.lit("H"))
        .when(F.col(home_score) < F.col(away_score), F.lit("A"))
        .when(F.col(home_score) == F.col(away_score), F.lit("D")))
    side = lambda venue, ent, gf, ga: F.struct(
        F.lit(venue).alias("venue"), F.col(ent).alias("entity"),
        F.col(gf).cast("double").alias("gf"), F.col(ga).cast("double").alias("ga"),
        F.coalesce(res == F.lit(venue), F.lit(False)).alias("won"))
    return (df.select(id_col, time, F.explode(F.array(
                side("H", home, home_score, away_score),
                side("A", away, away_score, home_score))).alias("s"))
              .select(id_col, time, "s.*"))


def entity_history(long: DataFrame, *, entity: str = "entity", time: str = "match_date",
                   tie: str = "match_id", values: Sequence[str] = ("gf", "ga"),
                   won: str = "won", k: int = 5, segment_rows: int = SEGMENT_ROWS,
                   suffix: str | None = None) -> DataFrame:
    """W1 to W3 per entity, strictly before each row.

    Adds ``{v}{k}`` (mean of the previous ``k`` non-null values, null when
    none), ``rest_days`` (whole days since the entity's previous row, null
    for its first row), ``win_streak`` (consecutive wins just before the row)
    and ``seq_in_entity`` (0-based position within the entity).
    Order within an entity is ``(time, tie)``, nulls last; ``tie`` must be
    unique. Entities of more than ``segment_rows`` rows are cut by row count.
    """
    suffix = str(k) if suffix is None else suffix
    order = in_order(time, tie)
    halo_type = f"array<struct<_lrn:int,{','.join(f'`{v}`:{dict(long.dtypes)[v]}' for v in values)}>>"

    def windows(df: DataFrame) -> DataFrame:
        w = local_window([entity], order)
        local = df.select(
            "*",
            F.row_number().over(w).alias("_lrn"),
            F.lag(time).over(w).alias("_lprev"),
            *[F.sum(v).over(w.rowsBetween(-k, -1)).alias(f"_ls_{v}") for v in values],
            *[F.count(v).over(w.rowsBetween(-k, -1)).alias(f"_lc_{v}") for v in values],
        )
        return local.withColumn("_lloss", F.max(F.when(~F.col(won), F.col("_lrn"))).over(w.rowsBetween(*BEFORE)))

    def carries(local: DataFrame) -> DataFrame:
        tail = F.struct(F.col("_lrn"), *[F.col(v) for v in values])
        sizes = local.groupBy(entity, SEGMENT).agg(
            F.max("_lrn").alias("n"),
            F.max(F.when(~F.col(won), F.col("_lrn"))).alias("last_loss"),
            F.max_by(F.col(time), F.col("_lrn")).alias("last_t"))
        # the last k rows of each segment: by place from the end, so no segment is collected
        back = Window.partitionBy(entity, SEGMENT).orderBy(F.desc("_lrn"))
        tails = local.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= k).groupBy(entity, SEGMENT).agg(
            F.sort_array(F.collect_list(tail)).alias("tail")).withColumnsRenamed({entity: "_tail_entity", SEGMENT: "_tail_segment"})
        summary = sizes.join(tails, sizes[entity].eqNullSafe(tails["_tail_entity"]) & (sizes[SEGMENT] == tails["_tail_segment"]))
        ws = carry_window([entity])
        summary = summary.withColumn("cum", F.sum("n").over(ws.rowsBetween(*UPTO)))
        loss_state = F.when(F.col("last_loss").isNotNull(),
                            F.struct((F.col("n") - F.col("last_loss")).alias("suffix"), F.col("cum").alias("cum")))
        return summary.select(
            entity, SEGMENT,
            (F.col("cum") - F.col("n")).alias("_before"),
            F.lag("last_t").over(ws).alias("_cprev"),
            F.last(loss_state, ignorenulls=True).over(ws.rowsBetween(*BEFORE)).alias("_closs"),
            F.flatten(F.collect_list("tail").over(ws.rowsBetween(-k, -1))).alias("_halo"),
        ).select(
            entity, SEGMENT, "_before", "_cprev",
            F.when(F.col("_closs").isNull(), F.col("_before"))
             .otherwise(F.col("_closs.suffix") + F.col("_before") - F.col("_closs.cum")).alias("_cstreak"),
            # keep only the last k rows of the segments before
            F.slice("_halo", F.greatest(F.size("_halo") - k + 1, F.lit(1)), k).alias("_halo"),
        )

    def finish(j: DataFrame) -> DataFrame:
        prev = F.coalesce(F.col("_lprev"), F.col("_cprev"))
        need = F.greatest(F.lit(k) - (F.col("_lrn") - 1), F.lit(0))
        part = F.slice("_halo", F.greatest(F.size("_halo") - need + 1, F.lit(1)), need)
        out = {
            "seq_in_entity": (F.col("_before") + F.col("_lrn") - 1).cast("bigint"),
            "rest_days": whole_days_between(F.col(time), prev).cast("double"),
            "win_streak": F.when(F.col("_lloss").isNotNull(), F.col("_lrn") - 1 - F.col("_lloss"))
                           .otherwise(F.col("_lrn") - 1 + F.col("_cstreak")).cast("double"),
        }
        for v in values:
            hs = F.aggregate(part, F.lit(0.0), lambda acc, x: acc + F.coalesce(x[v].cast("double"), F.lit(0.0)))
            hc = F.aggregate(part, F.lit(0), lambda acc, x: acc + F.when(x[v].isNull(), 0).otherwise(1))
            n = F.col(f"_lc_{v}") + hc
            out[f"{v}{suffix}"] = F.when(n > 0, (F.coalesce(F.col(f"_ls_{v}"), F.lit(0.0)) + hs) / n)
        drop = [c for c in j.columns if c.startswith("_")]
        return j.withColumns(out).drop(*drop)

    empty = {"_before": F.lit(0).cast("bigint"), "_cprev": F.lit(None).cast(dict(long.dtypes)[time]),
             "_cstreak": F.lit(0).cast("bigint"), "_halo": F.array().cast(halo_type)}
    return scan(long, [entity], order, windows=windows, carries=carries, empty=empty, finish=finish, segment_rows=segment_rows)


def to_contest_rows(long: DataFrame, *, id_col: str = "match_id", venue: str = "venue",
                    stats: Sequence[str], sides: Sequence[tuple[str, str]] = (("H", "home"), ("A", "away"))
                    ) -> DataFrame:
    """One row per contest, ``{side}_{stat}`` columns (one shuffle by id,
    of the rows as they are: a contest's two sides come from different tasks,
    so a partial aggregate before it would only hold a task's rows in memory)."""
    aggs = [F.max(F.when(F.col(venue) == code, F.col(s))).alias(f"{name}_{s}")
            for code, name in sides for s in stats]
    return long.select(id_col, venue, *stats).repartition(F.col(id_col)).groupBy(id_col).agg(*aggs)


def history_values(contest: DataFrame, *, k: int = 5, segment_rows: int = SEGMENT_ROWS,
                   id_col: str = "match_id", time: str = "match_date") -> DataFrame:
    """U1 + W1..W3 + A18: one row per contest id with ``home_/away_`` gf{k},
    ga{k}, rest_days, win_streak (hash-partitioned by the id)."""
    long = to_entity_rows(contest, id_col=id_col, time=time)
    feats = entity_history(long, time=time, tie=id_col, k=k, segment_rows=segment_rows)
    return to_contest_rows(feats, id_col=id_col, stats=[f"gf{k}", f"ga{k}", "rest_days", "win_streak"])


def contest_history(contest: DataFrame, *, k: int = 5, segment_rows: int = SEGMENT_ROWS,
                    id_col: str = "match_id", time: str = "match_date") -> DataFrame:
    """U1 + W1..W3 + A18 + J3: contest rows with the history columns (left
    join on the contest id)."""
    wide = history_values(contest, k=k, segment_rows=segment_rows, id_col=id_col, time=time)
    return contest.join(wide, id_col, "left")


def pair_history(df: DataFrame, *, home: str = "home", away: str = "away",
                 time: str = "match_date", tie: str = "match_id",
                 home_score: str = "home_score", away_score: str = "away_score",
                 segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Head-to-head history of the unordered pair, before each row.

    ``h2h_played`` earlier meetings (0 when none); ``h2h_home_winrate`` share
    of earlier meetings won by the current home side at any venue, draws in
    the denominator (null when none); ``h2h_avg_goals`` mean total goals of
    earlier meetings (null when none). All are prefix sums, so the carry of a
    heavy pair is a plain sum over its earlier segments; all other pairs are
    plain windows.
    """
    lo, hi = F.least(home, away), F.greatest(home, away)
    winner = (F.when(F.col(home_score) > F.col(away_score), F.col(home))
              .when(F.col(home_score) < F.col(away_score), F.col(away)))
    df = df.withColumns({
        "_lo": lo, "_hi": hi, "_one": F.lit(1),
        "_g": (F.col(home_score) + F.col(away_score)).cast("double"),
        "_wlo": F.coalesce((winner == lo).cast("int"), F.lit(0)),
        "_whi": F.coalesce((winner == hi).cast("int"), F.lit(0)),
    })
    keys, order = ["_lo", "_hi"], in_order(time, tie)
    sums = ["_one", "_g", "_wlo", "_whi"]

    def windows(rows: DataFrame) -> DataFrame:
        w = local_window(keys, order).rowsBetween(*BEFORE)
        return rows.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_l{c}") for c in sums])

    def carries(local: DataFrame) -> DataFrame:
        summary = local.groupBy(*keys, SEGMENT).agg(*[F.sum(c).alias(c) for c in sums])
        ws = carry_window(keys).rowsBetween(*BEFORE)
        return summary.select(*keys, SEGMENT, *[F.coalesce(F.sum(c).over(ws), F.lit(0)).alias(f"_c{c}") for c in sums])

    def finish(j: DataFrame) -> DataFrame:
        tot = {c: F.col(f"_l{c}") + F.col(f"_c{c}") for c in sums}
        played = tot["_one"]
        home_wins = F.when(F.col(home) == F.col("_lo"), tot["_wlo"]).otherwise(tot["_whi"])
        out = j.withColumns({
            "h2h_played": played.cast("double"),
            "h2h_home_winrate": F.when(played > 0, home_wins / played),
            "h2h_avg_goals": F.when(played > 0, tot["_g"] / played),
        })
        return out.drop(*[c for c in out.columns if c.startswith("_")])

    return scan(df, keys, order, windows=windows, carries=carries, empty={f"_c{c}": F.lit(0) for c in sums}, finish=finish, segment_rows=segment_rows)


def dense_order(df: DataFrame, *, time: str = "match_date", tie: str | Sequence[str] = "match_id",
                out: str = "seq", buckets: int | None = None,
                then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """0-based dense row number in ``(time, *tie)`` order, nulls last.

    ``tie`` is one column or several, of any ordered types; rows equal in all
    of them are numbered in an arbitrary order. The rows are range-partitioned
    by the order columns, sorted inside their ranges and stored, in one
    exchange of them; a row's number is its place in its range plus the rows
    of the ranges before, one number per range, kept as a literal. A hot time
    is split by the ties. ``buckets`` sets the number of ranges (the session's
    shuffle partitions otherwise). ``then`` turns the ordered rows into the
    ones to store, row by row: what it adds takes no part in the exchange.
    """
    order = [F.col(c).asc_nulls_last() for c in (time, *([tie] if isinstance(tie, str) else tie))]
    ranged = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    # an id given after the sort holds the range (the bits above 33) and the place in it
    at = F.monotonically_increasing_id()
    ranged = ranged.sortWithinPartitions(*order).withColumn("_at", at)
    ranged = stored(ranged if then is None else then(ranged), "ranges")
    held = F.shiftright("_at", 33)
    sizes = {r["_range"]: r["n"] for r in ranged.groupBy(held.alias("_range")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per range
    before = [0, *itertools.accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0)))]
    start = F.get(F.array(*[F.lit(n).cast("bigint") for n in before]), held.cast("int"))
    return ranged.withColumn(out, start + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")
