"""Skew-safe ordered scans ("segmented scans") for per-key running state.

A window ``partitionBy(key).orderBy(time)`` sends every row of a key to one
task, which is right for a key of a few thousand rows and wrong for one that
holds a third of the table. So the rows per key are counted first:

* a key of at most ``segment_rows`` rows is one segment: a plain window, one
  shuffle, nothing stored and no summary;
* the rows of the heavier keys are range-partitioned by (key, order) with
  sampled bounds into segments of about ``segment_rows`` rows, whatever their
  times are: a key that is hot within one day, or at one instant, is cut as
  well. A local window runs over ``(key, segment)``, and a carry-in per
  (key, segment) comes from a summary with one row per segment of a heavy
  key, which is joined back (the planner broadcasts it where it is small).

The counting pass is one partial aggregate; heavy keys, of which there are at
most ``rows / segment_rows``, are stored and met by semi and anti joins.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pastline.sources.scratch import stored

SEGMENT = "_segment"
SEGMENT_ROWS = 1 << 16


def in_order(*cols: str) -> list[Column]:
    """Ascending order of the columns, nulls last."""
    return [F.col(c).asc_nulls_last() for c in cols]


def local_window(keys: list[str], order: list[Column]) -> WindowSpec:
    return Window.partitionBy(*keys, SEGMENT).orderBy(*order)


def carry_window(keys: list[str]) -> WindowSpec:
    """Over the segments of a heavy key, in order."""
    return Window.partitionBy(*keys).orderBy(SEGMENT)


def _met(df: DataFrame, heavy: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = heavy.withColumnsRenamed({c: f"_heavy_{c}" for c in keys})
    cond = F.lit(True)
    for c in keys:
        cond = cond & df[c].eqNullSafe(renamed[f"_heavy_{c}"])
    return df.join(renamed, cond, how)


def cut_by_rows(df: DataFrame, keys: list[str], order: list[Column], segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """``df`` in two parts with a ``SEGMENT`` column: the light keys, each one
    segment, and the heavy keys cut by row count (None without such)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > segment_rows)
    heavy = stored(counts, "heavy-keys")
    total = heavy.agg(F.sum("_n")).first()[0]
    whole = F.lit(0).alias(SEGMENT)
    if not total:
        return df.select("*", whole), None
    heavy = heavy.drop("_n")
    ranges = math.ceil(total / segment_rows) + 1
    cut = _met(df, heavy, keys, "left_semi").repartitionByRange(ranges, *[F.col(c).asc_nulls_last() for c in keys], *order)
    return _met(df, heavy, keys, "left_anti").select("*", whole), cut.withColumn(SEGMENT, F.spark_partition_id())


def scan(df: DataFrame, keys: list[str], order: list[Column], *, windows: Callable[[DataFrame], DataFrame],
         carries: Callable[[DataFrame], DataFrame], empty: dict[str, Column], finish: Callable[[DataFrame], DataFrame],
         segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """A segmented scan: ``finish`` of the local ``windows`` and the carries.

    ``carries`` maps the local rows of the heavy keys to one row per (key,
    segment) with the carry columns; ``empty`` has their values where nothing
    comes before. Building the result runs the counting job and, with heavy
    keys, stores their local rows and the carries.
    """
    light, heavy = cut_by_rows(df, keys, order, segment_rows)
    out = finish(windows(light).withColumns(empty))
    if heavy is None:
        return out
    local = stored(windows(heavy), "segments")  # read by the summary and the carry join
    on = [*keys, SEGMENT]
    # stored, one row per segment: by its size the planner sees that the local rows need not move to meet it
    carry = stored(carries(local), "carries").withColumnsRenamed({c: f"_carry_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & local[c].eqNullSafe(carry[f"_carry_{c}"])
    return out.unionByName(finish(local.join(carry, cond, "left").drop(*[f"_carry_{c}" for c in on])))


BEFORE = (Window.unboundedPreceding, -1)
UPTO = (Window.unboundedPreceding, 0)


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Elapsed whole 24-hour periods (floor), not calendar-day difference."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(86_400_000_000))
