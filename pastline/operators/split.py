"""Chronological split (F3, F4), split summary and boundary check (A17),
class shares by split (A8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_label(year: str | Column, train_end: int, val_years: tuple[int, int]) -> Column:
    """``train`` up to ``train_end``, ``val`` inside ``val_years``, else
    ``test`` (a null year falls to test, as in the reference)."""
    y = F.col(year) if isinstance(year, str) else year
    return (F.when(y <= train_end, F.lit("train"))
            .when((y >= val_years[0]) & (y <= val_years[1]), F.lit("val"))
            .otherwise(F.lit("test")))


def add_split(df: DataFrame, *, time: str, train_end: int, val_years: tuple[int, int]) -> DataFrame:
    return df.withColumns({"year": F.year(time)}).withColumn(
        "split", split_label("year", train_end, val_years))


def split_summary(df: DataFrame, *, time: str, split: str = "split") -> DataFrame:
    """Rows, share %, first and last time per split, and the boundary
    flag ``max(train) < min(val) and max(val) < min(test)`` on every row."""
    g = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"),
                              F.min(time).alias("first_time"), F.max(time).alias("last_time"))
    # the summary has one row per split label (3 rows): a window over it is free
    w = F.sum("n_rows").over(_all())
    bounds = {s: (F.max(F.when(F.col(split) == s, F.col("first_time"))).over(_all()),
                  F.max(F.when(F.col(split) == s, F.col("last_time"))).over(_all()))
              for s in ("train", "val", "test")}
    clean = (bounds["train"][1] < bounds["val"][0]) & (bounds["val"][1] < bounds["test"][0])
    return g.select(split, "n_rows", F.round(100.0 * F.col("n_rows") / w, 6).alias("share_pct"),
                    "first_time", "last_time", clean.alias("boundary_ok"))


def _all():
    from pyspark.sql import Window
    return Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def class_shares(df: DataFrame, *, by: str, target: str, classes: Sequence[str]) -> DataFrame:
    """Share (%) of each class per group value; columns ``share_<class>``."""
    n = F.count(F.lit(1))
    return df.groupBy(by).agg(
        n.alias("n_rows"),
        *[F.round(100.0 * F.count_if(F.col(target) == c) / n, 6).alias(f"share_{c}") for c in classes])
