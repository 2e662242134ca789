"""Projections, filters and predicates.

All of these are narrow column expressions: no shuffle, and Catalyst pushes
the filters and the column list into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_null_target(df: DataFrame, target: str | Sequence[str]) -> DataFrame:
    """Rows whose target (all given columns) is known."""
    cols = [target] if isinstance(target, str) else list(target)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The column contract (keep-list); everything else is pruned."""
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise ValueError(f"contract columns missing: {missing}")
    return df.select(*keep)


def taxonomy_table(spark: SparkSession, taxonomy: Mapping[str, str]) -> DataFrame:
    """Metadata table ``(column_name, column_group)`` from a literal mapping."""
    rows = [(c, g) for c, g in taxonomy.items()]
    return spark.createDataFrame(rows, "column_name string, column_group string")


def classify_columns(profile: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Attach the group of each profiled column; unknown -> 'unclassified'.
    The taxonomy has one row per known column (bounded by the schema width)."""
    return (profile.join(F.broadcast(taxonomy), "column_name", "left")
            .withColumn("column_group", F.coalesce("column_group", F.lit("unclassified"))))


def drop_decisions(classified: DataFrame, *, keep_groups: Sequence[str],
                   null_pct: str = "null_pct", max_null_pct: float = 50.0) -> DataFrame:
    """keep/drop decision with a reason, ordered by null % (desc)."""
    g = F.col("column_group")
    reason = (F.when(g == "key", F.lit("key"))
              .when(g == "target", F.lit("target"))
              .when(g.isin(*keep_groups) & (F.col(null_pct) <= max_null_pct), F.lit("known before the contest"))
              .when(g.isin(*keep_groups), F.lit("too many nulls"))
              .when(g == "outcome_raw", F.lit("history input only"))
              .when(g == "unclassified", F.lit("unclassified"))
              .otherwise(F.lit("known only afterwards")))
    keep = reason.isin("key", "target", "known before the contest", "history input only")
    return (classified.withColumns({"decision": F.when(keep, F.lit("keep")).otherwise(F.lit("drop")),
                                    "reason": reason})
            .orderBy(F.desc(null_pct), "column_name"))


def differences(pairs: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """P5: ``{name: a - b}`` (null when either side is null)."""
    return {name: (F.col(a) - F.col(b)).cast("double") for name, (a, b) in pairs.items()}


def member_flag(c: str, values: Sequence[str]) -> Column:
    """1 when the value is in the set, else 0."""
    return F.col(c).isin(*values).cast("int")


def any_null_flag(*cols: str) -> Column:
    """1 when any of the columns is null."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond.cast("int")


def outcome_from_scores(home: str, away: str) -> Column:
    """F8: ``H``/``D``/``A`` from two scores (null when a score is null)."""
    return (F.when(F.col(home) > F.col(away), F.lit("H"))
            .when(F.col(home) < F.col(away), F.lit("A"))
            .when(F.col(home) == F.col(away), F.lit("D")))


def winner(home: str, away: str, result: Column) -> Column:
    """F8: the winning entity, null on a draw."""
    return F.when(result == "H", F.col(home)).when(result == "A", F.col(away))


def sentinel_counts(df: DataFrame, checks: Mapping[str, tuple[str, float]]) -> DataFrame:
    """P10: one aggregate of ``count_if(col == sentinel)`` and ``max(col)``.
    ``checks`` maps an output prefix to ``(column, sentinel value)``."""
    aggs = []
    for name, (c, s) in checks.items():
        aggs.append(F.count_if(F.col(c) == F.lit(s)).alias(f"{name}_count"))
        aggs.append(F.max(c).cast("double").alias(f"{name}_max"))
    return df.agg(*aggs)


def severity(c: str | Column, high: float, mid: float, labels=("high", "moderate", "low")) -> Column:
    """three-level tag by thresholds (``> high``, ``> mid``, else)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col > high, F.lit(labels[0])).when(col > mid, F.lit(labels[1])).otherwise(F.lit(labels[2]))
