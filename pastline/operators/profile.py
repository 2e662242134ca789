"""Column profiles and outcome-rate tables.

Each profile is one wide aggregate over the table (partial aggregation on
every task, one tiny final stage), unpivoted into a long table with one
row per column. Distinct counts unpivot the values first and count
distinct ``(column, value)`` pairs, so no per-column ``Expand`` copy of
the table is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F


def _stack(df: DataFrame, names: Sequence[str], fields: Sequence[str],
           keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot a one-row frame of ``{field}__{name}`` columns into one row
    per name (``keep`` columns are repeated on every row)."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), *[F.col(f"{f}__{n}").alias(f) for f in fields])
        for n in names])).alias("s")).select(*keep, "s.*")


def column_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: ``column_name, dtype, n_rows, non_null_pct, n_distinct``."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    prof = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"nn__{c}") for c in cols])
    out = _stack(prof, cols, ["nn"], keep=["_n"])
    vals = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s"))
    nd = (vals.select("s.*").where(F.col("v").isNotNull()).distinct()
          .groupBy("column_name").agg(F.count(F.lit(1)).alias("nd")))
    out = out.join(nd, "column_name", "left").withColumn("nd", F.coalesce("nd", F.lit(0)))
    dtype = F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])])
    return out.select(
        "column_name", F.element_at(dtype, F.col("column_name")).alias("dtype"),
        F.col("_n").alias("n_rows"),
        F.round(100.0 * F.col("nn") / F.col("_n"), 6).alias("non_null_pct"),
        F.col("nd").cast("bigint").alias("n_distinct"))


def table_shape(df: DataFrame, *, time: str, group: str, entities: Sequence[str]) -> DataFrame:
    """A2: rows, columns, first/last time, distinct groups and entities."""
    ents = df.select(F.explode(F.array(*[F.col(e) for e in entities])).alias("e")).distinct()
    a = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"),
               F.max(time).alias("last_time"), F.count_distinct(group).alias("n_groups"))
    n_ent = ents.agg(F.count(F.lit(1))).first()[0]  # one scalar
    return a.withColumns({"n_entities": F.lit(n_ent).cast("bigint"), "n_columns": F.lit(len(df.columns))})


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: ``column_name, null_count, null_pct`` ordered by null % desc (O3)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"nl__{c}") for c in cols])
    return _stack(agg, cols, ["nl"], keep=["_n"]).select(
        "column_name", F.col("nl").alias("null_count"),
        F.round(100.0 * F.col("nl") / F.col("_n"), 6).alias("null_pct"))


def null_totals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3 totals: null cells and their share of all cells."""
    cols = list(cols or df.columns)
    total = sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))
    return df.agg(F.sum(total).alias("null_cells"), (F.count(F.lit(1)) * len(cols)).alias("cells")).withColumn(
        "null_cells_pct", F.round(100.0 * F.col("null_cells") / F.col("cells"), 6))


def null_buckets(profile: DataFrame) -> DataFrame:
    """A4: ``> 50``, ``(20, 50]`` and ``< 5`` % null; 5 to 20 % is reported nowhere."""
    p = F.col("null_pct")
    b = (F.when(p > 50, F.lit(">50")).when((p > 20) & (p <= 50), F.lit("20-50")).when(p < 5, F.lit("<5")))
    return profile.withColumn("bucket", b).where(F.col("bucket").isNotNull())


# ---- A9 / A10 --------------------------------------------------------------

PCTS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def _pname(p: float) -> str:
    return f"p{int(round(p * 100)):02d}"


def describe_block(df: DataFrame, cols: Sequence[str], pcts: Sequence[float] = PCTS,
                   digits: int = 3) -> DataFrame:
    """Count, mean, std (n-1), min, exact percentiles (linear
    interpolation), max, bias-corrected skew and excess kurtosis, % null;
    rounded half-even (T14)."""
    n_all = F.count(F.lit(1))
    aggs = [n_all.alias("_n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"),
                 F.max(x).alias(f"max__{c}"), F.skewness(x).alias(f"g1__{c}"),
                 F.kurtosis(x).alias(f"g2__{c}")]
    wide = df.agg(*aggs)
    fields = ["count", "mean", "std", "min", "max", "g1", "g2"]
    # exact percentiles without a whole column in one aggregation buffer
    from pastline.operators.stats import exact_percentiles
    pq = exact_percentiles(df, cols, pcts).groupBy("column_name").agg(
        F.array(*[F.max(F.when(F.col("p") == float(p), F.col("value"))) for p in pcts]).alias("pc"))
    long = _stack(wide, cols, fields, keep=["_n"]).join(pq, "column_name", "left")
    n = F.col("count").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    # "+ 0.0" turns a rounded -0.0 into 0.0
    r = lambda e, name: (F.bround(e, digits) + F.lit(0.0)).alias(name)
    return long.select(
        "column_name", F.col("count").cast("double").alias("count"), r(F.col("mean"), "mean"),
        r(F.col("std"), "std"), r(F.col("min"), "min"),
        *[r(F.col("pc")[i], _pname(p)) for i, p in enumerate(pcts)],
        r(F.col("max"), "max"), r(skew, "skew"), r(kurt, "kurtosis"),
        r(100.0 * (1 - F.col("count") / F.col("_n")), "pct_null"))


def positive_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of ``c > 0`` among the non-null values of each column."""
    wide = df.agg(*[F.avg((F.col(c) > 0).cast("double")).alias(f"share__{c}") for c in cols])
    return _stack(wide, cols, ["share"]).select("column_name", F.round("share", 6).alias("positive_share"))


# ---- A7 / A12 / A13 / A14 / ST15 ------------------------------------------

def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Per class count and share; imbalance ratio, majority, minority and
    the share-squared baseline on every row (the result has one row per class)."""
    g = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.col("n") / F.sum("n").over(w)
    g = g.withColumn("_share", share)
    return g.select(
        target, "n", F.round("_share", 6).alias("share"),
        F.round(F.max("n").over(w) / F.min("n").over(w), 6).alias("imbalance_ratio"),
        F.max_by(target, F.struct("n", F.col(target))).over(w).alias("majority"),
        F.min_by(target, F.struct("n", F.col(target))).over(w).alias("minority"),
        F.round(F.sum(F.col("_share") * F.col("_share")).over(w), 6).alias("chance_accuracy"))


def class_stats(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Mean and exact median of each feature per class (long form)."""
    long = df.where(F.col(target).isNotNull()).select(target, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    from pastline.operators.stats import exact_percentiles
    means = long.groupBy(target, "s.column_name").agg(F.round(F.avg("s.v"), 6).alias("mean"))
    med = exact_percentiles(df.where(F.col(target).isNotNull()), cols, [0.5], by=[target]).select(
        target, "column_name", F.round("value", 6).alias("median"))
    return means.join(med, [target, "column_name"], "left")


def class_monotone(stats: DataFrame, target: str, order: Sequence[str]) -> DataFrame:
    """ST15: class means side by side and whether they decrease in ``order``."""
    piv = stats.groupBy("column_name").agg(*[
        F.max(F.when(F.col(target) == c, F.col("mean"))).alias(f"mean_{c}") for c in order])
    mono = F.lit(True)
    for a, b in zip(order, order[1:]):
        mono = mono & (F.col(f"mean_{a}") > F.col(f"mean_{b}"))
    return piv.withColumn("monotone", mono)


def right_closed_bin(x: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """label of ``(lo, hi]``; below the first edge or above the last: null.
    (A value equal to the lowest edge falls in no bin.)"""
    labels = labels or [f"({lo}, {hi}]" for lo, hi in zip(edges, edges[1:])]
    out = None
    for (lo, hi), lab in zip(zip(edges, edges[1:]), labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def bin_order(x: Column, edges: Sequence[float]) -> Column:
    out = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def rate_table(df: DataFrame, *, x: Column, edges: Sequence[float], labels: Sequence[str] | None,
               target: str, classes: Sequence[str]) -> DataFrame:
    """A13/ST14: per bin the share of each class and n; an absent class is
    null (not 0), rows outside every bin are dropped."""
    b = df.where(x.isNotNull()).select(
        right_closed_bin(x, edges, labels).alias("bin"), bin_order(x, edges).alias("bin_order"),
        F.col(target).alias("_y")).where(F.col("bin").isNotNull())
    n = F.count(F.lit(1))
    return b.groupBy("bin", "bin_order").agg(
        n.alias("n"),
        *[F.when(F.count_if(F.col("_y") == c) > 0, F.round(
            (F.count_if(F.col("_y") == c) / F.count(F.col("_y"))).cast("double"), 6)).alias(f"rate_{c}") for c in classes])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``value, n`` ordered by count desc."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def null_rates(grouped: GroupedData, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A5: rows and the % of nulls of each column per group (one partial aggregate)."""
    n = F.count(F.lit(1))
    return grouped.agg(n.alias("n_rows"), *[F.round(100.0 * (n - F.count(c)) / n, 6).alias(a) for c, a in zip(cols, names)])


def feature_summary(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Per column the nulls, their % and the mean of the rest (one pass)."""
    n = F.count(F.lit(1))
    wide = df.agg(*[a for c in cols for a in (
        (n - F.count(c)).alias(f"nulls__{c}"), (100.0 * (n - F.count(c)) / n).alias(f"pct__{c}"), F.avg(F.col(c).cast("double")).alias(f"mean__{c}"))])
    long = _stack(wide, cols, ["nulls", "pct", "mean"])
    return long.select("column_name", F.col("nulls").cast("bigint").alias("n_null"),
                       F.round("pct", digits).alias("null_pct"), F.round("mean", digits).alias("mean"))
