"""Statistics over columns (ST1 to ST6, ST11 to ST13, W8, F11, J9).

* Correlations are one aggregate of ``corr(a, b)`` per pair ``i < j``
  (Spark skips a row when either side is null: pairwise-complete).
* Average ranks (W8) never sort a whole column in one task: values are
  counted per distinct value (ties, however hot, collapse into one row), the
  counts are cut into sampled ranges of about equal size, and what lies below
  a range comes from a table with one row per key and range. Where the values
  lie makes no difference: one far value is one more row of the last range.
* Percentiles are exact (``percentile``, linear interpolation).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pastline.operators.profile import _stack
from pastline.sources.scratch import stored

BEFORE = (Window.unboundedPreceding, -1)


def pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """The theta self-pairing ``i < j`` of a column list (schema metadata)."""
    return list(itertools.combinations(cols, 2))


def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ST1: ``a, b, r`` for every pair (pairwise-complete rows)."""
    ps = pairs(cols)
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r__{i}")
                    for i, (a, b) in enumerate(ps)])
    long = _stack(wide, [str(i) for i in range(len(ps))], ["r"])
    names = F.create_map(*[F.lit(x) for i, (a, b) in enumerate(ps) for x in (str(i), f"{a}|{b}")])
    nm = F.element_at(names, F.col("column_name"))
    return long.select(F.split(nm, r"\|")[0].alias("a"), F.split(nm, r"\|")[1].alias("b"), F.col("r"))


def redundant_pairs(corrs: DataFrame, high: float = 0.9, moderate: float = 0.7) -> DataFrame:
    """ST3: pairs with ``|r| > high`` ('high') or ``moderate < |r| <= high``."""
    a = F.abs(F.col("r"))
    level = F.when(a > high, F.lit("high")).when((a > moderate) & (a <= high), F.lit("moderate"))
    return corrs.withColumn("level", level).where(F.col("level").isNotNull()).orderBy(F.desc(a), "a", "b")


def point_biserial(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """ST4: r of each feature with a 0/1 flag (a null flag counts as 0)."""
    y = F.coalesce(flag, F.lit(False)).cast("double")
    wide = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(f"r__{c}") for c in cols])
    return _stack(wide, cols, ["r"]).orderBy(F.desc(F.abs(F.col("r"))), "column_name")


def value_prefix(long: DataFrame, *, keys: Sequence[str], value: str, sums: Sequence[str] = (),
                 ranges: int | None = None) -> DataFrame:
    """Per key and distinct value: ``n`` rows, the sums of ``sums`` columns at
    that value, the same quantities summed over all strictly smaller values
    (``before_n``, ``before_<s>``), and the key's rows ``total_n``.

    The counts per (key, value) are range-partitioned by (key, value) with
    sampled bounds and stored; equal values are one row, so they are in one
    range, and a hot key is cut into many. The running sums inside a range
    start from the sums of the key's ranges before, of which there are at
    most ``ranges`` (the session's shuffle partitions otherwise) per key.
    Keys may come from the data; rows with a null key are left out.
    """
    keys = list(keys)
    cols = ["n", *sums]
    counts = long.dropna(subset=keys).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums])
    order = [*keys, value]
    ranged = counts.repartitionByRange(ranges, *order) if ranges else counts.repartitionByRange(*order)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "value-ranges")
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    of_key = Window.partitionBy(*keys)
    below = of_key.orderBy("_range").rowsBetween(*BEFORE)
    totals = totals.select(*keys, "_range", F.sum("_t_n").over(of_key).alias("total_n"), *[
        F.coalesce(F.sum(f"_t_{c}").over(below), F.lit(0)).alias(f"_off_{c}") for c in cols])
    inside = Window.partitionBy("_range", *keys).orderBy(value).rowsBetween(*BEFORE)
    within = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_cum_{c}") for c in cols])
    return within.join(totals, [*keys, "_range"]).select(
        *keys, value, *cols, *[(F.col(f"_off_{c}") + F.col(f"_cum_{c}")).alias(f"before_{c}") for c in cols], "total_n")


def average_ranks(long: DataFrame, *, keys: Sequence[str], value: str = "v",
                  ranges: int | None = None) -> DataFrame:
    """Average rank (ties share the mean of their positions, 1-based) of
    every distinct ``value`` within each key: ``keys..., value, n, rank``."""
    vp = value_prefix(long, keys=keys, value=value, ranges=ranges)
    return vp.select(*keys, value, "n", (F.col("before_n") + (F.col("n") + 1) / 2.0).alias("rank"))


def null_masks(df: DataFrame, cols: Sequence[str]) -> tuple[dict[str, str], set[tuple[str, str]]]:
    """Each column's representative among the columns with nulls in the same
    rows, and the pairs (a, b) of representatives with ``a`` present in every
    row in which ``b`` is. One aggregate; its one row has a count per ordered
    pair of columns (schema metadata)."""
    ordered = list(itertools.permutations(cols, 2))
    row = df.agg(*[F.count_if(F.col(a).isNull() & F.col(b).isNotNull()).alias(f"m{i}")
                   for i, (a, b) in enumerate(ordered)]).first()
    covers = {p for i, p in enumerate(ordered) if row[i] == 0}  # a is present wherever b is
    of: dict[str, str] = {}
    for c in cols:
        of[c] = next((of[x] for x in of if (x, c) in covers and (c, x) in covers), c)
    return of, {(of[a], of[b]) for a, b in covers if of[a] != of[b]}


def spearman_pairs(df: DataFrame, cols: Sequence[str], ranges: int | None = None) -> DataFrame:
    """ST2: Spearman r per pair, ranks taken on each pair's complete rows.

    The ranks of a column depend on its partner only through the rows in
    which the partner is null. So columns are grouped by their null rows, and
    a column is ranked once per mask: once for all partners that are present
    wherever it is, and once per other group. The table is copied once, a
    cell per (column, mask); the ranks meet their rows again by value, and
    all pairs are one aggregate over rows of ranks.
    """
    cols = list(cols)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, rho double")
    of, covers = null_masks(df, cols)
    free = lambda a, b: of[a] == of[b] or (of[b], of[a]) in covers  # noqa: E731 - b's nulls take no row from a
    cells: dict[tuple[str, str], int] = {}
    for a, b in itertools.permutations(cols, 2):
        cells.setdefault((a, "" if free(a, b) else of[b]), len(cells))
    rows = stored(df.select(F.monotonically_increasing_id().alias("_id"), *[F.col(c).cast("double").alias(c) for c in cols]), "rank-rows")
    long = rows.select("_id", F.explode(F.array(*[
        F.struct(F.lit(i).alias("cell"), (F.col(a) if not m else F.when(F.col(m).isNotNull(), F.col(a))).alias("v"))
        for (a, m), i in cells.items()])).alias("s")).select("_id", "s.*").where(F.col("v").isNotNull())
    ranks = average_ranks(long.select("cell", "v"), keys=["cell"], value="v", ranges=ranges).select("cell", "v", "rank")
    wide = long.join(ranks, ["cell", "v"]).groupBy("_id").agg(
        *[F.max(F.when(F.col("cell") == i, F.col("rank"))).alias(f"r{i}") for i in cells.values()])
    rank = lambda a, b: F.col(f"r{cells[a, '' if free(a, b) else of[b]]}")
    ps = pairs(cols)
    got = wide.agg(*[F.corr(rank(a, b), rank(b, a)).alias(f"rho__{i}") for i, (a, b) in enumerate(ps)])
    return got.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"rho__{i}").alias("rho"))
                                          for i, (a, b) in enumerate(ps)])).alias("s")).select("s.*")


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float, float, float]]:
    """Per column the exact Q1, Q3 and the fences at k*IQR (one row per
    column and quartile is read back); a column without values has nulls."""
    qs = {(r["column_name"], r["p"]): r["value"] for r in exact_percentiles(df, cols, [0.25, 0.75]).collect()}
    out = {}
    for c in cols:
        q1, q3 = qs.get((c, 0.25)), qs.get((c, 0.75))
        out[c] = (None,) * 4 if q1 is None else (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def iqr_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """ST5: Q1, Q3, fences at k*IQR, strict outlier count and % of non-null.
    Two passes: exact quartiles, then one counting aggregate with the fences
    as literals; only the reported figures are rounded."""
    fences = iqr_fences(df, cols, k)
    aggs = []
    for c in cols:
        _, _, lo, hi = fences[c]
        x = F.col(c)
        aggs += [F.count(x).alias(f"nn__{c}"), F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"out__{c}")]
    wide = df.agg(*aggs).withColumns({f"{f}__{c}": F.lit(v).cast("double") for c in cols
                                      for f, v in zip(("q1", "q3", "lo", "hi"), fences[c])})
    long = _stack(wide, cols, ["q1", "q3", "lo", "hi", "nn", "out"])
    return long.select("column_name", *[F.round(F.col(f).cast("double"), 6).alias(f) for f in ("q1", "q3", "lo", "hi")],
                       F.col("out").alias("n_outliers"),
                       F.round(100.0 * F.col("out") / F.col("nn"), 6).alias("pct_outliers"))


def iqr_row_flag(cols: Sequence[str], fences: dict[str, tuple[float, float, float, float]]) -> Column:
    """ST6: true when the row is outside the exact fence in at least one column."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.col(c) < F.lit(fences[c][2])) | (F.col(c) > F.lit(fences[c][3]))
    return cond


def zscores(df: DataFrame, cols: Sequence[str], ddof: int = 1, prefix: str = "z_") -> DataFrame:
    """``(x - mean) / sd`` with the n-1 (ddof=1) or n (ddof=0) deviation;
    the one-row statistics become literals (no join)."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[sd(c).alias(f"s_{c}") for c in cols]).first()
    return df.withColumns({f"{prefix}{c}": (F.col(c) - F.lit(st[f"m_{c}"])) / F.lit(st[f"s_{c}"]) for c in cols})


def unit_histogram(df: DataFrame, col: str) -> DataFrame:
    """ST11: counts in unit bins centred on integers."""
    return (df.where(F.col(col).isNotNull())
            .groupBy(F.floor(F.col(col) + 0.5).alias("center")).agg(F.count(F.lit(1)).alias("n")))


def width_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """ST11: ``bins`` equal-width bins from min to max (last bin closed)."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    w = (hi - lo) / bins if hi is not None and hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumns({"lo": F.lit(lo) + F.col("bin") * F.lit(w), "hi": F.lit(lo) + (F.col("bin") + 1) * F.lit(w)}))


def kde_curve(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0, at_once: int = 25) -> DataFrame:
    """ST12: Gaussian kernel density on a grid, Scott's bandwidth
    (``n^(-1/5)`` times the n-1 deviation).

    Every distinct value, weighted by its count, adds to every grid point: no
    reach, nothing cut. A row is copied once per ``at_once`` grid points and
    those are as many sums of one partial aggregate, so only ``grid`` numbers
    per task are shuffled.
    """
    x = F.col(col).cast("double")
    n, sd, lo, hi = df.agg(F.count(x), F.stddev_samp(x), F.min(x), F.max(x)).first()
    bw = sd * n ** (-1 / 5)
    g0, g1 = lo - cut * bw, hi + cut * bw
    step = (g1 - g0) / (grid - 1)
    vc = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    lots = -(-grid // at_once)
    part = vc.select("v", "c", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot")).withColumn(
        "z0", (F.lit(g0) + F.col("lot") * F.lit(at_once * step) - F.col("v")) / F.lit(bw))
    z = lambda j: F.col("z0") + F.lit(j * step / bw)
    sums = part.groupBy("lot").agg(*[F.sum(F.col("c") * F.exp(-0.5 * z(j) * z(j))).alias(f"s{j}") for j in range(at_once)])
    got = sums.select("lot", F.posexplode(F.array(*[F.col(f"s{j}") for j in range(at_once)])).alias("j", "s"))
    i = (F.col("lot") * at_once + F.col("j")).cast("int")
    return got.select(i.alias("i"), (F.col("s") / F.lit(n * bw * (2 * 3.141592653589793) ** 0.5)).alias("density"),
                      (F.lit(g0) + i * F.lit(step)).alias("x")).where(F.col("i") < grid)


def box_stats(df: DataFrame, *, value: str, by: str) -> DataFrame:
    """ST13: per group Q1, median, Q3, whiskers (most extreme values inside
    1.5 IQR) and the count outside them. Quartiles first, then one pass."""
    x = F.col(value).cast("double")
    pq = exact_percentiles(df.where(x.isNotNull()), [value], [0.25, 0.5, 0.75], by=[by])
    qs = pq.groupBy(by).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                              for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qs = qs.withColumns({"_lo": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                         "_hi": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    # one row per group value: broadcast only where the planner finds it small
    j = df.where(x.isNotNull()).select(by, x.alias("_x")).join(qs, by)
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_fliers"))


def exact_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], *, by: Sequence[str] = (),
                      ranges: int | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (as ``percentile`` /
    ``quantile_cont``), without holding a group's values in one task.

    Values are ranked with :func:`value_prefix`; for each (group, column) and
    p the values at the two ranks ``floor`` and ``ceil`` of ``(n-1)p`` are
    the distinct values whose cumulative range covers them, found row by row
    from the running counts without a join. Nulls and NaN are left out, as
    are rows with a null group. Returns ``by..., column_name, p, value``.
    """
    by = list(by)
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")
    ).select(*by, "s.*").where(F.col("v").isNotNull() & ~F.isnan("v"))
    keys = [*by, "column_name"]
    vp = value_prefix(long, keys=keys, value="v", ranges=ranges)
    h = lambda p: (F.col("total_n") - 1) * F.lit(float(p))
    here = lambda r: (r >= F.col("before_n")) & (r < F.col("before_n") + F.col("n"))
    asked = F.array(*[F.struct(F.lit(float(p)).alias("p"), h(p).alias("h"), here(F.floor(h(p))).alias("low"), here(F.ceil(h(p))).alias("high")) for p in probs])
    hit = vp.select(*keys, "v", F.explode(F.filter(asked, lambda x: x.low | x.high)).alias("x"))
    g = hit.groupBy(*keys, "x.p", "x.h").agg(F.max(F.when(F.col("x.low"), F.col("v"))).alias("_lo"),
                                             F.max(F.when(F.col("x.high"), F.col("v"))).alias("_hi"))
    frac = F.col("h") - F.floor(F.col("h"))
    return g.select(*keys, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac).alias("value"))
