"""Preparation state as a table.

:class:`~pastline.operators.prepare.Preparer` carries its fitted state as
literals, which is right for a few dozen groups. Here the state is rows
``kind, name, grp, value``: what there is once per group value (its median, its
one-hot index) is never read to the driver, whatever the number of groups, and
is joined back by the planner, which broadcasts it where it measures it as
small. What there is once per column (means, deviations, column medians,
constants) is bounded by the schema and becomes literals. The table is written
as Parquet and read back by path alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.operators.contract import any_null_flag, differences
from pastline.operators.history import dense_order
from pastline.operators.prepare import Preparer
from pastline.operators.stats import exact_percentiles
from pastline.sources.scratch import stored

PER_GROUP = ("group_median", "category")


def _row(kind: str, name, grp, value):
    lit = lambda x: F.lit(x) if x is None or isinstance(x, str) else x
    return F.struct(F.lit(kind).alias("kind"), lit(name).cast("string").alias("name"), lit(grp).cast("string").alias("grp"),
                    value.cast("double").alias("value"))


def scalars(state: DataFrame) -> dict[tuple[str, str], float]:
    """(kind, name) -> value of what there is once per column."""
    rows = state.where(~F.col("kind").isin(*PER_GROUP)).collect()
    return {(r["kind"], r["name"]): r["value"] for r in rows}


def _with_groups(df: DataFrame, state: DataFrame, spec: Preparer) -> DataFrame:
    """``df`` with ``_median`` and ``_index`` of its group (null for an unknown or null one)."""
    known = state.where(F.col("kind").isin(*PER_GROUP)).groupBy(F.col("grp").alias("_grp")).agg(
        F.max(F.when(F.col("kind") == "group_median", F.col("value"))).alias("_median"),
        F.max(F.when(F.col("kind") == "category", F.col("value"))).cast("int").alias("_index"))
    return df.join(known, F.col(spec.group_col).cast("string") == F.col("_grp"), "left").drop("_grp")


def _imputed(joined: DataFrame, one: dict[tuple[str, str], float], spec: Preparer) -> DataFrame:
    out = {spec.missing_flag: any_null_flag(*spec.rating_cols)}
    lit = lambda kind, name: F.lit(one.get((kind, name))).cast("double")
    for c in spec.rating_cols:
        out[c] = F.coalesce(F.col(c), F.col("_median"), lit("global_median", ""))
    for c in spec.constants:
        out[c] = F.coalesce(F.col(c), lit("constant", c))
    for c in spec.median_cols:
        out[c] = F.coalesce(F.col(c), lit("median", c))
    return joined.withColumns(out).withColumns(differences({k: tuple(v) for k, v in spec.diffs.items()}))


def fit_state(df: DataFrame, spec: Preparer) -> DataFrame:
    """The state of ``spec`` fitted on the train rows of ``df``, stored.

    Kinds: group_median (per group value), global_median, median (per
    column), constant, mean and scale (per continuous column, over the
    imputed train rows; no deviation scales by 1), category (per group value,
    its place in ascending order). Raises where a continuous column keeps
    nulls after imputation (M5).
    """
    train = F.col(spec.split_col) == spec.train_value
    tr = df.where(train)
    g = F.col(spec.group_col).cast("string")
    values = [F.struct(F.lit(k).alias("_kind"), F.lit(n).alias("_n"), grp.alias("_g"), F.col(c).cast("double").alias("_v"))
              for c in spec.rating_cols for k, n, grp in (("group_median", "", g), ("global_median", "", F.lit("")))]
    values += [F.struct(F.lit("median").alias("_kind"), F.lit(c).alias("_n"), F.lit("").alias("_g"), F.col(c).cast("double").alias("_v"))
               for c in spec.median_cols]
    long = tr.select(F.explode(F.array(*values)).alias("s")).select("s.*")
    medians = exact_percentiles(long, ["_v"], [0.5], by=["_kind", "_n", "_g"]).select(
        F.col("_kind").alias("kind"), F.col("_n").alias("name"),
        F.when(F.col("_kind") == "group_median", F.col("_g")).alias("grp"), "value")
    names = tr.where(g.isNotNull()).select(g.alias("grp")).distinct()
    categories = dense_order(names, time="grp", tie=[], out="place").select(
        F.lit("category").alias("kind"), F.lit("").alias("name"), "grp", F.col("place").cast("double").alias("value"))
    spark = df.sparkSession
    constants = spark.createDataFrame([("constant", c, None, float(v)) for c, v in spec.constants.items()],
                                      "kind string, name string, grp string, value double")
    first = stored(medians.unionByName(categories).unionByName(constants), "preparation")

    imputed = _imputed(_with_groups(df, first, spec), scalars(first), spec)
    aggs = []
    for c in spec.continuous:
        x = F.when(train, F.col(c))
        aggs += [F.avg(x).alias(f"mean__{c}"), F.stddev_pop(x).alias(f"scale__{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls__{c}")]
    wide = stored(imputed.agg(*aggs), "preparation-scales")
    row = wide.first()
    left = {c: row[f"nulls__{c}"] for c in spec.continuous if row[f"nulls__{c}"]}
    if left:
        raise ValueError(f"nulls left in continuous columns after imputation: {left}")
    scales = wide.select(F.explode(F.array(*[r for c in spec.continuous for r in (
        _row("mean", c, None, F.col(f"mean__{c}")),
        _row("scale", c, None, F.when(F.col(f"scale__{c}") == 0, 1.0).otherwise(F.col(f"scale__{c}"))))])).alias("s")).select("s.*")
    return first.unionByName(scales)


def write_state(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def impute(df: DataFrame, state: DataFrame, spec: Preparer) -> DataFrame:
    """M1 + P5 + P7: ``df`` with its missing values filled from the state; all columns stay."""
    return _imputed(_with_groups(df, state, spec), scalars(state), spec).drop("_median", "_index")


def transform(df: DataFrame, state: DataFrame, spec: Preparer, keep: Sequence[str] = ()) -> DataFrame:
    """M1 + M2: ``keep``, the scaled ``num__`` columns, the ``flags__`` and
    ``category``, the place of the row's group among the categories (their
    number for an unknown or null group)."""
    one = scalars(state)
    n = state.where(F.col("kind") == "category").count()
    imputed = _imputed(_with_groups(df, state, spec), one, spec)
    num = [((F.col(c) - F.lit(one["mean", c])) / F.lit(one["scale", c])).alias(f"num__{c}") for c in spec.continuous]
    flags = [F.col(c).cast("double").alias(f"flags__{c}") for c in spec.flags]
    return imputed.select(*keep, *num, *flags, F.coalesce("_index", F.lit(n)).cast("double").alias("category"))


def assemble(x: DataFrame, state: DataFrame, out: str = "features") -> DataFrame:
    """M3 + M4: one vector of the ``num__`` and ``flags__`` columns and the
    one-hot category. The category part is sparse: its size is the number of
    categories, a row holds one entry of it, an unknown group none."""
    n = state.where(F.col("kind") == "category").count()
    if not n:
        return VectorAssembler(inputCols=[c for c in x.columns if c.startswith(("num__", "flags__"))], outputCol=out).transform(x)
    sized = x.sparkSession.createDataFrame([(float(n),)], "category double")  # the last place, of unknown groups, has no entry
    encoder = OneHotEncoder(inputCol="category", outputCol="_one_hot", dropLast=True).fit(sized)
    cols = [c for c in x.columns if c.startswith(("num__", "flags__"))]
    return VectorAssembler(inputCols=[*cols, "_one_hot"], outputCol=out).transform(encoder.transform(x)).drop("_one_hot")
