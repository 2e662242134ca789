"""Train-only preparation.

``Preparer.fit`` computes every statistic on the train rows only and
returns a :class:`Prepared` model whose ``transform`` is pure column
expressions (no join, no shuffle): the fitted state is a few scalars per
column and one median per group value. It is bounded by the number of
categories, which the one-hot encoding needs on the driver anyway, so it
is small by construction and serialisable as JSON (S7).

Two actions in ``fit``: (1) medians, (2) train mean / population deviation
of the imputed columns plus the completeness check over all rows (M5).
Medians are exact (linear interpolation).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pastline.operators.contract import any_null_flag, differences


@dataclass
class Prepared:
    group_col: str
    rating_cols: list[str]
    group_medians: dict[str, float | None]
    global_median: float | None
    constants: dict[str, float]
    medians: dict[str, float | None]
    diffs: dict[str, list[str]]
    continuous: list[str]
    flags: list[str]
    missing_flag: str
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    categories: list[str] = field(default_factory=list)

    # ---- M1 + P7 + P5 -------------------------------------------------
    def impute(self, df: DataFrame) -> DataFrame:
        out = {self.missing_flag: any_null_flag(*self.rating_cols)}
        gm = F.create_map(*[F.lit(x) for k, v in self.group_medians.items() if v is not None
                            for x in (k, float(v))]) if any(
            v is not None for v in self.group_medians.values()) else None
        for c in self.rating_cols:
            by_group = F.element_at(gm, F.col(self.group_col).cast("string")) if gm is not None else F.lit(None)
            out[c] = F.coalesce(F.col(c), by_group, F.lit(self.global_median).cast("double"))
        for c, v in self.constants.items():
            out[c] = F.coalesce(F.col(c), F.lit(float(v)))
        for c, v in self.medians.items():
            out[c] = F.coalesce(F.col(c), F.lit(v).cast("double"))
        df = df.withColumns(out)
        return df.withColumns(differences({k: tuple(v) for k, v in self.diffs.items()}))

    # ---- M2 + M3 + M4 -------------------------------------------------
    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        imp = self.impute(df)
        num = [((F.col(c) - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(f"num__{c}")
               for c in self.continuous]
        flags = [F.col(c).cast("double").alias(f"flags__{c}") for c in self.flags]
        # unseen or null categories: all zeros
        cats = [F.coalesce((F.col(self.group_col) == F.lit(v)).cast("double"), F.lit(0.0))
                .alias(f"cat__{self.group_col}_{v}") for v in self.categories]
        return imp.select(*keep, *num, *flags, *cats)

    def feature_names(self) -> list[str]:
        return ([f"num__{c}" for c in self.continuous] + [f"flags__{c}" for c in self.flags]
                + [f"cat__{self.group_col}_{v}" for v in self.categories])

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> Prepared:
        return Prepared(**json.loads(s))


@dataclass
class Preparer:
    group_col: str = "division"
    split_col: str = "split"
    train_value: str = "train"
    rating_cols: Sequence[str] = ("home_rating", "away_rating")
    constants: Mapping[str, float] = field(default_factory=dict)
    median_cols: Sequence[str] = ()
    diffs: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    continuous: Sequence[str] = ()
    flags: Sequence[str] = ()
    missing_flag: str = "rating_missing"

    def medians(self, df: DataFrame) -> tuple[dict, float | None, dict]:
        """A15 + A16 + U2: pooled per-group and global rating medians and
        per-column medians, all on train rows only."""
        tr = df.where(F.col(self.split_col) == self.train_value)
        pooled = tr.select(self.group_col, F.explode(F.array(*[F.col(c) for c in self.rating_cols])).alias("_e"))
        # exact medians in one pass (no group's values in one aggregation buffer):
        # pooled ratings per group, pooled ratings overall, and each median column
        from pastline.operators.stats import exact_percentiles
        g = F.col(self.group_col).cast("string")
        long = pooled.select(F.explode(F.array(
            F.struct(F.lit("group").alias("_kind"), g.alias("_g"), F.col("_e").alias("_v")),
            F.struct(F.lit("all").alias("_kind"), F.lit("").alias("_g"), F.col("_e").alias("_v")))).alias("s"))
        if self.median_cols:
            long = long.unionByName(tr.select(F.explode(F.array(*[
                F.struct(F.lit("col").alias("_kind"), F.lit(c).alias("_g"), F.col(c).cast("double").alias("_v"))
                for c in self.median_cols])).alias("s")))
        rows = exact_percentiles(long.select("s.*"), ["_v"], [0.5], by=["_kind", "_g"]).collect()
        # one row per category + one + one per median column
        groups = {r["_g"]: r["value"] for r in rows if r["_kind"] == "group"}
        glob = next((r["value"] for r in rows if r["_kind"] == "all"), None)
        meds = {c: None for c in self.median_cols}
        meds.update({r["_g"]: r["value"] for r in rows if r["_kind"] == "col"})
        return groups, glob, meds

    def fit(self, df: DataFrame) -> Prepared:
        groups, glob, meds = self.medians(df)
        p = Prepared(self.group_col, list(self.rating_cols), groups, glob, dict(self.constants), meds,
                     {k: list(v) for k, v in self.diffs.items()}, list(self.continuous), list(self.flags),
                     self.missing_flag)
        imp = p.impute(df)
        train = F.col(self.split_col) == self.train_value
        aggs = []
        for c in self.continuous:
            x = F.when(train, F.col(c))
            aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}"),
                     F.count_if(F.col(c).isNull()).alias(f"n_{c}")]
        cats = (df.where(train & F.col(self.group_col).isNotNull())
                .select(self.group_col).distinct().orderBy(self.group_col))
        stats = imp.agg(*aggs).first().asDict()
        nulls = {c: stats[f"n_{c}"] for c in self.continuous if stats[f"n_{c}"]}
        if nulls:  # M5
            raise ValueError(f"nulls left in continuous columns after imputation: {nulls}")
        p.means = {c: float(stats[f"m_{c}"]) for c in self.continuous}
        # zero deviation scales by 1, as the reference scaler does
        p.scales = {c: float(stats[f"s_{c}"]) or 1.0 for c in self.continuous}
        p.categories = [r[0] for r in cats.collect()]  # category list, alphabetical
        return p
