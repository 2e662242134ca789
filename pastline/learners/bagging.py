"""Out-of-bag error against the number of trees.

Spark's forests do not expose their bags, so the bags are explicit: a
seeded hash of (row id, tree) draws a Poisson(1) count per row and tree;
each tree is a one-tree forest fitted with that count as row weight. Rows
with count 0 are out of bag for that tree and collect its class
probabilities. One pass over the rows scores all trees and gives the error
after each reported number of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.learners.data import FEATURES, LABEL, hash_uniform
from pastline.learners.models import _depth, _item, n_classes
from pastline.learners.parallel import pmap

#: beyond this count a Poisson(1) draw is rarer than one step of a 53-bit uniform
MOST = 18


def poisson_one(u):
    """Inverse CDF of Poisson(1) on a 53-bit uniform column."""
    cdf, out, p = 0.0, None, math.exp(-1.0)
    for k in range(MOST):
        cdf += p
        cond = u < cdf
        out = F.when(cond, F.lit(float(k))) if out is None else out.when(cond, F.lit(float(k)))
        p = p / (k + 1)
    return out.otherwise(F.lit(float(MOST)))


def oob_curve(train: DataFrame, *, id_col: str, n_trees: int, report_at: Sequence[int], max_depth: int = 10,
              min_leaf: int = 1, features: str = "sqrt", seed: int = 42, at_once: int = 4) -> list[tuple]:
    k = n_classes(train)
    d = train.select(id_col, FEATURES, LABEL)
    drawn = [poisson_one(hash_uniform(F.col(id_col), F.lit(t), F.lit(seed))) for t in range(n_trees)]

    def tree(t: int):
        rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol="_bw", numTrees=1,
                                    bootstrap=False, subsamplingRate=1.0, maxDepth=_depth(max_depth),
                                    minInstancesPerNode=min_leaf, featureSubsetStrategy=features, seed=seed + t)
        return rf.fit(d.withColumn("_bw", drawn[t]).where(F.col("_bw") > 0))

    # the bags are hashes of the ids, so no tree waits for another and no frame is carried between them
    fitted = pmap(tree, range(n_trees), workers=at_once)
    sc = d
    for t, m in enumerate(fitted):
        sc = m.transform(sc).withColumn(f"_o{t}", F.when(drawn[t] == 0, vector_to_array("probability"))).drop(
            "rawPrediction", "probability", "prediction")
    sc = sc.drop(FEATURES, id_col)
    aggs, shown = [], [t for t in range(1, n_trees + 1) if t in report_at]
    for n in shown:
        votes = [sum((F.when(F.col(f"_o{t}").isNotNull(), _item(f"_o{t}", c)).otherwise(0.0) for t in range(n)), F.lit(0.0)) for c in range(k)]
        voted = F.lit(False)
        for t in range(n):
            voted = voted | F.col(f"_o{t}").isNotNull()
        best = F.array_max(F.array(*[F.struct(v.alias("v"), F.lit(-c).alias("n")) for c, v in enumerate(votes)]))
        aggs += [F.avg(F.when(voted, (-best["n"] != F.col(LABEL)).cast("double"))).alias(f"err{n}"), F.count_if(voted).alias(f"n{n}")]
    row = sc.agg(*aggs).first() if aggs else None  # one pass for the whole curve
    return [(n, float(row[f"err{n}"]), int(row[f"n{n}"])) for n in shown]
