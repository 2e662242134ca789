"""Matrix statistics (ST7 to ST10, M7, M9, F9, F10, A19, A20).

The distributed part is always one aggregate (means, ``covar_samp`` or
``corr`` per pair) over the complete-case rows. The d x d result (d = number
of columns, schema metadata) is inverted / decomposed on the driver with
numpy, and applied back to the rows as a literal linear or quadratic column
expression - whole-stage codegen, no UDF, no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pastline.functions.special import chi2_ppf, elbow_index
from pastline.operators.stats import pairs


@dataclass
class Moments:
    cols: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with no null in ``cols``."""
    return df.na.drop(subset=list(cols))


def moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """ST7: mean vector and n-1 covariance on complete cases (one aggregate)."""
    cols = list(cols)
    cc = complete_cases(df, cols)
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_samp(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"c_{i}_{j}")
             for i in range(len(cols)) for j in range(i, len(cols))]
    r = cc.agg(*aggs).first()
    d = len(cols)
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = r[f"c_{i}_{j}"]
    return Moments(cols, r["_n"], np.array([r[f"m_{i}"] for i in range(d)]), cov)


def covariance_table(m: Moments) -> list[tuple[str, str, float]]:
    return [(a, b, float(m.cov[m.cols.index(a), m.cols.index(b)]))
            for a, b in [(c, c) for c in m.cols] + pairs(m.cols)]


def quadratic_form(cols: Sequence[str], mean: np.ndarray, prec: np.ndarray) -> Column:
    """``(x - mu)^T P (x - mu)`` as one column expression."""
    d = [F.col(c).cast("double") - F.lit(float(mu)) for c, mu in zip(cols, mean)]
    terms = []
    for i in range(len(cols)):
        terms.append(F.lit(float(prec[i, i])) * d[i] * d[i])
        for j in range(i + 1, len(cols)):
            terms.append(F.lit(float(2 * prec[i, j])) * d[i] * d[j])
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def mahalanobis(df: DataFrame, cols: Sequence[str], *, ridge: float = 1e-6, q: float = 0.999,
                m: Moments | None = None) -> tuple[DataFrame, float]:
    """ST8: complete-case rows with ``d2`` (squared distance with a ridge on
    the covariance) and ``mv_outlier`` (``d2`` above the chi-square quantile)."""
    m = m or moments(df, cols)
    prec = np.linalg.inv(m.cov + ridge * np.eye(len(cols)))
    thr = chi2_ppf(q, len(cols))
    out = complete_cases(df, cols).withColumn("d2", quadratic_form(cols, m.mean, prec))
    return out.withColumn("mv_outlier", F.col("d2") > F.lit(thr)), thr


def dominant_column(zcols: Sequence[str], names: Sequence[str]) -> Column:
    """name of the column with the greatest |z| (first on ties)."""
    arr = F.array(*[F.struct(F.abs(F.col(z)).alias("a"), F.lit(-i).alias("neg_i"), F.lit(n).alias("name"))
                    for i, (z, n) in enumerate(zip(zcols, names))])
    return F.array_max(arr)["name"]


def first_match(rules: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """the name of the first rule whose SQL condition holds, else ``otherwise``."""
    name = F.lit(otherwise)
    for condition, label in reversed(rules):
        name = F.when(F.expr(condition), F.lit(label)).otherwise(name)
    return name


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson matrix on complete cases (one aggregate)."""
    cc = complete_cases(df, cols)
    r = cc.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
                 for i, (a, b) in enumerate(pairs(cols))]).first()
    d = len(cols)
    c = np.eye(d)
    for i, (a, b) in enumerate(pairs(cols)):
        ia, ib = cols.index(a), cols.index(b)
        c[ia, ib] = c[ib, ia] = r[f"r{i}"]
    return c


def vif(df: DataFrame, cols: Sequence[str]) -> list[tuple[str, float]]:
    """ST10: variance inflation = diagonal of the inverse correlation matrix."""
    cols = list(cols)
    inv = np.linalg.inv(correlation_matrix(df, cols))
    return [(c, float(inv[i, i])) for i, c in enumerate(cols)]


@dataclass
class PcaFit:
    cols: list[str]
    mean: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray  # rows = components, unit length, largest variance first

    @property
    def ratio(self) -> np.ndarray:
        return self.eigenvalues / self.eigenvalues.sum()

    def k_for(self, share: float = 0.95) -> int:
        cum = np.cumsum(self.ratio)
        return int(np.argmax(cum >= share - 1e-12) + 1)

    def k_elbow(self) -> int:
        return elbow_index(list(np.cumsum(self.ratio))) + 1

    def project(self, df: DataFrame, k: int, keep: Sequence[str] = (), prefix: str = "PC") -> DataFrame:
        """M9: centred projection on the first k components, other columns kept."""
        outs = []
        for i in range(k):
            e = None
            for c, mu, w in zip(self.cols, self.mean, self.components[i]):
                t = (F.col(c) - F.lit(float(mu))) * F.lit(float(w))
                e = t if e is None else e + t
            outs.append(e.alias(f"{prefix}{i + 1}"))
        return df.select(*keep, *outs)


def pca_fit(df: DataFrame, cols: Sequence[str]) -> PcaFit:
    """M7: eigen-decomposition of the n-1 covariance of ``cols`` (one
    aggregate), components sorted by variance; signs are arbitrary."""
    m = moments(df, cols)
    vals, vecs = np.linalg.eigh(m.cov)
    order = np.argsort(vals)[::-1]
    vals = np.clip(vals[order], 0.0, None)
    vecs = vecs[:, order].T
    # deterministic signs: largest |loading| positive
    for i in range(len(vecs)):
        j = int(np.argmax(np.abs(vecs[i])))
        if vecs[i, j] < 0:
            vecs[i] = -vecs[i]
    return PcaFit(list(cols), m.mean, vals, vecs)


def pca_fit_vectors(df: DataFrame, vec_col: str, d: int) -> PcaFit:
    """M7 for wide inputs: the covariance comes from Spark ML's PCA (a Gramian
    ``treeAggregate`` over the vector column, no per-pair aggregate
    expressions); eigenvalues = explained-variance ratios x trace of the
    n-1 covariance (from the column variances)."""
    from pyspark.ml.feature import PCA as SparkPCA
    from pyspark.ml.stat import Summarizer
    model = SparkPCA(k=d, inputCol=vec_col).fit(df.select(vec_col))
    stats = df.select(Summarizer.metrics("mean", "variance").summary(F.col(vec_col)).alias("s")).first()["s"]
    mean = np.array(stats["mean"].toArray())
    trace = float(np.sum(stats["variance"].toArray()))
    ratio = np.array(model.explainedVariance.toArray())
    comps = np.array(model.pc.toArray()).T  # rows = components
    for i in range(len(comps)):
        j = int(np.argmax(np.abs(comps[i])))
        if comps[i, j] < 0:
            comps[i] = -comps[i]
    return PcaFit([f"{vec_col}[{i}]" for i in range(d)], mean, ratio * trace, comps)
