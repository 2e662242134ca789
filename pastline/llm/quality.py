"""Quality rules with risk-controlled cutoffs.

Each rule compares one statistic of a text with a cutoff. Which cutoff a rule
takes in a stratum (a language) is decided on labelled documents: for a
ladder of cutoffs, from lenient to strict, the rule rejects ``k`` of the ``n``
good labelled documents of the stratum, and the cutoff is certified when the
exact binomial probability of at most ``k`` rejections, were the true false
rejection rate ``alpha / rules``, is at most ``delta / (strata * rules)``.
A ladder is tested in its fixed order and ends at its first failure, so with
probability ``1 - delta`` no certified cutoff of any stratum or rule is wrong,
and the rules together reject at most a share ``alpha`` of a stratum's good
documents. Among certified cutoffs a rule takes the one with the best
``bad rejected - penalty * good rejected``, the most lenient of equals, and
none where that is not above zero. A stratum with too few labels certifies
nothing and keeps what the base rules keep.

All of it is DataFrame expressions. The texts are read once; the statistics
of all documents are stored and both the labelled counts and the verdicts are
taken from there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.llm.common import SPACES, UPPER, bind, source_table, stored, words_of

SYMBOLS = "#*$%&|<>"
ALPHA, DELTA, PENALTY = 0.02, 0.05, 10.0
#: rule -> (statistic as SQL over the stored columns, +1: rejects above / -1: rejects below, cutoffs from lenient to strict)
RULES: dict[str, tuple[str, int, tuple[float, ...]]] = {
    "symbols": ("n_symbols / nullif(n_words, 0)", 1, (5.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    "long_words": ("word_chars / nullif(n_words, 0)", 1, (50.0, 30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
    "short_words": ("word_chars / nullif(n_words, 0)", -1, (1.25, 1.5, 1.75, 2.0, 2.25, 2.5, 2.75, 3.0)),
    "dup_lines": ("n_dup_lines / nullif(n_lines, 0)", 1, (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", 1, (0.49, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    "capitals": ("n_upper / nullif(word_chars, 0)", 1, (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
}


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The statistics of each text; null text has none of anything.

    ``n_repeat_words`` sorts (64-bit hash of the 3-word window, position) and
    marks the words of windows that equal a neighbour: n log n in the words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    one = docs.select(*keep, text.alias("text"), words_of(F.col("text")).alias("words"), lines.alias("lines"))
    n = F.size("words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i"))))
    squeezed = F.translate("text", SPACES, "")
    two = one.select(
        *keep, n.cast("long").alias("n_words"), F.length(squeezed).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", UPPER, ""))).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>"))).alias("windows"))

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, j: (x.h == F.get(s, j - 1).h) | (x.h == F.get(s, j + 1).h))
        return F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x.i, x.i + 1, x.i + 2)))))

    return two.withColumn("n_repeat_words", F.coalesce(bind(F.col("windows"), repeated), F.lit(0)).cast("long")).drop("windows")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_factorial(x: Column) -> Column:
    """ln x! for whole x >= 0: Stirling's series at x + 9, stepped back; good to 1e-13."""
    z = x.cast("double") + 9
    steps = F.lit(0.0)
    for j in range(1, 9):
        steps = steps + F.log(x.cast("double") + j)
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k), X ~ Bin(n, p), exactly summed from its largest term down; 1 from the mean on."""
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.when(k >= 1, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
                        lambda a, j: bind(a.t * j * (1 - p) / ((n - j + 1) * p), lambda t: F.struct(t.alias("t"), (a.s + t).alias("s"))),
                        lambda a: a.s)
    return F.when(k < n * p, top * total).otherwise(F.lit(1.0))


def certified_cutoffs(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                      penalty: float = PENALTY) -> DataFrame:
    """(stratum, rule, cutoff) from stored statistics and (doc_id, quality) labels.

    A document labelled more than once counts as good only if all its labels
    do; labels other than 0 and 1 are ignored. Documents that fail the base
    rules are outside the promise and are left out.
    """
    told = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("good"))
    known = stats.filter(~base_failed()).join(told, "doc_id")
    rejected = []
    for rule, (stat, sign, ladder) in RULES.items():
        for step, cut in enumerate(ladder):
            hit = F.coalesce(F.expr(stat) * sign > cut * sign, F.lit(False))
            rejected.append(F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(cut).alias("cutoff"),
                                     F.count(F.when(hit & (F.col("good") == 1), 1)).alias("k"),
                                     F.count(F.when(hit & (F.col("good") == 0), 1)).alias("bad")))
    # one row per stratum: every count in a single partial aggregate
    counted = known.groupBy("stratum").agg(F.sum("good").alias("n"), F.array(*rejected).alias("steps"))
    strata = stats.select("stratum").distinct().groupBy().agg(F.count("*").alias("strata"))
    tested = (counted.crossJoin(F.broadcast(strata))  # one row
              .select("stratum", "n", "strata", F.explode("steps").alias("x"))
              .select("stratum", "n", "x.*", (binomial_tail(F.col("x.k"), F.col("n"), alpha / len(RULES))
                                              > delta / len(RULES) / F.col("strata")).alias("failed")))
    ladders = tested.groupBy("stratum", "rule").agg(
        F.min(F.when(F.col("failed"), F.col("step"))).alias("end"),
        F.collect_list(F.struct((F.col("bad") - penalty * F.col("k")).alias("gain"), (-F.col("step")).alias("lenient"), "cutoff")).alias("all"))
    best = F.array_max(F.filter("all", lambda x: (x.gain > 0) & (-x.lenient < F.coalesce(F.col("end"), F.lit(99)))))
    return ladders.select("stratum", "rule", best.cutoff.alias("cutoff")).filter("cutoff is not null")


def _stratum() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))


def _judged(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``stats`` with base_failed, failed_rules and kept."""
    rows = stats.join(cutoffs, "stratum", "left")  # one row per stratum: planned by its stored size
    failed = F.array_compact(F.array(*[F.when(F.expr(stat) * sign > F.col(f"cut_{r}") * sign, F.lit(r)) for r, (stat, sign, _) in RULES.items()]))
    return (rows.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def _cutoffs(stats: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    """A row of certified cutoffs per stratum, stored."""
    cuts = certified_cutoffs(stats, labels, alpha, delta)
    return stored(cuts.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]), "quality-cutoffs")


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text, lang; others are ignored).

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, failed_rules (names of the certified
    rules that reject it). Null text has no words and fails the base rules.
    A null lang is a stratum of its own. Repeated rows are judged alike.
    Without labels, kept is ``not base_failed``.
    """
    stats = stored(text_statistics(docs.select("doc_id", "text", _stratum().alias("stratum")), "doc_id", "stratum"), "quality-stats")
    return _judged(stats, _cutoffs(stats, labels, alpha, delta)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "failed_rules").alias("failed_rules"))


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    The rows are stored beside their statistics, so no text is shuffled and
    no statistic is taken twice.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text", _stratum().alias("stratum"))
    stats = stored(text_statistics(rows, "__row", "doc_id", "stratum"), "quality-rows")
    return _judged(stats, _cutoffs(stats.drop("__row"), labels, alpha, delta)).filter("kept").select("__row.*")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(source_table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                         source_table(spark, sf_dir, "labels", "doc_id", "quality"))


def _sql() -> str:
    """The same in DuckDB: windows counted by grouping, the tail by ``lgamma`` terms."""
    p, d = ALPHA / len(RULES), DELTA / len(RULES)
    rungs = " UNION ALL ".join(f"SELECT '{r}' AS rule, {i} AS step, {c}::DOUBLE AS cutoff, {s} AS sign" for r, (_, s, cuts) in RULES.items() for i, c in enumerate(cuts))
    value = "CASE rule " + " ".join(f"WHEN '{r}' THEN {x}" for r, (x, _, _) in RULES.items()) + " END"
    return f"""
WITH t AS (SELECT doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM t),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM g),
m AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM h WHERE c > 1) GROUP BY doc_id),
s AS (SELECT doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM t LEFT JOIN m USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
rungs AS ({rungs}),
told AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
v AS (SELECT b.*, rule, step, cutoff, coalesce({value} * sign > cutoff * sign, false) AS hit FROM b, rungs),
c AS (SELECT stratum, rule, step, cutoff, sum(good) AS n, count(*) FILTER (hit AND good = 1) AS k, count(*) FILTER (hit AND good = 0) AS bad
      FROM v JOIN told USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
p AS (SELECT *, CASE WHEN k < n * {p!r} THEN list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
      + j * ln({p!r}) + (n - j) * ln(1 - {p!r})))) ELSE 1 END AS tail FROM c),
e AS (SELECT *, min(step) FILTER (tail > {d!r} / (SELECT count(DISTINCT stratum) FROM s)) OVER (PARTITION BY stratum, rule) AS stop FROM p),
best AS (SELECT stratum, rule, arg_max(cutoff, (bad - {PENALTY} * k) * 1000 - step) AS cutoff FROM e
         WHERE step < coalesce(stop, 99) AND bad - {PENALTY} * k > 0 GROUP BY ALL),
f AS (SELECT doc_id, string_agg(rule, ',' ORDER BY array_position([{', '.join(f"'{r}'" for r in RULES)}], rule)) AS failed_rules
      FROM v JOIN best USING (stratum, rule, cutoff) WHERE hit GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules FROM b LEFT JOIN f USING (doc_id)
"""


SQL = _sql()
