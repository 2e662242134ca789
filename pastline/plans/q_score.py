"""Scoring queries: P12, I1 to I4, L14."""

from __future__ import annotations

from pyspark.sql import functions as F

from pastline import presets
from pastline.operators import score as SC
from pastline.plans import stages as S
from pastline.plans.registry import query, r6
from pastline.sources.fixtures import contest

_TEST = (f"year(match_date) > {presets.FIXTURE_VAL_YEARS[1]}")


@query("neutral_probability", "P12 I1 I2", sql=S.features_sql() + f"""
, t as (select match_id, home, away, home_rating, away_rating from feat
        where split = 'test' and home_rating is not null and away_rating is not null),
o as (
  select match_id, 0 as orientation, home as h, away as a, home_rating as rh, away_rating as ra, home as fa, away as fb from t
  union all
  select match_id, 1, away, home, away_rating, home_rating, home, away from t),
w as (select *, 1 / (1 + pow(10.0, (5000.0 - (rh + 60.0 - ra)) / 20000.0)) as p2,
              1 / (1 + pow(10.0, (5000.0 + (rh + 60.0 - ra)) / 20000.0)) as p0 from o),
s as (select match_id, max(fa) as side_a, max(fb) as side_b,
             avg(case when orientation = 0 then p2 else p0 end) as p_first,
             avg(case when orientation = 0 then p0 else p2 end) as p_second, avg(greatest(1 - p0 - p2, 0)) as p_draw
      from w group by match_id)
select match_id, round(p_first, 6) as p_first, round(p_second, 6) as p_second, round(p_draw, 6) as p_draw,
       side_a, side_b, case when p_first >= p_second then side_a else side_b end as pick
from s""")
def neutral_probability(spark, sf_dir):
    f = S.features(spark, sf_dir).where((F.col("split") == "test") & F.col("home_rating").isNotNull()
                                        & F.col("away_rating").isNotNull())
    sw = SC.swap_sides(f, id_col="match_id", a="home", b="away", side_cols=[("home_rating", "away_rating")])
    scored = sw.withColumns(SC.rating_scorer(F.col("home_0"), F.col("away_0"), scale=20000.0, draw_margin=5000.0))
    out = SC.neutral_probability(scored, id_col="match_id")
    return out.select("match_id", r6("p_first"), r6("p_second"), r6("p_draw"), "side_a", "side_b", "pick")


@query("totals_to_features", "I3", sql=f"""
, tc as (select * from contest where {_TEST}),
lg as (select home as entity, home_score as gf, away_score as ga from tc
       union all select away, away_score, home_score from tc),
tot as (select entity, count(*) as games, sum(gf) as gf, sum(ga) as ga,
               sum(case when gf > ga then 3 when gf = ga then 1 else 0 end) as pts from lg group by entity),
t as (select entity, gf / games as gf_pg, ga / games as ga_pg, pts / games * 5 as form from tot)
select c.match_id, round(h.gf_pg, 6) as home_gf_pg, round(a.gf_pg, 6) as away_gf_pg,
       round(h.form - a.form, 6) as form_diff, round(h.ga_pg - a.ga_pg, 6) as ga_diff
from tc c left join t h on h.entity = c.home left join t a on a.entity = c.away""")
def totals_to_features(spark, sf_dir):
    c = contest(spark, sf_dir)
    tc = c.where(F.year("match_date") > presets.FIXTURE_VAL_YEARS[1])
    tot = SC.period_totals(tc)
    out = SC.totals_to_features(tc.select("match_id", "home", "away"), tot)
    return out.select("match_id", r6("home_gf_pg"), r6("away_gf_pg"), r6("form_diff"), r6("ga_diff"))


_SCORABLE_SQL = S.prepare_sql() + f"""
, tc as (select * from contest where {_TEST}),
lg as (select home as entity, home_score as gf, away_score as ga from tc
       union all select away, away_score, home_score from tc),
tot as (select entity, count(*) as games, sum(gf) as gf, sum(ga) as ga,
               sum(case when gf > ga then 3 when gf = ga then 1 else 0 end) as pts from lg group by entity),
lr as (select entity, rating from (select *, row_number() over (partition by entity order by rating_date desc, l_orderkey desc,
         l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn from ratings) where rn = 1),
t as (select entity, rating, gf / games as gf5, ga / games as ga5, pts / games * 5 as form from tot full join lr using (entity)),
sr0 as (select c.match_id, coalesce(h.rating, gl.med) as home_rating, coalesce(a.rating, gl.med) as away_rating,
          coalesce(h.form, 0) as form_home, coalesce(a.form, 0) as form_away,
          coalesce(h.gf5, cm.home_gf5) as home_gf5, coalesce(a.gf5, cm.away_gf5) as away_gf5,
          coalesce(h.ga5, cm.home_ga5) as home_ga5, coalesce(a.ga5, cm.away_ga5) as away_ga5,
          cm.home_rest_days, cm.away_rest_days, cast(0 as double) as home_win_streak, cast(0 as double) as away_win_streak, cast(0 as double) as h2h_played,
          cast(0.5 as double) as h2h_home_winrate, cm.h2h_avg_goals
        from tc c left join t h on h.entity = c.home left join t a on a.entity = c.away cross join gall gl cross join cmed cm),
sr as (select *, {", ".join(f"{a} - {b} as {n}" for n, (a, b) in S.DIFFS.items())} from sr0)"""


def scorable_rows(spark, sf_dir):
    """Test contests as pairs completed from totals and last ratings, filled from the stored state."""
    from pastline.operators import prepare_table as PT
    from pastline.sources.fixtures import RATING_POSITION, ratings
    tc = contest(spark, sf_dir).where(F.year("match_date") > presets.FIXTURE_VAL_YEARS[1])
    last = SC.last_values(ratings(spark, sf_dir), key="entity", time="rating_date", value="rating", position=RATING_POSITION)
    rows = SC.complete_totals(tc.select("match_id", "home", "away"), SC.period_totals(tc), last)
    rows = rows.withColumns({"division": F.lit(None).cast("string"), "is_top_league": F.lit(0)})
    return rows, PT, S.stored_preparation(spark, sf_dir), S.preparer()


@query("scorable_totals", "I3 S7", sql=_SCORABLE_SQL + f"""
select match_id, {", ".join(f"round({c}, 6) as {c}" for c in S.CONTINUOUS)} from sr""")
def scorable_totals(spark, sf_dir):
    rows, PT, state, spec = scorable_rows(spark, sf_dir)
    return PT.impute(rows, state, spec).select("match_id", *[r6(c) for c in S.CONTINUOUS])


@query("scored_totals", "I1 I2 I3 I4 S7")
def scored_totals(spark, sf_dir):
    """The completed rows in both orientations, prepared from the stored
    state, scored by a stored model on neutral ground, the picks held against
    the known results (drawn contests have none)."""
    from pastline.learners import models as L
    from pastline.learners import store as ST
    from pastline.learners.data import assemble
    from pastline.plans.q_learn import _split, learn_data
    x, names, _ = learn_data(spark, sf_dir)
    plain = [n for n in names if not n.startswith("cat__")]  # a pair without a division has none of these
    train = assemble(_split(x, "train").drop("features"), plain)
    root = ST.store_root(spark, "scoring-models")
    ST.save(spark, L.fit_logreg(train, C=0.1), root, "logreg")
    rows, PT, state, spec = scorable_rows(spark, sf_dir)
    sides = [(f"home_{c}", f"away_{c}") for c in ("rating", "gf5", "ga5", "rest_days", "win_streak")] + [("form_home", "form_away")]
    wide = rows.select("match_id", "home", "away", *[c for p in sides for c in p], "h2h_played", "h2h_home_winrate", "h2h_avg_goals", "division", "is_top_league")
    both = wide.withColumn("orientation", F.lit(0)).unionByName(wide.select(
        "match_id", F.col("away").alias("home"), F.col("home").alias("away"), *[F.col(b).alias(a) for a, b in sides], *[F.col(a).alias(b) for a, b in sides],
        "h2h_played", "h2h_home_winrate", "h2h_avg_goals", "division", "is_top_league", F.lit(1).alias("orientation")))
    ready = PT.transform(both, state, spec, keep=["match_id", "home", "away", "orientation"])
    scored = ST.load(spark, root, "logreg").transform(assemble(ready, plain))
    first = F.col("orientation") == 0
    neutral = scored.groupBy("match_id").agg(
        F.max(F.when(first, F.col("home"))).alias("side_a"), F.max(F.when(first, F.col("away"))).alias("side_b"),
        F.avg(F.when(first, F.col("p2")).otherwise(F.col("p0"))).alias("p_first"),
        F.avg(F.when(first, F.col("p0")).otherwise(F.col("p2"))).alias("p_second"))
    picks = neutral.withColumn("pick", F.when(F.col("p_first") >= F.col("p_second"), F.col("side_a")).otherwise(F.col("side_b")))
    c = contest(spark, sf_dir)
    results = c.select("match_id", F.when(F.col("home_score") > F.col("away_score"), F.col("home")).when(
        F.col("home_score") < F.col("away_score"), F.col("away")).alias("actual"))
    return SC.picks_against_results(picks, results)


NEAR_COLS = ["home_rating", "away_rating", "gf5_diff", "ga5_diff", "home_rest_days", "h2h_played"]
#: Scaled features as whole ten-thousandths, so equal distances are equal in any engine.
_POINTS_SQL = S.prepare_sql() + f"""
, pts as (select match_id, case outcome when 'A' then 0 when 'D' then 1 when 'H' then 2 end as label,
                 {", ".join(f"round(({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end * 10000) as {c}" for c in NEAR_COLS)}
          from imp cross join sc where split = 'train' and outcome is not null),
cls as (select label, count(*) as n from pts group by label),
small as (select * from pts where label in (select label from cls where n < (select max(n) from cls)))"""


def points(spark, sf_dir):
    """Train rows as (match_id, label, x): scaled features in whole ten-thousandths."""
    from pastline.learners.data import label_code
    x = S.design(spark, sf_dir).where((F.col("split") == "train") & F.col("outcome").isNotNull())
    return x.select("match_id", label_code("outcome").alias("label"),
                    F.array(*[F.round(F.col(f"num__{c}") * 10000) for c in NEAR_COLS]).alias("x"))


def small_classes(p):
    from pastline.learners.data import class_counts
    counts = class_counts(p)
    return p.where(F.col("label").isin([c for c, n in counts.items() if n < max(counts.values())]))


@query("in_class_neighbours", "J10", sql=_POINTS_SQL + f"""
, near as (select a.match_id, a.label, b.match_id as neighbour, {" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in NEAR_COLS)} as d2
           from small a join small b on a.label = b.label and a.match_id <> b.match_id)
select match_id, label, neighbour, cast(rank as int) as rank, round(sqrt(d2), 3) as distance
from (select *, row_number() over (partition by match_id order by d2, neighbour) as rank from near) where rank <= 5""")
def in_class_neighbours(spark, sf_dir):
    """The five nearest train rows of the same class, for the classes that oversampling raises."""
    from pastline.learners import neighbours as N
    near = N.in_class_neighbours(small_classes(points(spark, sf_dir)))
    return near.select(F.col("id").alias("match_id"), F.col("label").cast("int").alias("label"), "neighbour", "rank", r6("distance", digits=3))


@query("oversampled", "M11", sql=_POINTS_SQL + """
select label, n as n_before, (select max(n) from cls) - n as n_synthetic, (select max(n) from cls) - n as n_on_segment,
       (select max(n) from cls) as n_after from cls""")
def oversampled(spark, sf_dir):
    """Class sizes before and after oversampling; a synthetic row counts as on
    its segment if both ends are rows of its class, the far end one of the
    base's five neighbours, and every feature lies between theirs."""
    from pastline.learners import neighbours as N
    from pastline.sources.scratch import stored
    p = stored(points(spark, sf_dir), "points")
    near = stored(N.in_class_neighbours(small_classes(p)), "neighbours")
    made = stored(N.oversample(p, neighbours=near), "synthetic")
    a = p.select(F.col("match_id").alias("base"), F.col("label").alias("la"), F.col("x").alias("a"))
    b = p.select(F.col("match_id").alias("neighbour"), F.col("label").alias("lb"), F.col("x").alias("b"))
    pairs = near.select(F.col("id").alias("base"), "neighbour")
    inside = F.forall(F.zip_with("x", F.arrays_zip("a", "b"), lambda v, e: (v >= F.least(e.a, e.b) - 1e-6) & (v <= F.greatest(e.a, e.b) + 1e-6)), lambda t: t)
    good = made.join(pairs, ["base", "neighbour"]).join(a, "base").join(b, "neighbour").where(
        (F.col("la") == F.col("label")) & (F.col("lb") == F.col("label")) & inside)
    n = p.groupBy("label").agg(F.count(F.lit(1)).alias("n_before"))
    out = n.join(made.groupBy("label").agg(F.count(F.lit(1)).alias("n_synthetic")), "label", "left").join(
        good.groupBy("label").agg(F.count(F.lit(1)).alias("n_on_segment")), "label", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return out.select(F.col("label").cast("int").alias("label"), "n_before", zero("n_synthetic").alias("n_synthetic"),
                      zero("n_on_segment").alias("n_on_segment"), (F.col("n_before") + zero("n_synthetic")).alias("n_after"))


@query("imbalance_experiment", "L14 M10 M11")
def imbalance_experiment(spark, sf_dir):
    """One fixed boosting setting without balancing, with balanced class
    weights, and on train rows oversampled to equal class sizes (the encoded
    features are interpolated like the others, a known limit of the method)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from pastline.learners import models as L
    from pastline.learners import neighbours as N
    from pastline.learners.data import FEATURES, LABEL
    from pastline.operators import metrics as M
    from pastline.plans.q_learn import _split, learn_data
    from pastline.sources.scratch import stored
    x, _, _ = learn_data(spark, sf_dir)
    train = _split(x, "train").select("match_id", LABEL, FEATURES)
    made = N.oversample(train.select("match_id", LABEL, vector_to_array(FEATURES).alias("x")))
    more = made.select((-F.monotonically_increasing_id() - 1).alias("match_id"), LABEL, array_to_vector("x").alias(FEATURES))
    grown = stored(train.unionByName(more), "oversampled")
    rows = []
    for arm, rows_in, bal in (("none", train, False), ("weights", train, True), ("oversampling", grown, False)):
        m, kept = L.fit_boost(rows_in, None, rounds=6, balanced=bal, **{
            k: v for k, v in L.BOOST_PRESETS["depthwise"].items()})
        counts = stored(M.confusion_counts(m.transform(_split(x, "val")).select(F.col(LABEL).cast("int").alias("label"), "pred")), "confusion")
        e = M.summary(counts).first()
        recall = {r["cls"]: float(r["recall"]) for r in M.per_class(counts).collect()}  # one row per class
        rows.append((arm, rows_in.count(), float(e["f1_macro"]), *[recall.get(presets.OUTCOME_CODE[c], 0.0) for c in "DHA"], float(e["accuracy"]), int(kept)))
    return spark.createDataFrame(rows, "arm string, n_train long, val_f1_macro double, val_recall_D double, val_recall_H double, "
                                       "val_recall_A double, val_accuracy double, rounds long")


@query("stage_roundtrip", "S3 S4 S5 S9", sql=S.features_sql() + """
select split, count(*) as n_rows from feat group by split""")
def stage_roundtrip(spark, sf_dir):
    """Write the feature stage and the design matrix (partitioned by split)
    to the shared folder, read each split back with partition pruning."""
    from pastline.sources import sinks
    feats_path = sinks.stage_root(spark, "features")
    x_path = sinks.stage_root(spark, "design")
    sinks.write_stage(S.features(spark, sf_dir), feats_path)
    sinks.write_stage(S.design(spark, sf_dir), x_path, partition_by="split")
    parts = [sinks.read_split(spark, x_path, s).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
             for s in ("train", "val", "test")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sinks.write_csv(out, sinks.stage_root(spark, "split_counts_csv"))
    return out


@query("aligned_predictions", "J6 I1", sql=S.features_sql() + """
, p as (select match_id, label from pred)
select f.match_id, f.split, f.division, p.label from feat f join p using (match_id)""")
def aligned_predictions(spark, sf_dir):
    """Predictions meet their row reference by key (never by position);
    the row counts must agree."""
    from pastline.sources.fixtures import pred
    ref = S.features(spark, sf_dir).select("match_id", "split", "division")
    p = pred(spark, sf_dir).select("match_id", "label")
    out = ref.join(p, "match_id", "inner")
    n_ref, n_out = ref.count(), out.count()
    if n_ref != n_out:
        raise ValueError(f"predictions do not align with the row reference: {n_out} vs {n_ref}")
    return out


@query("label_weights", "M10 A7", sql="""
select quality as label, count(*) as n,
       round((select count(*) from labels) / (2.0 * count(*)), 6) as weight
from labels group by quality""")
def label_weights(spark, sf_dir):
    """Balanced weights ``n / (k n_c)`` on an unbalanced 0/1 label table."""
    from pastline.learners.data import balanced_weights
    from pastline.sources.tables import read_table
    lab = read_table(spark, sf_dir, "labels", ["quality"])
    counts = {r[0]: r[1] for r in lab.groupBy("quality").count().collect()}  # one row per class
    w = balanced_weights(counts)
    return spark.createDataFrame([(int(c), int(counts[c]), round(w[c], 6)) for c in counts],
                                 "label int, n long, weight double")


@query("embedding_pca", "M7 M9")
def embedding_pca(spark, sf_dir):
    """PCA of the embedding vectors: eigenvalues, variance ratio, cumulative,
    k for 95 % and the elbow k (one covariance aggregate, d x d on the driver)."""
    import numpy as np
    from pastline.operators import matrix as MX
    from pastline.sources.tables import read_table
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    from pyspark.ml.functions import array_to_vector
    d = emb.select(F.size("embedding")).first()[0]
    vec = emb.select(array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("v"))
    fit = MX.pca_fit_vectors(vec, "v", d)
    cum = np.cumsum(fit.ratio)
    k95, kel = fit.k_for(0.95), fit.k_elbow()
    rows = [(i + 1, float(fit.eigenvalues[i]), float(fit.ratio[i]), float(cum[i]), k95, kel) for i in range(d)]
    return spark.createDataFrame(rows, "component int, eigenvalue double, ratio double, cumulative double, "
                                       "k95 int, k_elbow int")
