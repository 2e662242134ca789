"""Preparation state as a table: reload equals fit, and any number of groups."""

import pytest
from pyspark.sql import functions as F

from pastline.operators import prepare_table as PT
from pastline.operators import score as SC
from pastline.operators.prepare import Preparer
from tests.conftest import SF001


def test_reloaded_state_prepares_as_the_fitted_one(spark, tmp_path):
    from pastline.plans import stages as S
    feats = S.build_features(spark, SF001).checkpoint()
    spec, fitted = S.preparer(), S.preparer().fit(feats)
    PT.write_state(PT.fit_state(feats, spec), f"file://{tmp_path}/state")
    state = PT.read_state(spark, f"file://{tmp_path}/state")
    one = PT.scalars(state)
    assert one["global_median", ""] == fitted.global_median and {c: one["median", c] for c in spec.median_cols} == fitted.medians
    groups = {r.grp: r.value for r in state.where("kind = 'group_median'").collect()}
    assert groups == {g: m for g, m in fitted.group_medians.items() if g is not None}
    places = {r.grp: int(r.value) for r in state.where("kind = 'category'").collect()}
    assert places == {c: i for i, c in enumerate(fitted.categories)}
    # unknown and null groups beside the known ones
    odd = feats.limit(40).withColumn("division", F.when(F.col("match_id") % 2 == 0, "never seen"))
    rows = feats.unionByName(odd.withColumn("match_id", -F.col("match_id") - 1))
    want = {r.match_id: r for r in fitted.transform(rows, keep=["match_id"]).collect()}
    x = PT.transform(rows, state, spec, keep=["match_id"])
    got = PT.assemble(x, state).collect()
    names = fitted.feature_names()
    assert len(got) == len(want)
    for r in got:
        assert r.features.size == len(names)
        assert list(r.features.toArray()) == pytest.approx([want[r.match_id][n] for n in names], abs=1e-9)


def test_many_groups_stay_a_table(spark):
    n = 200_000
    df = spark.range(n).select(
        F.concat(F.lit("g"), F.col("id").cast("string")).alias("division"), F.when(F.col("id") % 3 < 2, "train").otherwise("test").alias("split"),
        (F.col("id") % 1000).cast("double").alias("home_rating"), F.when(F.col("id") % 7 > 0, F.col("id") % 10).cast("double").alias("away_rating"))
    spec = Preparer(rating_cols=("home_rating", "away_rating"), continuous=["home_rating", "away_rating"], flags=["rating_missing"])
    state = PT.fit_state(df, spec)
    kinds = {r.kind: r["count"] for r in state.groupBy("kind").count().collect()}
    train = sum(i % 3 < 2 for i in range(n))
    assert kinds == {"group_median": train, "category": train, "global_median": 1, "mean": 2, "scale": 2}
    x = PT.assemble(PT.transform(df, state, spec, keep=["division"]), state)
    r = x.where("division = 'g7'").first()
    i = sorted(f"g{j}" for j in range(n) if j % 3 < 2).index("g7")
    assert r.features.size == 3 + train and r.features[3 + i] == 1.0 and r.features.numNonzeros() <= 4
    assert x.where("division = 'g8'").first().category == train  # a group of the test rows only
    filled = PT.impute(df, state, spec).where("division = 'g7'").first()
    assert filled.away_rating == 7.0  # the group's median: its other rating


def test_nulls_after_imputation_raise(spark):
    df = spark.createDataFrame([("a", "train", 1.0, None), ("a", "test", None, 2.0)], "division string, split string, x double, y double")
    spec = Preparer(rating_cols=("x", "x"), continuous=["x", "y"])
    with pytest.raises(ValueError, match="'y'"):
        PT.fit_state(df, spec)


def test_totals_completed_and_picks(spark):
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "b", "c")], "match_id long, home string, away string")
    totals = spark.createDataFrame([("a", 4, 8, 2, 9), ("b", 2, 1, 1, 3)], "entity string, games long, gf long, ga long, pts long")
    last = spark.createDataFrame([("a", 10.0), ("c", 30.0)], "entity string, rating double")
    rows = {r.match_id: r for r in SC.complete_totals(pairs, totals, last).collect()}
    r = rows[1]
    assert (r.home_rating, r.away_rating, r.home_gf5, r.away_ga5, r.form_home, r.form_away) == (10.0, None, 2.0, 0.5, 11.25, 7.5)
    r = rows[2]
    assert (r.away_rating, r.away_gf5, r.form_away, r.h2h_home_winrate, r.home_rest_days) == (30.0, None, None, 0.5, None)
    history = spark.createDataFrame([("a", 1, 1, 5.0), ("a", 2, 1, 6.0), ("a", 2, 2, None), (None, 3, 1, 1.0), ("b", None, 1, 2.0)],
                                    "k string, t int, pos int, v double")
    assert [tuple(x) for x in SC.last_values(history, key="k", time="t", value="v", position=["pos"]).collect()] in ([("a", None)], [("a", 6.0)])
    picks = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "match_id long, pick string")
    results = spark.createDataFrame([(1, "a"), (2, "b"), (9, "x")], "match_id long, actual string")
    assert tuple(SC.picks_against_results(picks, results).first()) == (3, 2, 1, 0.5)
