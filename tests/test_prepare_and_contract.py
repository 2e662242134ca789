"""Train-only state, scaler properties, driver contract."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001


def test_state_ignores_val_and_test(spark):
    from pastline.plans import stages as S
    feats = S.build_features(spark, SF001).checkpoint()
    p1 = S.preparer().fit(feats)
    # perturb every non-train row
    noisy = feats.withColumns({c: F.when(F.col("split") != "train", F.col(c) * 3 + 100).otherwise(F.col(c))
                               for c in ["home_rating", "away_rating", "home_gf5", "h2h_avg_goals"]})
    p2 = S.preparer().fit(noisy)
    assert p1.group_medians == p2.group_medians and p1.global_median == p2.global_median
    assert p1.medians == p2.medians
    for c in S.CONTINUOUS:
        assert p1.means[c] == pytest.approx(p2.means[c]) or c in {"rating_diff"}
    x = p1.transform(feats, keep=["split"]).where(F.col("split") == "train")
    for c in ["num__home_rating", "num__gf5_diff", "num__h2h_played"]:
        m, s = x.agg(F.avg(c), F.stddev_pop(c)).first()
        assert m == pytest.approx(0.0, abs=1e-9)
        assert s == pytest.approx(1.0, abs=1e-9)
    # no nulls anywhere in the continuous block (M5)
    assert x.where(" or ".join(f"num__{c} is null" for c in S.CONTINUOUS)).count() == 0
    # unseen category -> all zeros
    row = p1.transform(spark.createDataFrame([("ZZ",)], "division string")
                       .crossJoin(feats.drop("division").limit(1))).first()
    assert all(row[c] == 0.0 for c in row.asDict() if c.startswith("cat__"))


def test_split_boundary_clean(spark):
    from pastline.operators.split import split_summary
    from pastline.plans import stages as S
    rows = split_summary(S.build_features(spark, SF001), time="match_date").collect()
    assert {r["split"] for r in rows} == {"train", "val", "test"}
    assert all(r["boundary_ok"] for r in rows)


def test_driver_contract(spark):
    import __spark_entry__ as E
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["match_id", "home_gf5", "home_ga5", "away_gf5", "away_ga5"]


def test_neutral_probability_leaves_the_draw_to_nobody(spark):
    from pastline.operators import score as SC
    rows = [(1, 0, "a", "b", 0.2, 0.3, 0.5), (1, 1, "b", "a", 0.3, 0.3, 0.4)]
    r = SC.neutral_probability(spark.createDataFrame(
        rows, "id int, orientation int, home string, away string, p0 double, p1 double, p2 double"), id_col="id").first()
    assert (r["p_first"], r["p_second"], r["p_draw"]) == pytest.approx((0.4, 0.3, 0.3)) and r["pick"] == "a"


def test_register_replaces_and_keeps(spark):
    from pastline.operators import metrics as M
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, score double")
    new = spark.createDataFrame([("b", 5.0, "x"), ("c", 3.0, "y")], "model string, score double, note string")
    got = {tuple(r) for r in M.register(M.register(None, old), new).collect()}
    assert got == {("a", 1.0, None), ("b", 5.0, "x"), ("c", 3.0, "y")}


def test_a_model_without_a_validation_row_is_proposed_by_its_test_score(spark):
    from pastline.operators import metrics as M
    t = spark.createDataFrame([("v", "ensemble", 0.4, 0.9), ("w", "ensemble", None, 0.5)],
                              "model string, family string, val_f1_macro double, test_f1_macro double")
    assert M.proposed(t).first()["model"] == "w"
