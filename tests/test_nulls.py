"""Rows with null keys or times, ids above 2^53 and small rates survive."""

import datetime as dt

from pyspark.sql import functions as F

from pastline.operators.asof import asof_join
from pastline.operators.history import dense_order, entity_history, pair_history, to_entity_rows
from pastline.operators.profile import rate_table

DAY = [dt.datetime(2001, 1, d) for d in range(1, 9)]
CONTEST = "match_id long, match_date timestamp_ntz, home string, away string, home_score int, away_score int"


def contests(spark):
    return spark.createDataFrame([
        (1, DAY[0], "a", "b", 1, 0), (2, DAY[1], None, "b", 1, 1), (3, None, "a", "b", 2, 0),
        (4, DAY[2], "b", "a", 0, 3), (5, DAY[3], "a", "b", 1, 1)], CONTEST)


def test_histories_keep_every_row(spark):
    c = contests(spark)
    long = to_entity_rows(c)
    got = {(r.match_id, r.venue): r for r in entity_history(long, k=5).collect()}
    assert len(got) == 10
    assert got[1, "H"].seq_in_entity == 0 and got[4, "A"].seq_in_entity == 1 and got[5, "H"].seq_in_entity == 2
    # a contest without a date comes after all dated ones and is in no earlier history
    assert got[3, "H"].seq_in_entity == 3 and got[5, "H"].win_streak == 2.0
    assert got[2, "A"].seq_in_entity == 1 and got[2, "A"].rest_days == 1.0
    pairs = {r.match_id: r for r in pair_history(c).collect()}
    assert {i: r.h2h_played for i, r in pairs.items() if i != 2} == {1: 0.0, 4: 1.0, 5: 2.0, 3: 3.0}
    assert len(pairs) == 5


def test_asof_keeps_left_rows_without_key_or_time(spark):
    left = spark.createDataFrame([(1, "a", DAY[2]), (2, None, DAY[2]), (3, "a", None), (4, "z", DAY[2])], "id long, k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", DAY[0], 1.0), ("a", DAY[3], 2.0), (None, DAY[0], 9.0), ("a", None, 8.0)], "rk string, rt timestamp_ntz, v double")
    got = {r.id: r["asof"] for r in asof_join(left, right, left_key="k", left_time="t", right_key="rk", right_time="rt", values=["v"]).collect()}
    assert got[1].v == 1.0 and got[2] is None and got[3] is None and got[4] is None and len(got) == 4


def test_dense_order_of_large_ids_nulls_and_many_ties(spark):
    big = 1 << 60
    rows = [(big + i, DAY[0]) for i in range(6)] + [(7, None), (None, DAY[1]), (8, DAY[1])]
    df = spark.createDataFrame(rows, "match_id long, match_date timestamp_ntz")
    got = {(r.match_id, r.match_date): r.seq for r in dense_order(df).collect()}
    assert [got[big + i, DAY[0]] for i in range(6)] == list(range(6))
    assert got[8, DAY[1]] == 6 and got[None, DAY[1]] == 7 and got[7, None] == 8


def test_dense_order_by_several_columns_of_any_type(spark):
    rows = [(DAY[i % 2], f"d{i % 3}", f"h{9 - i}") for i in range(9)]
    df = spark.createDataFrame(rows, "match_date timestamp_ntz, division string, home string")
    got = dense_order(df, tie=("division", "home")).collect()
    want = sorted(rows)
    assert [want[r.seq] for r in got] == [(r.match_date, r.division, r.home) for r in got]


def test_one_far_value_does_not_fill_one_range(spark):
    df = spark.range(20_000).select(F.col("id").alias("match_id"), F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") % 997).alias("match_date"))
    out = dense_order(df)
    assert out.agg(F.max("seq"), F.countDistinct("seq")).first() == (19_999, 20_000)
    sizes = df.repartitionByRange(8, "match_date", "match_id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 3 * 20_000 / 8


def test_a_small_rate_is_not_an_absent_class(spark):
    df = spark.range(3_000_000).select(F.lit(1.0).alias("x"), F.when(F.col("id") == 5, "D").otherwise("H").alias("y"))
    r = rate_table(df, x=F.col("x"), edges=[0.0, 2.0], labels=None, target="y", classes=["H", "D", "A"]).first()
    assert r.rate_D == 0.0 and r.rate_A is None and r.rate_H == 1.0


def test_no_frame_stays_cached(spark):
    from pastline.plans.catalog import REGISTRY
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("win_streak", "asof_fill", "h2h_history"):
        REGISTRY[name].build(spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
