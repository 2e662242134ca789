"""Past-only history: chunked scans against a brute-force pandas loop."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pastline.operators import history as H


def _brute(rows, k=5):
    """Per entity in (t, id) order: mean of previous k gf, whole days since
    the previous row, wins in a row just before."""
    df = pd.DataFrame(rows, columns=["id", "t", "entity", "gf", "won"]).sort_values(["entity", "t", "id"])
    out = {}
    for _, g in df.groupby("entity"):
        hist, streak, prev = [], 0, None
        for r in g.itertuples():
            window = [x for x in hist[-k:] if x is not None and x == x]
            out[r.id] = (sum(window) / len(window) if window else None,
                         None if prev is None else (r.t - prev).total_seconds() // 86400,
                         float(streak))
            hist.append(r.gf)
            streak = streak + 1 if r.won else 0
            prev = r.t
    return out


def _rows(n=600, entities=3, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(n):
        t = t0 + dt.timedelta(hours=rnd.randint(0, 24 * 40), minutes=rnd.randint(0, 59))
        gf = None if rnd.random() < 0.1 else float(rnd.randint(0, 4))
        rows.append((i, t, rnd.randint(0, entities - 1), gf, rnd.random() < 0.55))
    return rows


@pytest.mark.parametrize("segment_rows", [1, 4, 60, 1 << 16])
def test_entity_history_matches_brute_force(spark, segment_rows):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz, entity int, gf double, won boolean")
    out = H.entity_history(df, entity="entity", time="t", tie="id", values=("gf",), k=5,
                           segment_rows=segment_rows).select("id", "gf5", "rest_days", "win_streak").collect()
    want = _brute(rows)
    assert len(out) == len(rows)
    for r in out:
        g, d, s = want[r["id"]]
        assert (r["gf5"] is None) == (g is None)
        if g is not None:
            assert r["gf5"] == pytest.approx(g)
        assert r["rest_days"] == d
        assert r["win_streak"] == s


def test_history_is_past_only(spark):
    """Changing a row's own score or any later row leaves its features unchanged."""
    rows = _rows(200, entities=2, seed=3)
    base = spark.createDataFrame(rows, "id long, t timestamp_ntz, entity int, gf double, won boolean")
    pivot_t = sorted(r[1] for r in rows)[100]
    changed = [(i, t, e, float((g or 0) + 10) if t >= pivot_t else g, (not w) if t >= pivot_t else w)
               for i, t, e, g, w in rows]
    other = spark.createDataFrame(changed, "id long, t timestamp_ntz, entity int, gf double, won boolean")

    def feats(d):
        return {r["id"]: tuple(r[1:]) for r in H.entity_history(d, entity="entity", time="t", tie="id",
                                                                  values=("gf",)).where(F.col("t") <= pivot_t)
                .select("id", "gf5", "rest_days", "win_streak").collect()}
    assert feats(base) == feats(other)


def test_pair_history_and_dense_order(spark):
    rnd = random.Random(1)
    t0 = dt.datetime(2021, 1, 1)
    rows = [(i, t0 + dt.timedelta(days=rnd.randint(0, 30)), rnd.randint(0, 3), rnd.randint(0, 3),
             rnd.randint(0, 3), rnd.randint(0, 3)) for i in range(300)]
    rows = [r for r in rows if r[2] != r[3]]
    df = spark.createDataFrame(rows, "match_id long, match_date timestamp_ntz, home int, away int, "
                                     "home_score long, away_score long")
    got = {r["match_id"]: r for r in H.pair_history(df, segment_rows=20).collect()}
    hist = {}
    for m, t, h, a, hs, as_ in sorted(rows, key=lambda r: (r[1], r[0])):
        key = frozenset((h, a))
        prev = hist.get(key, [])
        r = got[m]
        assert r["h2h_played"] == len(prev)
        if prev:
            assert r["h2h_home_winrate"] == pytest.approx(sum(1 for w, _ in prev if w == h) / len(prev))
            assert r["h2h_avg_goals"] == pytest.approx(sum(g for _, g in prev) / len(prev))
        else:
            assert r["h2h_home_winrate"] is None and r["h2h_avg_goals"] is None
        winner = h if hs > as_ else (a if as_ > hs else None)
        hist.setdefault(key, []).append((winner, hs + as_))
    seq = {r["match_id"]: r["seq"] for r in H.dense_order(df, buckets=16).collect()}
    order = [m for m, *_ in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert [seq[m] for m in order] == list(range(len(order)))


def test_trailing_plan_has_no_single_partition(spark):
    from pastline.plans.q_history import trailing_mean_5
    plan = trailing_mean_5(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_dense_order_single_partition_only_over_buckets(spark):
    """The only un-partitioned step is the prefix over bucket totals (at most
    ``buckets`` rows), never over the rows."""
    from pastline.plans.q_history import dense_order
    df = dense_order(spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert "Exchange SinglePartition" in line
    assert plan.count("Exchange SinglePartition") <= 2


def test_segments_are_cut_by_row_count(spark):
    """A key that is hot at a single instant is cut; light keys have no summary and are not stored."""
    from pastline.operators import scan
    t = dt.datetime(2020, 1, 1)
    rows = [(i, t, 0 if i % 3 else i + 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz, k int")
    light, heavy = scan.cut_by_rows(df, ["k"], scan.in_order("t", "id"), 200)
    sizes = [r["count"] for r in heavy.groupBy("k", scan.SEGMENT).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) > 5 and max(sizes) < 3 * 200
    assert light.count() == 1000 and light.select(scan.SEGMENT).distinct().count() == 1
    assert scan.cut_by_rows(df, ["id"], scan.in_order("t"), 200)[1] is None


def test_history_of_a_key_hot_within_a_day(spark):
    rnd = random.Random(9)
    t0 = dt.datetime(2020, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=rnd.randint(0, 5)), 0 if i % 3 else 1, float(rnd.randint(0, 4)), rnd.random() < 0.9) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz, entity int, gf double, won boolean")
    out = H.entity_history(df, entity="entity", time="t", tie="id", values=("gf",), k=5, segment_rows=180)
    want = _brute(rows)
    for r in out.select("id", "gf5", "rest_days", "win_streak").collect():
        g, d, s = want[r["id"]]
        assert r["gf5"] == (pytest.approx(g) if g is not None else None) and r["rest_days"] == d and r["win_streak"] == s
