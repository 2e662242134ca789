"""As-of join traps T1 (last row wins even with a null value) and T2 (ties by position)."""

import datetime as dt
import random

import pytest

from pastline.operators import asof as A
from pastline.functions.names import entity_name


def test_asof_null_last_row_and_ties(spark):
    d = dt.datetime
    left = spark.createDataFrame([(1, "a", d(2020, 1, 5)), (2, "a", d(2020, 1, 3)), (3, "b", d(2020, 1, 1)),
                                  (4, "a", d(2020, 1, 1)), (5, "a", d(2020, 1, 10))],
                                 "id long, k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", d(2020, 1, 2), 10.0, 1), ("a", d(2020, 1, 3), 20.0, 1),
                                   ("a", d(2020, 1, 3), 21.0, 2),          # same date: position 2 wins
                                   ("a", d(2020, 1, 4), None, 1),          # last row null: null wins (T1)
                                   ("a", d(2020, 1, 9), 40.0, 1)],
                                  "k string, t timestamp_ntz, r double, pos int")
    out = {r["id"]: (r["asof"]["r"] if r["asof"] else "none")
           for r in A.asof_join(left, right, left_key="k", left_time="t", right_key="k", right_time="t",
                                values=["r"], right_position=["pos"], segment_rows=2).collect()}
    assert out == {1: None, 2: 21.0, 3: "none", 4: "none", 5: 40.0}


@pytest.mark.parametrize("rows", [3, 40, 1 << 16])
def test_asof_matches_brute_force(spark, rows):
    rnd = random.Random(5)
    t0 = dt.datetime(2020, 1, 1)
    right = [(rnd.randint(0, 3), t0 + dt.timedelta(hours=rnd.randint(0, 2000)), float(i), i) for i in range(400)]
    left = [(i, rnd.randint(0, 4), t0 + dt.timedelta(hours=rnd.randint(0, 2000))) for i in range(300)]
    L = spark.createDataFrame(left, "id long, k int, t timestamp_ntz")
    R = spark.createDataFrame(right, "k int, t timestamp_ntz, r double, pos long")
    got = {r["id"]: (r["asof"]["r"] if r["asof"] else None)
           for r in A.asof_join(L, R, left_key="k", left_time="t", right_key="k", right_time="t",
                                values=["r"], right_position=["pos"], segment_rows=rows).collect()}
    for i, k, t in left:
        cands = [(rt, p, v) for rk, rt, v, p in right if rk == k and rt <= t]
        want = max(cands)[2] if cands else None
        assert got[i] == want


@pytest.mark.parametrize("times", [3, 400])
def test_asof_moves_one_row_per_key_and_time(spark, monkeypatch, times):
    rnd = random.Random(7)
    t0 = dt.datetime(2020, 1, 1)
    day = lambda: t0 + dt.timedelta(days=rnd.randrange(times))
    rated = [(rnd.randrange(3), day(), rnd.choice([None, float(i)]), rnd.choice([None, i % 5]), i) for i in range(300)]
    rated += [(None, t0, 1.0, 1, 300), (0, None, 1.0, 1, 301)]
    played = [(i // 2 if i < 8 else i, day() if i % 9 else None, rnd.randrange(4) if i % 11 else None, rnd.randrange(4), None, None)
              for i in range(200)] + [(None, t0 + dt.timedelta(days=times), 0, 1, 5.0, None)]
    c = spark.createDataFrame(played, "match_id long, match_date timestamp_ntz, home int, away int, home_rating double, away_rating double")
    r = spark.createDataFrame(rated, "entity int, rating_date timestamp_ntz, rating double, p int, q int")
    moved, join = [], A.asof_join
    monkeypatch.setattr(A, "asof_join", lambda left, right, **kw: moved.append((left.count(), right.count())) or join(left, right, **kw))
    got = A.asof_fill(c, r, r_position=["p", "q"]).collect()

    def value(key, time):
        cands = [x for x in rated if None not in (key, time, x[0], x[1]) and x[0] == key and x[1] <= time]
        return max(cands, key=lambda x: (x[1], x[3] is not None, x[3] or 0, x[4]))[2] if cands else None

    best = {}
    for i, t, h, a, *_ in played:
        for side, k in (("h", h), ("a", a)):
            v = value(k, t) if i is not None else None
            old = best.get((i, side))
            best[i, side] = v if old is None else old if v is None else max(old, v)
    assert len(got) == len(played)
    for x in got:
        assert (x.home_asof, x.away_asof) == (best[x.match_id, "h"], best[x.match_id, "a"])
        assert x.home_rating == (x.home_asof if x.home_rating_before is None else x.home_rating_before)
    pairs = {(k, t) for _, t, h, a, *_ in played for k in (h, a) if k is not None and t is not None}
    stamps = {x[:2] for x in rated if None not in x[:2]}
    # ratings move as they are where (nearly) each has a time of its own
    assert moved == [(len(pairs), len(stamps) if times == 3 else len(rated))]


def test_name_normalisation(spark):
    df = spark.createDataFrame([("  Man   United ",), ("Man United",), (None,), ("A B",)], "n string")
    got = [r[0] for r in df.select(entity_name("n", {"Man United": "Manchester United"})).collect()]
    assert got == ["Man United", "Manchester United", "", "A B"]
