"""As-of joins and counts of neighbours against plain loops, and without a row for each pair."""

from __future__ import annotations

import random

from eventweave.operators import review, timeline

CANDIDATES = "day_id string, number int, stream_id string, id long, start_ms long"


def case(seed):
    r = random.Random(seed)
    some = lambda *x: r.choice([None, *x, *x])
    sets = [(r.choice("ab"), f"s{k}", some(1, 2), some(*range(0, 9000, 500))) for k in range(60)]
    said = [(r.choice("ab"), some(1, 2), some("p", "q"), k, some(*range(0, 9000, 500))) for k in range(80)]
    return sets, said


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_asof_announcement(spark):
    sets, said = case(1)
    got = timeline.asof_announcement(spark.createDataFrame(sets, "day_id string, set_id string, number int, set_start_ms long"), spark.createDataFrame(said, CANDIDATES))
    assert joins(got) == 0
    want = {}
    for day, name, number, at in sets:
        own = [((-1 if t is None else t), i, t) for d, n, _, i, t in said if d == day and n == number and n is not None]
        by = [c for c in own if c[2] is not None and at is not None and c[2] <= at]
        if own:
            want[day, name] = max(by)[1:] if by else min(own)[1:]
    assert {(x["day_id"], x["set_id"]): (x["candidate_id"], x["candidate_start_ms"]) for x in got.collect()} == want


def test_best_candidate_for_set(spark):
    sets, said = case(2)
    got = review.best_candidate_for_set(spark.createDataFrame(sets, "day_id string, set_id string, number int, first_ms long"), spark.createDataFrame(said, CANDIDATES), 1)
    assert joins(got) == 0
    want = {}
    for day, name, number, at in sets:
        own = [(t > at, abs(t - at) / 1000, s or "", i) for d, n, s, i, t in said if d == day and n == number and None not in (n, t, at) and abs(t - at) <= 1000]
        if own:
            want[day, name] = (min(own)[3], min(own)[1])
    assert {(x["day_id"], x["set_id"]): (x["c_id"], x["distance_s"]) for x in got.collect()} == want


def test_nearby_conflicts(spark):
    windows, said = case(3)
    got = review.nearby_conflicts(spark.createDataFrame(windows, "day_id string, id string, number int, start_ms long"), spark.createDataFrame(said, CANDIDATES), 1, 8)
    assert joins(got) == 1  # the counts with the windows
    near = lambda day, number, at: sum(d == day and None not in (n, number, t, at) and n != number and abs(t - at) <= 1000 for d, n, _, _, t in said)
    assert {x["id"]: x["conflicts"] for x in got.collect()} == {i: min(8, near(day, number, at)) for day, i, number, at in windows}
