"""Benchmark cases and their sampling, candidate rules, diagnostics of segments, vectors by position."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventweave.functions import textfuncs
from eventweave.operators import results, review, validate
from eventweave.sources import tables

CASE = "day_id string, case_id string, difficulty int, number int, start_ms long"


def cases(spark):
    rows = [(d, f"{d}{k}", 3 - k // 3, 10 * k, 1000 * k) for d in ("a", "b") for k in range(9)] + [("c", "c0", 9, 50, 0)]
    return spark.createDataFrame(rows, CASE)


def ids(df):
    return [r["case_id"] for r in df.collect()]


def test_hardest_by_quota_and_limit(spark):
    c = cases(spark)
    assert ids(review.sample_cases(c, "hardest", max_cases=5)) == ["c0", "a0", "a1", "b0", "b1"]  # two a day
    assert ids(review.sample_cases(c, "hardest", 3, max_cases=4)) == ["c0", "a0", "a1", "a2"]
    assert len(ids(review.sample_cases(c, "hardest"))) == 19


def test_ranges_and_lists(spark):
    c = cases(spark)
    assert ids(review.sample_cases(c, "range", 2, max_cases=9, between=(20, 50))) == ["a2", "a3", "b2", "b3", "c0"]
    assert ids(review.sample_cases(c, "list", 1, max_cases=9, numbers=[50, 10, 50])) == ["a5", "b5", "c0", "a1", "b1"]  # per_day is ignored
    assert ids(review.sample_cases(c, "list", max_cases=5, numbers=[999])) == []
    for mode, extra in (("range", {}), ("range", {"between": (5, 5)}), ("list", {"numbers": []}), ("worst", {})):
        with pytest.raises(ValueError):
            review.sample_cases(c, mode, max_cases=3, **extra)


def test_thirds(spark):
    c = cases(spark)
    got = review.sample_cases(c, "stratified", 5).collect()
    parts = {d: [sum(r["difficulty"] == x for r in got if r["day_id"] == d) for x in (3, 2, 1)] for d in ("a", "b")}
    assert parts == {"a": [2, 2, 1], "b": [2, 2, 1]} and sum(r["day_id"] == "c" for r in got) == 1
    few = spark.createDataFrame([("d", f"d{k}", k, 1, 0) for k in range(4)], CASE)
    assert len(ids(review.sample_cases(few, "stratified", 4))) == 4 and len(ids(review.sample_cases(few, "stratified", 2))) == 2
    assert ids(review.sample_cases(few, "stratified", 1)) == ["d3"]  # four cases have parts of one, one and two


def test_random_repeats(spark):
    """Two of each day, and the one of day c."""
    c = cases(spark)
    one, two = (ids(review.sample_cases(c.repartition(n), "random", seed=4, max_cases=6)) for n in (1, 5))
    assert one == two and len(set(one)) == 5 and one != ids(review.sample_cases(c, "random", seed=5, max_cases=6))
    assert ids(review.sample_cases(c.limit(0), "random", max_cases=6)) == []


SETS = "day_id string, set_id string, number int, photo_count int, first_ms long"
SAID = "day_id string, stream_id string, clip string, segment_index int, id int, number int, start_ms long"
SEGMENTS = "day_id string, stream_id string, clip string, segment_index int, start_ms long, end_ms long, text string, trigger_types array<string>"


@pytest.mark.parametrize("trim", [True, False])
def test_benchmark_cases(spark, trim):
    sets = spark.createDataFrame([("d", "s1", 12, 9, 70_000), ("d", "s2", None, 9, 0), ("d", "s3", 12, 1, 0), ("d", "s4", 77, 9, 0)], SETS)
    said = spark.createDataFrame([("d", "p", "c", 6, 1, 12, 60_000), ("d", "p", "c", 2, 2, 12, 75_000), ("d", "p", "z", 1, 3, 77, 5), ("d", "p", "c", 9, 4, 13, 50_000)], SAID)
    texts = {3: ("first ", ["keyword"]), 4: ("second", []), 5: (None, None), 6: ("Numer 12!", ["category"]), 8: ("eight", []), 9: ("numer 13", ["keyword"])}
    segments = spark.createDataFrame([("d", "p", "c", i, 10_000 * i, 10_000 * i + 500, t, g) for i, (t, g) in texts.items()], SEGMENTS)
    got = results.benchmark_cases(sets, said, segments, {"first": 1, "second": 2}, 2, 100, before=3, trim=trim).collect()
    assert len(got) == 1 and got[0]["set_id"] == "s1"  # the candidate before the set is taken, 77 has no segment
    r = got[0]
    assert r["anchor_delta_s"] == -10.0 and r["trigger_types"] == ["category"]
    if trim:
        assert (r["case_id"], r["window_text"], r["expected_ordinal"]) == ("d:12:p:c:0004:0008", "second Numer 12! eight", 2)
    else:
        assert (r["case_id"], r["window_text"], r["expected_ordinal"]) == ("d:12:p:c:0003:0009", "first second Numer 12! eight numer 13", 1)
    assert r["difficulty"] == 1 + 2 + 1 + 2  # number, ordinal, category, and numbers 13 and 77 within 90 seconds of the window's start


def test_candidate_rules(spark):
    good = {"day_id": "d", "candidate_rule_name": "gap", "candidate_rule_version": "v", "candidate_rule_params_json": '{"window_radius":1}', "window_radius": 1, "center_left_photo_id": "x", "center_right_photo_id": "y"}
    good |= {"window_photo_ids": ["x", "y"], "frame_01_photo_id": "x", "frame_02_photo_id": "y", "frame_01_timestamp": 5, "frame_02_timestamp": 5, "split_name": "", "left_segment_id": "s", "right_segment_id": "t", "boundary": True}
    broken = [
        ({}, set()),
        ({"window_radius": 2}, {"radius", "params"}),
        ({"frame_02_timestamp": 4}, {"times"}),
        ({"window_photo_ids": ["y", "x"]}, {"window"}),
        ({"center_left_photo_id": "y"}, {"center"}),
        ({"split_name": "dev"}, {"split"}),
        ({"boundary": False}, {"boundary"}),
        ({"left_segment_id": " "}, {"blank"}),
        ({"frame_01_photo_id": None}, {"blank", "window", "center"}),
    ]
    rows = [good | change | {"k": k} for k, (change, _) in enumerate(broken)]
    schema = "k int, " + ", ".join(f"{c} {t}" for c, t in ((c, "array<string>" if c == "window_photo_ids" else {int: "int", bool: "boolean"}.get(type(v), "string")) for c, v in good.items()))
    df = spark.createDataFrame([tuple(r[c] for c in ("k", *good)) for r in rows], schema)
    parts = [F.col(c) for c in ("day_id", "center_left_photo_id", "center_right_photo_id")]
    named = df.withColumn("candidate_id", textfuncs.candidate_id(*parts, F.concat_ws("|", "candidate_rule_version", "candidate_rule_params_json")))
    for k, (_, rules) in enumerate(broken):
        assert {r["rule"] for r in validate.candidate_rows(named.where(F.col("k") == k), 1).collect()} == rules, k
    wrong = validate.candidate_rows(named.where("k = 0").withColumn("candidate_id", F.lit("0")), 1).collect()
    assert [(r["rule"], r["key"]) for r in wrong] == [("id", "0")]


def test_boundary_diagnostics(spark):
    segments = spark.createDataFrame([("d", 0, 1, 4), ("d", 1, 5, 5)], "day_id string, segment_index long, start_photo_id long, end_photo_id long")
    scores = [("d", 1, 2, 0.2, False, 0), ("d", 2, 3, 0.2, False, 0), ("d", 3, 4, 0.6, False, 0), ("d", 4, 5, 0.9, True, 1)]
    scores = spark.createDataFrame(scores, "day_id string, left_photo_id long, right_photo_id long, boundary_score double, is_cut boolean, segment_index long")
    got = {r["segment_index"]: r for r in review.boundary_diagnostics(segments, scores, 2).collect()}
    assert (got[0]["score_before"], got[0]["score_after"], [x["right_photo_id"] for x in got[0]["top_internal"]]) == (None, 0.9, [4, 2])
    assert (got[1]["score_before"], got[1]["score_after"], got[1]["top_internal"]) == (0.9, None, None)


def test_vectors_by_position(spark):
    v = lambda *rows: spark.createDataFrame(list(rows), "row_index int, embedding array<double>")
    n = lambda *rows: spark.createDataFrame(list(rows), "row_index int, relative_path string")
    two = v((1, [0.0, 1.0]), (0, [1.0, 0.0]))
    got = tables.align_embeddings(two, n((0, "a"), (1, "b"))).collect()
    assert {r["relative_path"]: r["embedding"] for r in got} == {"a": [1.0, 0.0], "b": [0.0, 1.0]}
    assert tables.align_embeddings(two.limit(0), n((0, "a")).limit(0)).count() == 0
    for vectors, index, message in (
        (two, n((0, "a")), "not in the index"),
        (two, n((0, "a"), (1, "b"), (2, "c")), "no vector"),
        (two, n((0, "a"), (1, "b"), (1, "c")), "doubled"),
        (two, n((0, "a"), (1, " ")), "blank key"),
        (v((0, [1.0]), (2, [1.0])), n((0, "a"), (2, "b")), "gap"),
        (v((0, [float("nan")])), n((0, "a")), "bad vector"),
    ):
        with pytest.raises(Exception, match=message):
            tables.align_embeddings(vectors, index).collect()
    with pytest.raises(Exception, match="bad vector"):
        tables.read_embeddings(spark.createDataFrame([("a", [1.0])], "relative_path string, embedding array<double>"), width=2).collect()


def test_selection_takes_the_smallest_path(spark):
    photos = [("/m/1", "p", "a.jpg", "z/a.jpg"), ("/m/1", "p", "a.jpg", "b/a.jpg"), ("/m/2", "p", "c.jpg", "y/c.jpg"), ("/m/3", "p", "c.jpg", "x/c.jpg")]
    photos = spark.createDataFrame(photos, "source_path string, stream_id string, filename string, relative_path string").repartition(3)
    chosen = spark.createDataFrame([("/m/1", "p", "a.jpg", 2), ("/gone", "p", "c.jpg", 1), ("/gone", "q", "c.jpg", 3)], "source_path string, stream_id string, filename string, order int")
    hit, missed = review.resolve_selection(chosen, photos)
    assert {r["relative_path"]: r["order"] for r in hit.collect()} == {"b/a.jpg": 2, "x/c.jpg": 1}
    assert [(r["stream_id"], r["order"]) for r in missed.collect()] == [("q", 3)]
