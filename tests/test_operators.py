"""Operators on hand-made rows."""

from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventweave.functions import jsonfuncs, textfuncs, timefuncs, vectors
from eventweave.operators import boundaries, dataset, metrics, order, review, sync, timeline, transcripts, validate


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def lit(v):
    return F.lit(v)


def test_exif_times(spark):
    x = one(spark, timefuncs.parse_exif_ts(lit("2024:03:05 10:11:12.5+02:00")))
    assert str(x["local"]) == "2024-03-05 10:11:12" and x["fraction"] == "5" and x["offset"] == "+02:00" and x["epoch_ms"] == 1709633472500
    assert one(spark, timefuncs.parse_exif_ts(lit("2024-03-05 10:11:12"))) is None


def test_local_times(spark):
    assert str(one(spark, timefuncs.to_local_ts(lit("2024-01-02T03:04:05.250")))) == "2024-01-02 03:04:05.250000"
    assert one(spark, timefuncs.to_local_ts(lit("2024-01-02"))) is None
    assert one(spark, timefuncs.fmt_local_ts(timefuncs.to_local_ts(lit("2024-01-02 03:04:05.25")))) == "2024-01-02 03:04:05.250"


def test_pick_capture_time(spark):
    df = spark.createDataFrame([("bad", "2024-01-02 00:00:01", None), (None, None, "2024-01-03 00:00:00"), (None, None, None)], "a string, b string, m string").withColumn("m", F.col("m").cast("timestamp_ntz"))
    rows = timefuncs.pick_capture_time(df, ["a", "b"], ["m"]).collect()
    assert [(r["timestamp_source"], r["metadata_status"]) for r in rows] == [("b", "ok"), ("m", "partial"), ("placeholder", "error")]


def test_delta_columns_round_half_even(spark):
    a, b = timefuncs.delta_columns(F.array(*map(lit, (0, 500, 1500, 4000))))
    assert one(spark, a) == [0, 0, 2, 4] and one(spark, b) == [0, 0, 1, 2]


@pytest.mark.parametrize(("text", "want"), [("Zażółć Gęślą", "zazo c gesla"), ("№ 5!", "nr 5"), ("A--B", "a b"), ("", "")])
def test_normalize_text(spark, text, want):
    assert one(spark, textfuncs.normalize_text(lit(text))) == want


@pytest.mark.parametrize(("text", "value", "used"), [("12 x", 12, 1), ("sto dwa", 102, 2), ("dwiescie i trzydziesci i piec", 235, 5), ("pietnascie", 15, 1), ("osiemdziesiat", 80, 1), ("nic", None, None), ("sto", 100, 1), ("dwudziesty piaty", 25, 2), ("druga", 2, 1), ("setny", 100, 1), ("sto oraz dwa", 102, 3), ("sto i", 100, 2), ("zero", 0, 1), ("sto dwunasty trzy", 112, 2), ("dwa sto", 2, 1), ("stos", None, None)])
def test_spoken_numbers(spark, text, value, used):
    x = one(spark, textfuncs.parse_spoken_number(F.split(lit(text), " ")))
    assert (x and x["value"], x and x["used"]) == (value, used)


def test_small_text_functions(spark):
    assert one(spark, textfuncs.explicit_number(lit("teraz Numer startowy 123"))) == 123
    assert one(spark, textfuncs.descriptor_tokens(lit("b, A;a|| c/ d,e,f"))) == ["a", "b", "c", "d", "e"]
    assert one(spark, textfuncs.canonical_people_count(lit("10+"))) == "large_group"
    assert one(spark, textfuncs.canonical_people_count(lit("Duet"))) == "duet_trio"
    assert one(spark, textfuncs.canonical_people_count(lit("x"))) is None and one(spark, textfuncs.canonical_people_count(lit("-1"))) is None
    assert one(spark, textfuncs.canonical_people_count(lit("quartet"))) == "quartet" and one(spark, textfuncs.type_code(lit(" Dance "))) == "D"
    assert one(spark, textfuncs.normalize_rel_path(lit("a/../b"))) is None
    assert one(spark, textfuncs.merged_type(lit("ceremony"), lit(""))) == "ceremony"
    assert one(spark, textfuncs.type_code(lit("q"))) == "?"
    assert one(spark, textfuncs.mode_with_tiebreak(F.array(*map(lit, ["b", "a", "b", "a"])), lit("b"))) == "b"
    assert one(spark, textfuncs.mode_with_tiebreak(F.array(*map(lit, ["b", "a", "c"])), lit("z"))) == "a"
    import hashlib

    parts = ["d1", 'a"b', "x", "v1"]
    assert one(spark, textfuncs.candidate_id(*map(lit, parts))) == hashlib.sha1(json.dumps(parts, separators=(",", ":")).encode()).hexdigest()[:16]


def test_vectors(spark):
    v = lambda *x: F.array(*map(F.lit, map(float, x)))
    assert one(spark, vectors.cosine_distance(v(1, 0), v(0, 2))) == 1.0
    assert one(spark, vectors.safe_divide(lit(0.0), lit(0.0))) == 0.0
    assert one(spark, vectors.safe_divide(lit(-2.0), lit(0.0))) == float("-inf")
    with pytest.raises(Exception, match="zero vector"):
        one(spark, vectors.cosine_distance(v(0, 0), v(1, 0)))


def answer(decision="different_segments", kinds=("dance", "ceremony"), notes=(("f1", "group_a", "n1"), ("f2", "group_b", "n2"), ("f3", "group_b", "n3")), evidence=("e", " "), summary="s"):
    return json.dumps({"decision": decision, "group_a_segment_type": kinds[0], "group_b_segment_type": kinds[1], "frame_notes": [dict(zip(("frame_id", "group", "note"), n, strict=True)) for n in notes], "primary_evidence": list(evidence), "summary": summary})


GOOD = "Group A segment type: dance | Group B segment type: ceremony | Frame notes: f1(group_a)=n1; f2(group_b)=n2; f3(group_b)=n3 | Primary evidence: e | Summary: s"
NOTES = (("f1", "group_a", "n1"), ("f2", "group_b", "n2"), ("f3", "group_b", "n3"))


@pytest.mark.parametrize(
    ("raw", "reason", "decision"),
    [
        ("```json\n" + answer() + "\n```", GOOD, "cut_after_1"), ("so: " + answer() + " done", GOOD, "cut_after_1"), (answer("same_segment"), GOOD, "no_cut"), ("none", "JSON parse error", "invalid_response"), ("{broken", "JSON parse error", "invalid_response"),
        (answer("cut_after_1"), "Invalid decision value: cut_after_1", "invalid_response"), (answer(kinds=("performance", "dance")), "Missing or invalid group segment type value", "invalid_response"),
        (answer(notes=NOTES[:2]), "Missing frame_notes value for f3", "invalid_response"), (answer(notes=(*NOTES[:2], NOTES[0])), "duplicate frame_id: f1", "invalid_response"), (answer(notes=(*NOTES[:2], ("f9", "group_b", "n"))), "Invalid frame_id value: f9", "invalid_response"),
        (answer(notes=(*NOTES[:2], ("f3", "group_a", "n"))), "Invalid group for f3: expected group_b, got group_a", "invalid_response"), (answer(notes=(*NOTES[:2], ("f3", "group_b", " "))), "Missing frame_notes value for f3", "invalid_response"),
        (answer(evidence=(" ",)), "Missing primary_evidence values", "invalid_response"), (answer(summary=""), "Missing summary value", "invalid_response"), ('{"decision": "same_segment", "group_a_segment_type": "dance", "group_b_segment_type": "dance"}', "Missing frame_notes array", "invalid_response"),
    ],
)
def test_window_responses(spark, raw, reason, decision):
    df = spark.createDataFrame([(raw, ["f1"], ["f2", "f3"])], "raw_response string, group_a_ids array<string>, group_b_ids array<string>")
    r = jsonfuncs.parse_window_response(df).first()
    assert (r["reason"], r["decision"]) == (reason, decision)
    if "segment type value" in reason:
        loose = jsonfuncs.parse_window_response(df, strict=False).first()
        assert loose["response_status"] == "ok" and (loose["semantic_group_a_segment_type"], loose["semantic_group_b_segment_type"]) == ("", "dance")


def test_open_interval_is_the_previous_set(spark):
    photos = spark.createDataFrame([("d", i, 1000 * i) for i in range(1, 9)], "day_id string, photo_id long, start_epoch_ms long")
    sets = spark.createDataFrame([("d", "a", 2000, 3000), ("d", "b", 4000, None), ("d", "c", 7000, 7500)], "day_id string, set_id string, set_start_ms long, set_end_ms long")
    got = {r["photo_id"]: (r["previous_set"], r["next_set"], r["reason"]) for r in timeline.unassigned_with_neighbors(photos, photos.where("photo_id in (2, 7)"), sets).collect()}
    assert got == {1: (None, "a", "before_first"), 3: ("a", "b", "between"), 4: ("b", "c", "between"), 5: ("b", "c", "between"), 6: ("b", "c", "between"), 8: ("c", None, "after_last")}


@pytest.mark.parametrize(("score", "label", "left", "right", "want"), [(0.9, "hard", 1.0, 1.0, "boundary_score"), (0.96, "soft", 1.0, 0.9, "segment_confidence"), (0.96, "soft", 0.9, 1.0, "segment_confidence"), (0.96, "soft", 1.0, 1.0, "boundary_label"), (1.0, "hard", 0.95, 1.0, None)])
def test_review_reason(spark, score, label, left, right, want):
    assert one(spark, boundaries.review_reason(*map(F.lit, (score, label, left, right)))) == want


def test_frame_selection_rules(spark):
    """Expected rows worked out by hand from the rules, for times 0, 10, 20, 90, 100."""
    df = spark.createDataFrame([("r", i, float(t)) for i, t in enumerate((0, 10, 20, 90, 100))], "run_id string, idx int, ts double")
    pick = lambda schema, side, radius: sorted(r["idx"] for r in dataset.select_side_frames(df, radius, schema, side).collect())
    assert pick("time_quantile", "right", 3) == [0, 2, 4] and pick("index_quantile", "left", 2) == [0, 4] and pick("index_quantile", "left", 4) == [0, 1, 3, 4]
    assert pick("time_max_min", "left", 3) == [0, 2, 4] and pick("time_boundary_spread", "left", 2) == [0, 4] and pick("time_boundary_spread", "right", 3) == [0, 2, 4]
    assert pick("time_max_min", "left", 1) == [0] and pick("index_quantile", "right", 1) == [4]
    df = df.where("idx < 4")  # the middle goal lies between two rows: the one farther from the cut is taken
    assert pick("index_quantile", "left", 3) == [0, 1, 3] and pick("index_quantile", "right", 3) == [0, 2, 3]


def test_detections(spark):
    d = spark.createDataFrame([Row(id=1, d=Row(event_type="Show", start_number="5", category_ordinal="2", title=" ", evidence="nr 7", notes=None, confidence=0.5))], "id int, d struct<" + ",".join(x.replace(" ", ":", 1) for x in jsonfuncs.DETECTION.split(", ")) + ">")
    x = d.select(jsonfuncs.normalize_detection(F.col("d")).alias("x")).first()["x"]
    assert x["event_type"] == "other" and x["start_number"] is None and x["title"] is None and x["category_ordinal"] == 2
    assert one(spark, jsonfuncs.flatten_descriptors(lit('{"a": {"b c": ["x", "y"], "d": 1}, "e.f": "z"}'))) == {"a_b_c": ["x", "y"], "a_d": ["1"], "e_f": ["z"]}
    flat = jsonfuncs.flatten_detections(spark.createDataFrame([(1, ["a", "b"]), (2, [])], "w int, detections array<string>"))
    assert {(r["w"], r["detection_index"]) for r in flat.collect()} == {(1, 1), (1, 2), (2, None)}


def photos(spark, ms, day="d"):
    return spark.createDataFrame([(day, i, t) for i, t in enumerate(ms)], "day_id string, photo_id long, start_epoch_ms long")


def test_windows_at_day_ends(spark):
    p = photos(spark, [0, 1000, 30000, 31000, 90000])
    rows = {r["photo_id"]: (r["window_status"], r["frames"]) for r in order.frame_windows(p, 2, 20, F.col("photo_id")).collect()}
    assert rows == {1: ("full", [0, 1, 2, 3]), 3: ("incomplete", [2, 3, 4])}
    assert [r["left_photo_id"] for r in order.gap_candidates(order.adjacent_pairs(p, ["photo_id", "start_epoch_ms"]), 29).collect()] == [3]
    starts = [(r["start_row"], r["cut_index"]) for r in order.centered_windows(p, 2, 20).collect()]
    assert starts == [(0, 1), (1, 3)]
    assert sorted((r["start_row"], r["end_row"]) for r in order.stride_windows(p, 2).collect()) == [(0, 4), (1, 5)]


def brute_min_segments(rows, min_photos, min_s):
    rows = [dict(r) for r in rows]
    while len(rows) > 1:
        small = [i for i, r in enumerate(rows) if r["photo_count"] < min_photos or (r["end_ms"] - r["start_ms"]) / 1000 < min_s]
        if not small:
            break
        i = small[0]
        left = rows[i]["left_score"] if i else None
        right = rows[i]["right_score"] if i + 1 < len(rows) else None
        j = i - 1 if right is None or (left is not None and left <= right) else i
        a, b = rows[j], rows[j + 1]
        rows[j : j + 2] = [{**a, "end_ms": b["end_ms"], "photo_count": a["photo_count"] + b["photo_count"], "right_score": b["right_score"]}]
    return [(r["start_ms"], r["end_ms"], r["photo_count"]) for r in rows]


def test_min_segments_equals_rescan(spark):
    rnd, rows = random.Random(5), []
    for day in range(60):
        n, t = rnd.randint(1, 9), 0
        cuts = [None, *[round(rnd.choice([0.75, 0.8, 0.9, 1.0]), 2) for _ in range(n - 1)], None]
        for i in range(n):
            c, span = rnd.randint(1, 14), rnd.randint(0, 12) * 1000
            rows.append((f"d{day}", i, i * 10, i * 10 + 5, t, t + span, c, cuts[i], cuts[i + 1]))
            t += span + 1000
    schema = "day_id string, segment_index long, start_photo_id long, end_photo_id long, start_ms long, end_ms long, photo_count long, left_score double, right_score double"
    df = spark.createDataFrame(rows, schema)
    got: dict = {}
    for r in boundaries.enforce_min_segments(df).orderBy("day_id", "segment_index").collect():
        got.setdefault(r["day_id"], []).append((r["start_ms"], r["end_ms"], r["photo_count"]))
    names = [x.split()[0] for x in schema.split(", ")]
    for day in got:
        assert got[day] == brute_min_segments([dict(zip(names, r, strict=True)) for r in rows if r[0] == day], 8, 5)


def test_scores_and_labels(spark):
    rows = [("d", 1, 89.999, 0.0, 0.0), ("d", 2, 90.0, 0.0, 0.0), ("d", 3, 20.0, 0.3, 1.2), ("d", 4, 20.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "day_id string, i int, time_gap_seconds double, distance double, smoothed_zscore double")
    got = {r["i"]: (r["boundary_label"], round(r["boundary_score"], 4)) for r in boundaries.boundary_score(df).collect()}
    assert got[1] == ("none", 0.0) and got[2] == ("hard", 1.0) and got[4] == ("none", 0.0) and got[3] == ("soft", round(0.75 * 0.4 + 0.25 * (0.3 / 0.35) + 0.25, 4))
    assert validate.label_score(boundaries.boundary_score(df), "i").count() == 0


def test_merge_and_timeline(spark):
    rows = [("d", 1, 7, "v-1", 0, 1000, 0.9), ("d", 2, 7, "v-2", 12000, 13000, 0.8), ("d", 3, 8, "v-1", 13000, 14000, 0.9), ("d", 4, 7, "v-1", 14000, 15000, 0.7), ("d", 5, 7, "v-1", 26001, 27000, 0.7)]
    c = spark.createDataFrame(rows, "day_id string, id long, number long, stream_id string, start_ms long, end_ms long, confidence double")
    m = timeline.merge_candidates(c)
    assert [(r["number"], r["candidate_count"]) for r in m.orderBy("group_index").collect()] == [(7, 2), (8, 1), (7, 1), (7, 1)]
    t = timeline.build_timeline(m).orderBy("group_index").collect()
    assert [r["status"] for r in t] == ["invalid_overlap", "invalid_overlap", "complete", "open_end"] and [r["duplicate_status"] for r in t] == ["normal", "normal", "duplicate_near", "duplicate_near"]


def test_assignment_edges(spark):
    t = spark.createDataFrame([("d", "a", 1000, 5000), ("d", "b", 4000, 9000), ("d", "c", 20000, None)], "day_id string, set_id string, set_start_ms long, set_end_ms long")
    p = photos(spark, [0, 1000, 4500, 5000, 9000, 25000])
    got = {r["photo_id"]: r["set_id"] for r in timeline.assign_to_intervals(p, t, 2).collect()}
    assert got == {1: "a", 2: "a", 3: "b", 5: "c"}
    left = {r["photo_id"]: (r["previous_set"], r["next_set"], r["reason"]) for r in timeline.unassigned_with_neighbors(p, timeline.assign_to_intervals(p, t, 2), t).collect()}
    assert left == {0: (None, "a", "before_first"), 4: ("b", "c", "between")}
    assert {r["photo_id"] for r in timeline.assign_to_intervals(p, t, 2, include_open_end=False).collect()} == {1, 2, 3}


def test_robust_offset(spark):
    rows = [("d", "a", x, 0.9, "ok") for x in (1.0, 1.1, 0.9, 50.0)] + [("d", "b", 5.0, 0.1, "ok")] + [("d", "c", x, 0.9, "ok") for x in (0.0, 100.0)]
    got = {r["stream_id"]: r for r in sync.robust_offset(spark.createDataFrame(rows, "day_id string, stream_id string, correction_s double, score double, status string"), 0.5, 2).collect()}
    assert got["a"]["correction_seconds"] == 1.0 and got["a"]["successful_pairs"] == 3 and got["b"]["correction_seconds"] == 0.0 and got["b"]["notes"] == "no usable pair" and got["c"]["correction_seconds"] == 50.0


def test_lag_correlation(spark):
    rnd = random.Random(1)
    base = [rnd.random() for _ in range(400)]
    rows = [(1, base[20:320], base[5:305]), (2, [1.0] * 9, base[:9]), (3, [1.0], [1.0])]
    got = {r["i"]: (r["lag"], r["status"]) for r in sync.lag_correlation(spark.createDataFrame(rows, "i int, envelope_a array<double>, envelope_b array<double>"), 40).collect()}
    assert got[1] == (-15, "ok") and got[2][1] == "flat" and got[3][1] == "too_short"


def test_announcements(spark):
    rows = [(1, "Numer 5 kategoria junior"), (2, "prosze numer sto dwa"), (3, "numer numer 5"), (4, "bez liczby"), (5, "nr dwadzieścia trzy")]
    got = sorted((r["i"], r["performance_number"], r["match_method"], round(r["confidence"], 2)) for r in transcripts.announcement_candidates(spark.createDataFrame(rows, "i int, text string")).collect())
    assert got == [(1, 5, "digits", 0.99), (2, 102, "words", 0.94), (3, 5, "digits", 0.98), (5, 23, "words", 0.94)]


def test_review_replay(spark):
    p = spark.createDataFrame([("d", "s1", i, f"f{i}") for i in range(4)] + [("d", "s2", 0, "g0")], "day_id string, set_id string, pos int, filename string")
    cuts = spark.createDataFrame([("d", "s1", "f2"), ("d", "s1", "f0"), ("d", "s1", "nope")], "day_id string, base_set_id string, start_filename string")
    split = review.apply_splits(p, cuts)
    assert sorted({r["set_id"] for r in split.collect()}) == ["s1", "s1::f2", "s2"]
    merges = spark.createDataFrame([("d", 1, "s2", "s1"), ("d", 2, "s1", "s1::f2"), ("d", 3, "s2", "s1::f2")], "day_id string, seq int, target_set_id string, source_set_id string")
    assert {r["set_id"] for r in review.apply_merges(split, merges).collect()} == {"s2"}


@pytest.mark.parametrize("schema", ["consecutive", "random", "index_quantile", "time_quantile", "time_max_min", "time_boundary_spread"])
@pytest.mark.parametrize("side", ["left", "right"])
def test_frame_selection(spark, schema, side):
    df = spark.createDataFrame([("r", i, float(i * i)) for i in range(10)] + [("s", 0, 1.0)], "run_id string, idx int, ts double")
    rows = dataset.select_side_frames(df, 3, schema, side).collect()
    big = sorted(r["idx"] for r in rows if r["run_id"] == "r")
    assert len(big) == 3 and len(rows) == 4
    if schema == "consecutive":
        assert big == ([7, 8, 9] if side == "left" else [0, 1, 2])


def test_splits(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(101)], "id long, k string")
    fractions = {"train": 0.7, "validation": 0.15, "test": 0.15}
    got = {r["split_name"]: r["count"] for r in dataset.random_split(df, "id", fractions, 3).groupBy("split_name").count().collect()}
    assert got == {"train": 71, "validation": 15, "test": 15}
    out = dataset.stratified_split(df, "id", ["k"], fractions, 3).groupBy("k", "split_name").count().collect()
    assert sum(r["count"] for r in out) == 101
    plan = dataset.stratified_plan({("x", "rare"): 3}, fractions, {"rare"})
    assert plan[("x", "rare")] == {"train": 1, "validation": 1, "test": 1}


def test_stratified_split_in_buckets(spark, monkeypatch):
    """Ranks are made in buckets of a stratum, and are those of the whole stratum in hash order."""
    monkeypatch.setattr(dataset, "BUCKET_ROWS", 20, raising=False)
    fractions = {"train": 0.8, "validation": 0.1, "test": 0.1}
    rows = [(i, "a" if i % 10 else None) for i in range(400)]
    out = dataset.stratified_split(spark.createDataFrame(rows, "id int, k string"), "id", ["k"], fractions, 3)
    got = {r["id"]: r["split_name"] for r in out.collect()}
    assert len(got) == 400 and out.columns == ["id", "k", "split_name"]
    for k in ("a", None):
        ids = sorted((i for i, x in rows if x == k), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())
        own = dataset.stratified_plan({("a",): 360, (None,): 40}, fractions, None, 0)[(k,)]
        assert [got[i] for i in ids] == ["train"] * own["train"] + ["validation"] * own["validation"] + ["test"] * own["test"]
    windows = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)\)", out._jdf.queryExecution().optimizedPlan().toString())
    assert windows and all("_b" in w for w in windows)


def test_merges_run_by_day(spark, monkeypatch):
    from eventweave.plans import registry

    seen = []
    real = review.merge_map
    monkeypatch.setattr(review, "merge_map", lambda sets, merges: seen.append(sets.select("day_id").distinct().count()) or real(sets, merges))
    registry.queries()["apply_merges"](spark, "/root/testdata/sf0.001")
    assert seen[0] > 1


def test_metrics(spark):
    df = spark.createDataFrame([("d", 1, False, True), ("d", 2, False, True), ("d", 3, True, False), ("e", 1, False, True)], "day_id string, i int, t boolean, p boolean")
    got = {r["day_id"]: (r["merge_runs"], r["split_actions"]) for r in metrics.review_cost(df, F.col("t"), F.col("p"), ["i"]).collect()}
    assert got == {"d": (1, 1), "e": (1, 0)}
    assert metrics.binary_metrics(df.where("not t and not p"), F.col("t"), F.col("p")).first()["f1"] == 0.0


def test_contract_errors(spark):
    manifest = spark.createDataFrame([("a", "train"), ("a", "test")], "candidate_id string, split_name string")
    with pytest.raises(Exception, match="doubled key"):
        dataset.join_split_manifest(spark.createDataFrame([("a",)], "candidate_id string"), manifest).collect()
    with pytest.raises(ValueError, match="unique"):
        validate.assert_valid(validate.unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"]))
    assert validate.feature_contract(manifest, ["candidate_id", "x"]) == ["missing x", "unknown split_name"]
