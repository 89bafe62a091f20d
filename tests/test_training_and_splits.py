"""Split plans, the training view and its contract, answers with several objects, descriptors of any depth."""

from __future__ import annotations

import json
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from eventweave.functions import jsonfuncs
from eventweave.operators import dataset, validate
from eventweave.plans import registry

FRACTIONS = {"train": 0.7, "validation": 0.15, "test": 0.15}


@pytest.mark.parametrize("n", [30, 45, 50, 70, 130])
def test_stratified_totals_are_its_sql(spark, tmp_path, n):
    """Numbers of documents whose three rounded shares do not add up to them, too."""
    rows = [(i, "t", ("en", "de", "fr")[i % 3], ("web", "book")[i % 2], 1) for i in range(n)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(registry.oracle_sql()["stratified_totals"]).fetchall()
    assert sorted(map(tuple, registry.queries()["stratified_totals"](spark, str(tmp_path)).collect())) == sorted(want)


@pytest.mark.parametrize("seed", range(40))
def test_plans_have_their_totals(seed):
    r = random.Random(seed)
    counts = {(b, k): r.choice([1, 1, 2, 3, 9, 40]) for b in (True, False) for k in "xyz" if r.random() < 0.9} or {(True, "x"): 9}
    total = sum(counts.values())
    required = {k for k in "xyz" if sum(n for c, n in counts.items() if c[1] == k) >= 2 and r.random() < 0.5}
    if total < 1 + 2 * max(1, len(required)):
        with pytest.raises(ValueError, match="fewer than"):
            dataset.stratified_plan(counts, FRACTIONS, required)
        return
    plan = dataset.stratified_plan(counts, FRACTIONS, required)
    totals = {s: sum(own[s] for own in plan.values()) for s in FRACTIONS}
    least = max(1, len(required))
    assert {k: sum(own.values()) for k, own in plan.items()} == counts and min(min(own.values()) for own in plan.values()) >= 0
    assert totals == dataset.split_totals(total, FRACTIONS, {"train": 1, "validation": least, "test": least}) and sum(totals.values()) == total
    assert all(abs(totals[s] - total * 0.15) <= 1 or totals[s] == least for s in ("validation", "test"))
    for s in ("validation", "test"):
        assert required <= {k[1] for k, own in plan.items() if own[s]}


def test_one_row_strata_and_refusals():
    plan = dataset.stratified_plan({(i % 2 == 0, f"k{i}"): 1 for i in range(20)}, FRACTIONS)
    assert [sum(own[s] for own in plan.values()) for s in FRACTIONS] == [14, 3, 3]
    with pytest.raises(ValueError, match="no rows to hold out for 'a'"):
        dataset.stratified_plan({(True, "a"): 1, (True, "b"): 30}, FRACTIONS, {"a"})
    # both values of the boundary are held out where a class has them
    kept = dataset.reserved_rows({(True, "a"): 2, (False, "a"): 5, (True, "b"): 1, (False, "b"): 1, (True, "c"): 1}, ["validation", "test"], ["a", "b"], {"train": 6, "validation": 2, "test": 2}, 1)
    assert all({k[0] for k, own in kept.items() if own.get(s)} == {True, False} for s in ("validation", "test"))


def test_both_sides_are_required(spark):
    rows = [(i, i % 2 == 0, "a" if i % 4 < 2 else "b", "a") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, boundary boolean, right string, left string")
    out = dataset.stratified_split(df, "id", ["boundary", "right"], FRACTIONS, 1, {"a", "b"})
    assert {r["split_name"]: r["count"] for r in out.groupBy("split_name").count().collect()} == {"train": 28, "validation": 6, "test": 6}
    with pytest.raises(ValueError, match="missing in left"):
        dataset.stratified_split(df, "id", ["boundary", "right"], FRACTIONS, 1, {"a", "b"}, left="left")


REGISTRY = {"colour": False, "props": True}


def view(spark, radius=1, boundary="Yes", mode="tabular"):
    rows = [("c1", "d", radius, [1, 2], [0, 4000], ["t1", None], " Dance", "break", boundary), ("c2", "e", radius, [2, 9], [0, 1000], ["t2", "t9"], "dance", "dance", "0")]
    c = spark.createDataFrame(rows, "candidate_id string, day_id string, window_radius int, frame_ids array<int>, frame_ms array<long>, thumb_paths array<string>, left_segment_type string, right_segment_type string, boundary string")
    m = spark.createDataFrame([("d", "train"), ("e", "test")], "day_id string, split_name string")
    s = spark.createDataFrame([(1, 2, 0.5, 0.7, 1.0, 1.5, 0.25, "soft")], "left_photo_id int, right_photo_id int, distance double, boundary_score double, zscore double, smoothed_zscore double, time_gap_boost double, boundary_label string")
    d = spark.createDataFrame([(1, {"colour": ["red"], "props": ["b", "a;c"]}), (2, {"colour": ["blue"]})], "photo_id int, values map<string, array<string>>")
    return dataset.training_view(c, m, s, d, 1, REGISTRY, mode)


def test_training_view(spark):
    for mode in ("tabular", "tabular_plus_thumbnail"):
        v = view(spark, mode=mode)
        columns = dataset.feature_columns(1, REGISTRY, mode)
        assert v.columns == ["candidate_id", "day_id", "split_name", *dataset.LABELS, "missing_pairs", "missing_frames", *columns]
        assert dataset.registry_of(columns) == REGISTRY and validate.model_contract(columns, 1, mode) == []
    got = {r["candidate_id"]: r for r in v.collect()}
    a, b = got["c1"], got["c2"]
    assert (a["split_name"], a["left_segment_type"], a["right_segment_type"], a["boundary"], a["missing_pairs"], a["missing_frames"]) == ("train", "dance", "break", True, 0, 0)
    assert (a["left_colour"], a["right_colour"], a["left_props_01"], a["left_props_03"], a["left_props_04"], a["right_props_01"]) == ("red", "blue", "a", "c", "__missing__", "__missing__")
    assert (a["heuristic_zscore_01_02"], a["heuristic_boundary_label_01_02"], a["center_gap"], a["frame_01_thumb_path"], a["frame_02_thumb_path"]) == (1.0, "soft", 4.0, "t1", "")
    assert math.isnan(b["heuristic_distance_01_02"]) and b["heuristic_boundary_label_01_02"] == "__missing__" and (b["missing_pairs"], b["missing_frames"], b["boundary"]) == (1, 1, False)
    views = dataset.label_views(v, columns)
    assert views["boundary"]["train"].columns == [*columns, "boundary"] and views["left_segment_type"]["test"].count() == 1 and views["boundary"]["validation"].count() == 0


def test_training_view_refusals(spark):
    columns = dataset.feature_columns(1, REGISTRY)
    with pytest.raises(ValueError, match="left_colour"):
        dataset.label_views(view(spark), [c for c in columns if c != "left_colour"])
    with pytest.raises(ValueError, match="their order"):
        dataset.label_views(view(spark), columns[::-1])
    with pytest.raises(Exception, match="window radius of c"):
        view(spark, radius=2).collect()
    with pytest.raises(Exception, match="boundary of c1"):
        view(spark, boundary="maybe").collect()
    assert validate.model_contract([c for c in columns if c != "right_props_02"], 1) == ["missing right_props_02"]
    assert validate.model_contract([*columns, "extra"], 1) == ["unknown extra"] and validate.model_contract(columns[1:] + columns[:1], 1) == ["order of columns"]
    assert validate.model_contract(columns, 2)[0].startswith("missing heuristic_distance_02_03")


def test_payload_among_several_objects(spark):
    own = '{"window_id": "w1", "detections": [{"t": "}{"}]}'
    other = '{"window_id": "w2", "detections": []}'
    batch = f'{{"results": [{own}, {other}]}}'
    rows = [(f"x {{ {other} {own} {other} y", "w1"), (f"```JSON\n{own}\n```", None), (f"<think>{own}</think>{other}", "w1"), ('{"window_id": 1, "detections": []}', None), (None, "w1"), ("", None), (f"{own}{other}", None), (batch, None)]
    df = spark.createDataFrame(rows, "text string, id string")
    one = [r[0] and json.loads(r[0])["window_id"] for r in df.select(jsonfuncs.detections_payload(F.col("text"), F.col("id"))).collect()]
    assert one == ["w1", "w1", None, None, None, None, "w2", None]
    many = [r[0] for r in df.select(jsonfuncs.detections_payload(F.col("text"), batch=True)).collect()]
    assert many[:7] == [None] * 7 and json.loads(many[7]) == json.loads(batch)


def test_descriptors_of_any_depth(spark):
    deep = {"a": {"b.c": {"d e": {"f": {"g": {"h": ["x", 2, None, {"k": True}], " ": 1}}}}}, "n": None, "z": 1.5, "t": True, "s": "ü", "o": {}}
    rows = [(json.dumps(deep),), ("[1]",), ("{broken",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(jsonfuncs.flatten_descriptors(F.col("t"))).collect()]
    assert got == [{"a_b_c_d_e_f_g_h": ["x", "2", '{"k":true}'], "z": ["1.5"], "t": ["true"], "s": ["ü"]}, None, None, None]
