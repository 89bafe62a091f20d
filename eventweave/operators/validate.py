"""Data contracts: each rule gives violations (rule, key, detail); assert_valid fails with the first of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.functions.textfuncs import candidate_id
from eventweave.operators import ranges
from eventweave.operators.dataset import feature_columns, registry_of


def _found(df: DataFrame, rule: str, key: Column | str, bad: Column, detail: Column | None = None) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    return df.where(F.coalesce(bad, F.lit(True))).select(F.lit(rule).alias("rule"), k.cast("string").alias("key"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))


def checks(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row for each row and rule whose condition is not true (a null condition counts as broken), in one pass."""
    hits = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(hits).alias("rule")).select("rule", "key", F.lit("").alias("detail"))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _found(n, "unique", F.concat_ws("|", *keys), F.col("n") > 1, F.col("n"))


def coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of only one side."""
    both = a.select(key, F.lit(1).alias("_a")).join(b.select(key, F.lit(1).alias("_b")), key, "full_outer")
    return _found(both, "coverage", key, F.col("_a").isNull() | F.col("_b").isNull(), F.when(F.col("_a").isNull(), "only right").otherwise("only left"))


def time_order(df: DataFrame, day: str, index: str, time: str, key: str) -> DataFrame:
    """Dense index from 0 and times that do not fall, per day. Looked at by ranges of the index."""
    rows = df.select(F.col(day).alias(ranges.DAY), F.col(index).alias("_index"), F.col(time).alias("_time"), F.col(key).alias("_key"))
    order = ("_index", "_key")
    near = ranges.with_halo(ranges.with_ranges(rows, order), order, 1, 0).withColumn("_before", F.lag("_time").over(ranges.in_range(order)))
    placed = ranges.running(near.where(ranges.OWN).drop(ranges.OWN), order, F.lit(1).cast("long"), "_place")
    bad = (F.col("_index") != F.col("_place") - 1) | F.coalesce(F.col("_time") < F.col("_before"), F.lit(False))
    return _found(placed, "time_order", "_key", bad)


def pair_chain(pairs: DataFrame, day: str, order: str, left: str, right: str, left_ms: str | None = None, right_ms: str | None = None, gap_s: str | None = None) -> DataFrame:
    """Each pair's left is the previous pair's right (rule pair_chain), and its gap is the difference of its times (rule pair_gap)."""
    rows = pairs.withColumnRenamed(day, ranges.DAY) if day != ranges.DAY else pairs
    by = (order, left)
    near = ranges.with_halo(ranges.with_ranges(rows, by), by, 1, 0).withColumn("_before", F.lag(right).over(ranges.in_range(by)))
    out = _found(ranges.own_rows(near), "pair_chain", left, F.col("_before").isNotNull() & (F.col("_before") != F.col(left)))
    if gap_s is None:
        return out
    off = F.abs(F.col(gap_s) - (F.col(right_ms) - F.col(left_ms)) / 1000.0) > 1e-6
    return out.union(_found(pairs, "pair_gap", left, off, F.col(gap_s)))


def label_score(scores: DataFrame, key: str) -> DataFrame:
    s, label = F.col("boundary_score"), F.col("boundary_label")
    ok = s.between(0, 1) & F.when(label == "none", s < 0.75).when(label.isin("soft", "hard"), s >= 0.75).otherwise(False)
    return _found(scores, "label_score", key, ~ok)


def segment_coverage(segments: DataFrame, totals: DataFrame, day: str) -> DataFrame:
    """Segment photo counts add up to the day's photos."""
    n = segments.groupBy(day).agg(F.sum("photo_count").alias("n")).join(totals.select(day, F.col("photos").alias("m")), day, "full_outer")
    return _found(n, "segment_coverage", day, ~F.col("n").eqNullSafe(F.col("m")), F.concat_ws("/", "n", "m"))


def segment_contiguity(segments: DataFrame, totals: DataFrame, day: str) -> DataFrame:
    """Segments (segment_index, start_index, end_index, photo_count) follow each other: the first begins at 0, each next one after the end
    of the one before (rule contiguous), each has as many photos as places (rule photo_count), and the last ends at the day's last photo
    (rule covered). One row a segment, so the neighbours are found in a window by day."""
    w = Window.partitionBy(day).orderBy("segment_index", "start_index")
    rows = segments.withColumns({"_before": F.coalesce(F.lag("end_index").over(w), F.lit(-1)), "_last": F.lead(F.lit(1)).over(w).isNull()})
    rows = rows.join(totals.select(day, F.col("photos").alias("_photos")), day, "left")
    key = F.concat_ws("|", day, "segment_index")
    out = _found(rows, "contiguous", key, F.col("start_index") != F.col("_before") + 1, F.concat_ws("/", F.col("_before") + 1, "start_index"))
    out = out.union(_found(rows, "photo_count", key, F.col("photo_count") != F.col("end_index") - F.col("start_index") + 1, F.col("photo_count")))
    return out.union(_found(rows.where("_last"), "covered", key, F.col("end_index") != F.col("_photos") - 1, F.concat_ws("/", "end_index", F.col("_photos") - 1)))


def candidate_rows(rows: DataFrame, radius: int) -> DataFrame:
    """Rules that candidate rows of a table with 2 * radius frames break, by candidate_id: blank required texts, a radius (of the row, or in
    the rule's parameters) that isn't the table's, ids of the window unlike those of the frame columns, centre photos out of place, falling
    times, an id that doesn't recompute from day, centre and rule, unknown splits, a boundary that isn't the inequality of the segments."""
    size = 2 * radius
    frame = lambda name: F.array(*(F.col(f"frame_{i:02d}_{name}") for i in range(1, size + 1)))
    ids, times = frame("photo_id").cast("array<string>"), frame("timestamp")
    version = F.concat_ws("|", "candidate_rule_version", "candidate_rule_params_json")
    needed = ("day_id", "candidate_id", "candidate_rule_name", "candidate_rule_version", "center_left_photo_id", "center_right_photo_id", "left_segment_id", "right_segment_id")
    filled = reduce(Column.__and__, (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "" for c in needed))
    center = (F.get(ids, radius - 1) == F.col("center_left_photo_id").cast("string")) & (F.get(ids, radius) == F.col("center_right_photo_id").cast("string"))
    return checks(
        rows,
        "candidate_id",
        {
            "blank": filled & F.forall(ids, lambda x: F.coalesce(F.trim(x), F.lit("")) != ""),
            "radius": F.col("window_radius") == radius,
            "params": F.get_json_object("candidate_rule_params_json", "$.window_radius") == F.col("window_radius").cast("string"),
            "window": F.col("window_photo_ids").cast("array<string>") == ids,
            "center": center,
            "times": reduce(Column.__and__, (F.get(times, i) <= F.get(times, i + 1) for i in range(size - 1))),
            "id": F.col("candidate_id") == candidate_id(*map(F.col, ("day_id", "center_left_photo_id", "center_right_photo_id")), version),
            "split": F.coalesce(F.trim("split_name"), F.lit("")).isin("", "train", "validation", "test"),
            "boundary": F.col("boundary") == (F.col("left_segment_id") != F.col("right_segment_id")),
        },
    )


def attrition_sums(report: DataFrame, key: str) -> DataFrame:
    parts = [F.col(c) for c in ("missing_artifact", "missing_truth", "missing_window", "retained")]
    return _found(report, "attrition_sums", key, F.col("generated") != reduce(Column.__add__, parts))


def split_manifest(rows: DataFrame, key: str, required: list[str], kind: str) -> DataFrame:
    """One split per key; each required class in validation and test."""
    one = rows.groupBy(key).agg(F.count_distinct("split_name").alias("n"))
    bad = _found(one, "single_split", key, F.col("n") != 1, F.col("n"))
    seen = rows.where("split_name in ('validation', 'test')").groupBy("split_name").agg(F.collect_set(kind).alias("seen"))
    lacking = seen.withColumn("missing", F.array_except(F.array(*map(F.lit, required)), "seen"))
    return bad.union(_found(lacking, "required_classes", "split_name", F.size("missing") > 0, F.array_join(F.array_sort("missing"), ",")))


def split_classes(rows: DataFrame, required: list[str], sides: tuple[str, str] = ("left_segment_type", "right_segment_type"), splits: tuple[str, ...] = ("validation", "test")) -> DataFrame:
    """Each required class on both sides of each held-out split; a split without any row lacks them all."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(s, side, c) for s in splits for side in sides for c in required], "split_name string, side string, class string")
    seen = None
    for side in sides:
        own = rows.where(F.col("split_name").isin(*splits)).select("split_name", F.lit(side).alias("side"), F.col(side).alias("class")).distinct()
        seen = own if seen is None else seen.union(own)
    lacking = wanted.join(seen, ["split_name", "side", "class"], "left_anti")
    return _found(lacking, "required_classes", F.concat_ws("|", "split_name", "side"), F.lit(True), F.col("class"))


def one_contract(rows: DataFrame, contract: list[str]) -> DataFrame:
    n = rows.agg(F.count_distinct(F.struct(*contract)).alias("n"))
    return _found(n, "one_contract", F.lit("corpus"), F.col("n") > 1, F.col("n"))


def feature_contract(df: DataFrame, expected: list[str]) -> list[str]:
    """Names that differ from the expected list (metadata only)."""
    return [f"missing {c}" for c in expected if c not in df.columns] + [f"unknown {c}" for c in df.columns if c not in expected]


def model_contract(columns: list[str], radius: int, mode: str = "tabular") -> list[str]:
    """What differs between a model's feature columns and those that follow from its radius, its mode and the registry that its own
    columns tell (metadata only)."""
    expected = feature_columns(radius, registry_of(columns), mode)
    found = [f"missing {c}" for c in expected if c not in columns] + [f"unknown {c}" for c in columns if c not in expected]
    return found or (["order of columns"] if list(columns) != expected else [])


def descriptor_record(df: DataFrame, key: str, required: list[str], enums: dict[str, list[str]]) -> DataFrame:
    """Column values (map<string, array<string>>): required fields are there, enumerated ones hold allowed values."""
    rules = {f"required:{f}": F.map_contains_key("values", f) for f in required}
    inside = lambda f, allowed: F.forall(F.coalesce(F.element_at("values", f), F.array().cast("array<string>")), lambda v: v.isin(allowed))
    rules |= {f"enum:{f}": inside(f, a) for f, a in enums.items()}
    return checks(df, key, rules)


def assert_valid(violations: DataFrame, limit: int = 5) -> None:
    first = violations.limit(limit).collect()
    if first:
        raise ValueError("; ".join(f"{r['rule']}: {r['key']} {r['detail']}".strip() for r in first))
