"""Summaries of runs and jobs, work lists, benchmark cases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.functions.textfuncs import normalize_text
from eventweave.operators.review import best_candidate_for_set, nearby_conflicts

DAY = "day_id"
COUNTERS = ("generated", "missing_artifact", "missing_truth", "missing_window", "true_before", "true_after")


def job_status_summary(jobs: DataFrame) -> DataFrame:
    """jobs (stream_id, path, status, at, error): per stream the files by their last status, and the last error."""
    last = jobs.groupBy("stream_id", "path").agg(F.max_by("status", "at").alias("status"), F.max_by("error", F.when(F.col("error").isNotNull(), F.col("at"))).alias("error"))
    return last.groupBy("stream_id").agg(F.count(F.lit(1)).alias("files"), *(F.count_if(F.col("status") == s).alias(s) for s in ("done", "empty", "skipped", "failed")), F.max("error").alias("last_error"))


def label_durations(segments: DataFrame, label: str, seconds: str) -> DataFrame:
    return segments.groupBy(label).agg(F.count(F.lit(1)).alias("segment_count"), F.sum(seconds).alias("total_seconds"))


def corpus_attrition(days: DataFrame) -> DataFrame:
    return days.agg(*(F.sum(c).alias(c) for c in COUNTERS))


def work_list(df: DataFrame, keep: Column, order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows to work on: filtered, ordered, after ``offset``, at most ``limit``."""
    out = df.where(keep).orderBy(*order).offset(offset)
    return out if limit is None else out.limit(limit)


def join_variant(variant: DataFrame, manifest: DataFrame, key: str, path: str) -> DataFrame:
    """Rows of an image variant with their manifest row; a missing row or blank path is an error."""
    out = variant.join(manifest.withColumn("_m", F.lit(1)), key, "left")
    bad = F.when(F.col("_m").isNull(), "not in the manifest").when(F.coalesce(F.trim(path), F.lit("")) == "", "blank path")
    return out.withColumn(path, F.when(bad.isNotNull(), F.raise_error(F.concat(bad, F.lit(": "), F.col(key).cast("string"))).cast("string")).otherwise(F.col(path))).drop("_m")


def benchmark_cases(
    sets: DataFrame,
    candidates: DataFrame,
    segments: DataFrame,
    ordinals: dict[str, int],
    min_photos: int,
    max_s: float,
    before: int = 2,
    after: int = 2,
    trim: bool = True,
) -> DataFrame:
    """A case for each set (day_id, set_id, number, photo_count, first_ms) with a number and enough photos whose number a candidate
    (day_id, stream_id, clip, segment_index, id, number, start_ms) announces within max_s, with the window of segments (day_id, stream_id,
    clip, segment_index, start_ms, end_ms, text, trigger_types) around it.

    The ordinal that is expected is that of the window's first token in ``ordinals``. The difficulty adds 1 for the number standing in the
    text, 2 for an ordinal, 1 for a trigger of class ``category``, and the candidates of other numbers near the window's start, 3 at most.
    Sets without a candidate, and candidates without their segment, make no case."""
    able = sets.where(F.col("number").isNotNull() & (F.col("photo_count") >= min_photos)).select(DAY, "set_id", "number", "first_ms")
    best = best_candidate_for_set(able, candidates, max_s).drop("distance_s")
    said = candidates.select(DAY, F.col("id").alias("c_id"), "stream_id", "clip", "segment_index", F.col("start_ms").alias("said_ms"))
    windows = case_windows(segments, [DAY, "stream_id", "clip"], before, after, trim)
    rows = able.join(best, [DAY, "set_id"]).join(said, [DAY, "c_id"]).join(windows, [DAY, "stream_id", "clip", "segment_index"])
    window_id = F.format_string("%s:%s:%04d:%04d", "stream_id", F.col("clip").cast("string"), "first_index", "last_index")
    tokens = F.split(normalize_text(F.col("window_text")), " ")
    named = F.create_map(*(F.lit(x) for pair in ordinals.items() for x in pair))
    rows = rows.withColumns({
        "window_id": window_id,
        "case_id": F.concat_ws(":", DAY, F.col("number").cast("string"), window_id),
        "expected_ordinal": F.element_at(named, F.get(F.filter(tokens, lambda t: t.isin(*ordinals)), 0)),
        "anchor_delta_s": F.round((F.col("said_ms") - F.col("first_ms")) / 1000.0, 3),
        "_plain": F.array_contains(tokens, F.col("number").cast("string")).cast("int") + F.array_contains("trigger_types", "category").cast("int"),
    })
    crowd = nearby_conflicts(rows.select(DAY, F.struct("set_id", "case_id").alias("id"), "number", F.col("window_start_ms").alias("start_ms")), candidates)
    crowd = crowd.select(DAY, "id.set_id", "id.case_id", "conflicts")
    difficulty = F.col("_plain") + F.when(F.col("expected_ordinal").isNull(), 0).otherwise(2) + F.col("conflicts")
    return rows.join(crowd, [DAY, "set_id", "case_id"]).withColumn("difficulty", difficulty).drop("_plain", "c_id", "said_ms")


def case_windows(segments: DataFrame, clip: list[str], before: int, after: int, trim: bool) -> DataFrame:
    """For each segment the window of up to ``before`` and ``after`` neighbours: first_index, last_index, window_start_ms, window_end_ms,
    window_text, trigger_types of the segment itself (``keyword`` if it has none). With ``trim`` it ends at other segments with triggers."""
    w = Window.partitionBy(*clip).orderBy("segment_index").rowsBetween(-before, after)
    fired = F.coalesce(F.size("trigger_types") > 0, F.lit(False))
    one = F.struct(F.col("segment_index").alias("i"), F.col("start_ms").alias("a"), F.col("end_ms").alias("b"), F.trim(F.coalesce("text", F.lit(""))).alias("t"), fired.alias("f"))
    rows = segments.withColumn("_near", F.collect_list(one).over(w))
    own = F.col("segment_index")
    if trim:
        index = lambda test: F.transform(F.filter("_near", lambda s: s["f"] & test(s["i"])), lambda s: s["i"])
        rows = rows.withColumns({"_lo": F.array_max(index(lambda i: i < own)), "_hi": F.array_min(index(lambda i: i > own))})
        inside = lambda s: (F.col("_lo").isNull() | (s["i"] > F.col("_lo"))) & (F.col("_hi").isNull() | (s["i"] < F.col("_hi")))
        rows = rows.withColumn("_near", F.filter("_near", inside))
    first, last = F.get("_near", 0), F.element_at("_near", -1)
    text = F.array_join(F.filter(F.transform("_near", lambda s: s["t"]), lambda t: t != ""), " ")
    types = F.when(fired, F.col("trigger_types")).otherwise(F.array(F.lit("keyword")))
    named = {"first_index": first["i"], "last_index": last["i"], "window_start_ms": first["a"], "window_end_ms": last["b"], "window_text": text, "trigger_types": types}
    return rows.select(*clip, "segment_index", *(c.alias(k) for k, c in named.items()))


def any_of(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False))
