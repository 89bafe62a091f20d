"""Announcements to timeline, photos to intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = "day_id"


def merge_candidates(candidates: DataFrame, gap_s: float = 12) -> DataFrame:
    """Rows of a day in order of (start, number, stream, id); a new group where the number changes or the start is more than gap_s after the
    previous row's start."""
    w = Window.partitionBy(DAY).orderBy("start_ms", "number", "stream_id", "id")
    new = F.coalesce((F.lag("number").over(w) != F.col("number")) | (F.col("start_ms") - F.lag("start_ms").over(w) > gap_s * 1000), F.lit(True))
    rows = candidates.withColumn("_n", new.cast("long")).withColumn("group_index", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(DAY, "group_index").agg(
        F.first("number").alias("number"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count(F.lit(1)).alias("candidate_count"), F.array_join(F.array_sort(F.collect_set("stream_id")), ",").alias("source_streams"), F.max("confidence").alias("confidence")
    )


def build_timeline(merged: DataFrame, start_buffer: float = 1, end_buffer: float = 0.5, far_s: float = 600) -> DataFrame:
    """Sets from announcements: start after one, end before the next; status complete, invalid_overlap or open_end; how often the number came
    before in the day, near or far."""
    w = Window.partitionBy(DAY).orderBy("start_ms", "group_index")
    same = Window.partitionBy(DAY, "number").orderBy("start_ms", "group_index")
    out = merged.withColumn("set_start_ms", F.col("end_ms") + int(start_buffer * 1000)).withColumn("set_end_ms", F.lead("start_ms").over(w) - int(end_buffer * 1000))
    out = out.withColumn("status", F.when(F.col("set_end_ms").isNull(), "open_end").when(F.col("set_end_ms") <= F.col("set_start_ms"), "invalid_overlap").otherwise("complete"))
    since = (F.col("start_ms") - F.lag("start_ms").over(same)) / 1000.0
    out = out.withColumn("occurrence_index", F.row_number().over(same).cast("long")).withColumn("duplicate_status", F.when(since.isNull(), "normal").when(since > far_s, "duplicate_far").otherwise("duplicate_near"))
    return out.withColumn("set_id", F.concat_ws("-", F.col("number").cast("string"), F.col("occurrence_index").cast("string")))


def assign_to_intervals(photos: DataFrame, timeline: DataFrame, bucket_s: int = 900, include_open_end: bool = True, offset_s: float = 0) -> DataFrame:
    """Interval join by day and time bucket: the first interval by start with start <= t < end; an open one reaches to the day's last photo.
    Adds set_id, seconds from start, to end and to the nearest edge, and assignment_status."""
    bucket = bucket_s * 1000
    t = F.col("start_epoch_ms") + int(offset_s * 1000)
    last = photos.groupBy(DAY).agg(F.max(t).alias("_last"))
    spans = timeline.select(DAY, "set_id", F.col("set_start_ms").alias("s"), F.col("set_end_ms").alias("e"))
    spans = spans.where("e is null or e > s") if include_open_end else spans.where("e > s")
    spans = spans.join(last, DAY).withColumn("_to", F.coalesce(F.col("e") - 1, F.col("_last"))).where("_to >= s")
    spans = spans.withColumn("b", F.explode(F.sequence(F.floor(F.col("s") / bucket), F.floor(F.col("_to") / bucket)))).drop("_last", "_to")
    keyed = photos.withColumn("t", t).withColumn("b", F.floor(F.col("t") / bucket))
    hits = keyed.join(spans, [DAY, "b"]).where("t >= s and (e is null or t < e)")
    first = Window.partitionBy(DAY, "photo_id").orderBy("s", F.asc_nulls_last("e"), "set_id")
    out = hits.withColumn("r", F.row_number().over(first)).where("r = 1")
    from_start, to_end = (F.col("t") - F.col("s")) / 1000.0, (F.col("e") - F.col("t")) / 1000.0
    return out.select(*photos.columns, "set_id", F.col("s").alias("set_start_ms"), from_start.alias("seconds_from_start"), to_end.alias("seconds_to_end"), F.least(from_start, to_end).alias("nearest_edge_seconds"), F.when(F.col("e").isNull(), "provisional_open_end").otherwise("assigned").alias("assignment_status"))


def unassigned_with_neighbors(photos: DataFrame, assigned: DataFrame, timeline: DataFrame) -> DataFrame:
    """Photos without an interval: the last set in order of start that has ended by then or is open, the first that starts later, and why.

    No set that is over or open covers the photo, so the previous one is the last that started by then. As-of joins by a union in time
    order; sets of a day are few, and photos meet only the latest start (ties: the larger set_id) and the next."""
    left = photos.join(assigned.select(DAY, "photo_id"), [DAY, "photo_id"], "left_anti")
    none = F.lit(None).cast("string")
    events = left.select(DAY, F.col("start_epoch_ms").alias("t"), F.lit(1).alias("kind"), F.col("photo_id").cast("string").alias("photo_id"), none.alias("set_id"))
    begins = timeline.where("set_end_ms > set_start_ms or set_end_ms is null").select(DAY, F.col("set_start_ms").alias("t"), F.lit(0).alias("kind"), none.alias("photo_id"), "set_id")
    rows = events.union(begins)
    back = Window.partitionBy(DAY).orderBy("t", "kind", "set_id").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(DAY).orderBy(F.desc("t"), F.desc("kind"), F.desc("set_id")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("previous_set", F.last("set_id", True).over(back)).withColumn("next_set", F.last("set_id", True).over(ahead)).where("kind = 1")
    reason = F.when(F.col("previous_set").isNull() & F.col("next_set").isNull(), "no_timeline").when(F.col("previous_set").isNull(), "before_first").when(F.col("next_set").isNull(), "after_last").otherwise("between")
    return out.select(DAY, F.col("photo_id").cast(photos.schema["photo_id"].dataType).alias("photo_id"), "previous_set", "next_set", reason.alias("reason"))


def asof_announcement(sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """For each set the last candidate of its number that starts by the set's start, else the first candidate. Sets and candidates of a
    number stand in one order of time, so no row is made for a pair of them."""
    c = F.struct(F.col("t").alias("c_start"), F.col("id").alias("c_id"))
    said = candidates.select(DAY, "number", F.col("start_ms").alias("t"), F.lit(0).alias("kind"), "id", F.lit(None).cast(sets.schema["set_id"].dataType).alias("set_id"))
    begun = sets.select(DAY, "number", F.col("set_start_ms").alias("t"), F.lit(1).alias("kind"), F.lit(None).cast(candidates.schema["id"].dataType).alias("id"), "set_id")
    rows = said.unionByName(begun).where(F.col(DAY).isNotNull() & F.col("number").isNotNull()).withColumn("c", F.when(F.col("kind") == 0, c))
    w = Window.partitionBy(DAY, "number")
    # a candidate without a start is by no set's start, but may be the first
    upto = F.last(F.when(F.col("t").isNotNull(), F.col("c")), True).over(w.orderBy("t", "kind", "id").rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumns({"upto": upto, "first": F.min("c").over(w)}).where("kind = 1 and first is not null")
    found = found.groupBy(DAY, "set_id").agg(F.coalesce(F.max("upto"), F.min("first")).alias("c"))
    return found.select(DAY, "set_id", F.col("c.c_id").alias("candidate_id"), F.col("c.c_start").alias("candidate_start_ms"))


def review_margin(assigned: DataFrame, margin_s: float = 30) -> DataFrame:
    """review_reason and review_distance for photos within the margin after the last photo of the previous set or before the first of the
    next; open-end rows stay as they are."""
    bounds = assigned.groupBy(DAY, "set_id").agg(F.min("start_epoch_ms").alias("f"), F.max("start_epoch_ms").alias("l"))
    w = Window.partitionBy(DAY).orderBy("f", "set_id")
    near = bounds.withColumn("prev_last", F.lag("l").over(w)).withColumn("next_first", F.lead("f").over(w)).select(DAY, "set_id", "prev_last", "next_first")
    out = assigned.join(near, [DAY, "set_id"])
    a, b = (F.col("start_epoch_ms") - F.col("prev_last")) / 1000.0, (F.col("next_first") - F.col("start_epoch_ms")) / 1000.0
    by_prev, by_next = F.when(a.between(0, margin_s), a), F.when(b.between(0, margin_s), b)
    closed = F.col("assignment_status") == "assigned"
    dist = F.when(closed, F.least(by_prev, by_next))
    reason = F.when(dist.isNull(), F.lit(None).cast("string")).when(by_next.isNull() | (by_prev <= by_next), "near_previous").otherwise("near_next")
    return out.withColumns({"review_distance": dist, "review_reason": reason}).withColumn("assignment_status", F.when(F.col("review_distance").isNotNull(), "review").otherwise(F.col("assignment_status"))).drop("prev_last", "next_first")


def assignment_summary(timeline: DataFrame, assigned: DataFrame) -> DataFrame:
    """A row for each set, empty ones too."""
    out = timeline.select(DAY, "set_id").join(assigned.select(DAY, "set_id", "photo_id", "start_epoch_ms", "assignment_status"), [DAY, "set_id"], "left")
    return out.groupBy(DAY, "set_id").agg(F.count("photo_id").alias("assigned_count"), F.count_if(F.col("assignment_status") != "assigned").alias("not_plain_count"), F.min("start_epoch_ms").alias("first_ms"), F.max("start_epoch_ms").alias("last_ms"))


def stream_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("stream_id").agg(F.count(F.lit(1)).alias("row_count"), F.min("start_epoch_ms").alias("first_ms"), F.max("start_epoch_ms").alias("last_ms"))


def timeline_summary(timeline: DataFrame) -> DataFrame:
    kinds = {"complete": "status", "open_end": "status", "invalid_overlap": "status", "normal": "duplicate_status", "duplicate_near": "duplicate_status", "duplicate_far": "duplicate_status"}
    return timeline.groupBy(DAY).agg(*(F.count_if(F.col(c) == k).alias(f"n_{k}") for k, c in kinds.items()))
