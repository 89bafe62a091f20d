"""Transcript segments: announcements, chunks and trigger windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweave.functions.textfuncs import NUMBER_TOKENS, normalize_text, parse_spoken_number

CLIP = ("stream_id", "clip_stem")


def transcript_to_clip(segments: DataFrame, clips: DataFrame) -> DataFrame:
    """Inner join on stream and file stem; local times are the clip's start plus the segment's seconds."""
    stem = F.regexp_replace(F.regexp_extract("filename", r"([^/]+)$", 1), r"\.[^.]*$", "")
    keyed = clips.select("stream_id", stem.alias("clip_stem"), F.col("start_ms").alias("clip_start_ms"))
    ms = lambda c: F.col("clip_start_ms") + F.round(F.col(c) * 1000).cast("long")
    return segments.join(keyed, list(CLIP)).withColumn("segment_start_ms", ms("start_s")).withColumn("segment_end_ms", ms("end_s"))


def announcement_candidates(segments: DataFrame, keywords: tuple[str, ...] = ("numer", "nr"), extra: str = "kategoria") -> DataFrame:
    """A row for each keyword followed by a number over 0: value, method, confidence 0.98 for digits and 0.94 for words, 0.03 more (0.99 at most)
    with ``extra`` within seven tokens after it."""
    tokens = segments.withColumn("tokens", F.split(normalize_text(F.col("text")), " "))
    at = F.posexplode("tokens").alias("at", "token")
    rows = tokens.select("*", at).where(F.col("token").isin(*keywords))
    rest = F.slice("tokens", F.col("at") + 2, F.lit(NUMBER_TOKENS))
    found = rows.withColumn("number", parse_spoken_number(rest)).where("number.value > 0")
    near = F.array_contains(F.slice("tokens", F.col("at") + 2 + F.col("number.used"), F.lit(7)), extra)
    conf = F.when(F.col("number.method") == "digits", 0.98).otherwise(0.94)
    return found.withColumns({"performance_number": F.col("number.value"), "match_method": F.col("number.method"), "match_keyword": F.col("token"), "confidence": F.when(near, F.least(F.lit(0.99), conf + 0.03)).otherwise(conf)}).drop("tokens", "token", "number")


def chunk_segments(segments: DataFrame, gap_s: float) -> DataFrame:
    """Chunks of a stream: a new one where the silence since the previous end exceeds gap_s."""
    w = Window.partitionBy("day_id", "stream_id").orderBy("start_ms", "segment_index")
    new = F.coalesce(F.col("start_ms") - F.lag("end_ms").over(w) > gap_s * 1000, F.lit(True)).cast("long")
    rows = segments.withColumn("_n", new).withColumn("chunk_index", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "segment_index", "text"))), lambda s: s["text"]), " ")
    return rows.groupBy("day_id", "stream_id", "chunk_index").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count(F.lit(1)).alias("segment_count"), text.alias("text"))


def trigger_windows(segments: DataFrame, clip: str, index: str, trigger: str, before: int = 2, after: int = 2) -> DataFrame:
    """For each trigger segment of a clip the first and last segment of its window, cut short at the neighbouring triggers."""
    w = Window.partitionBy(clip).orderBy(index)
    low = F.last(F.when(F.col(trigger), F.col(index)), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    high = F.first(F.when(F.col(trigger), F.col(index)), True).over(w.rowsBetween(1, Window.unboundedFollowing))
    ends = segments.withColumns({"_lo": low, "_hi": high, "_a": F.min(index).over(Window.partitionBy(clip)), "_b": F.max(index).over(Window.partitionBy(clip))}).where(F.col(trigger))
    first = F.greatest(F.col(index) - before, F.coalesce(F.col("_lo") + 1, F.col("_a")), F.col("_a"))
    last = F.least(F.col(index) + after, F.coalesce(F.col("_hi") - 1, F.col("_b")), F.col("_b"))
    return ends.select(clip, F.col(index).alias("center_index"), first.alias("first_index"), last.alias("last_index"))


def sliding_windows(segments: DataFrame, clip: str, index: str, size: int, step: int) -> DataFrame:
    bounds = segments.groupBy(clip).agg(F.min(index).alias("a"), F.max(index).alias("b"))
    start = F.explode(F.sequence(F.col("a"), F.greatest(F.col("a"), F.col("b")), F.lit(step).cast("long"))).alias("first_index")
    return bounds.select(clip, "b", start).select(clip, "first_index", F.least(F.col("first_index") + size - 1, F.col("b")).alias("last_index"))


def dedupe_windows(windows: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """One row for each key, the array columns united and sorted."""
    return windows.groupBy(keys).agg(*(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists))


def attribute_detections(windows: DataFrame) -> DataFrame:
    """The segment a numbered announcement belongs to (columns segments, detection, center_index): the first whose text holds the evidence,
    else 'numer N', else the centre, else the first."""
    pick = lambda test: F.get(F.filter("segments", test), 0)
    has = F.coalesce(F.trim("detection.evidence"), F.lit("")) != ""
    by_text = F.when(has, pick(lambda s: F.contains(normalize_text(s["text"]), normalize_text(F.col("detection.evidence")))))
    number = F.concat(F.lit("numer "), F.col("detection.start_number").cast("string"))
    by_number = pick(lambda s: F.concat(F.lit(" "), normalize_text(s["text"]), F.lit(" ")).contains(F.concat(F.lit(" "), number, F.lit(" "))))
    out = windows.where("detection.event_type = 'announcement' and detection.start_number is not null")
    return out.withColumn("segment", F.coalesce(by_text, by_number, pick(lambda s: s["index"] == F.col("center_index")), F.get("segments", 0)))


def window_summary(windows: DataFrame) -> DataFrame:
    """Windows per stream and trigger type (column trigger_types)."""
    return windows.select("stream_id", F.explode("trigger_types").alias("trigger_type")).groupBy("stream_id", "trigger_type").agg(F.count(F.lit(1)).alias("window_count"))
