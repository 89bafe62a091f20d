"""Queries of the timeline, sync and transcript operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions import textfuncs, timefuncs
from eventweave.operators import review, sync, timeline, transcripts
from eventweave.plans import views as V
from eventweave.plans.order_queries import r6
from eventweave.plans.registry import query


@query(f"WITH {V.MERGED} SELECT day_id, group_index, number, start_ms, end_ms, candidate_count, source_streams, round(confidence, 6) AS confidence FROM merged")
def merge_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return r6(timeline.merge_candidates(V.candidates(spark, sf), V.MERGE), "confidence")


@query(f"WITH {V.TIMELINE} SELECT day_id, set_id, number, set_start_ms, set_end_ms, status, occurrence_index, duplicate_status FROM tl")
def build_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return V.the_timeline(spark, sf).select("day_id", "set_id", "number", "set_start_ms", "set_end_ms", "status", "occurrence_index", "duplicate_status")


@query(f"WITH {V.ASSIGNED} SELECT day_id, photo_id, set_id, round(seconds_from_start, 6) AS seconds_from_start, round(seconds_to_end, 6) AS seconds_to_end, assignment_status FROM assigned")
def assign_to_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return r6(V.assigned(spark, sf).select("day_id", "photo_id", "set_id", "seconds_from_start", "seconds_to_end", "assignment_status"), "seconds_from_start", "seconds_to_end")


@query(
    f"""WITH {V.ASSIGNED}, ok AS (SELECT * FROM tl WHERE set_end_ms IS NULL OR set_end_ms > set_start_ms), lost AS (SELECT s.* FROM shots s ANTI JOIN assigned a ON a.day_id = s.day_id AND a.photo_id = s.photo_id),
e AS (SELECT l.day_id, l.photo_id, arg_max(t.set_id, (t.set_start_ms, t.set_id)) AS previous_set FROM lost l JOIN ok t ON t.day_id = l.day_id AND t.set_start_ms <= l.start_epoch_ms AND (t.set_end_ms IS NULL OR t.set_end_ms <= l.start_epoch_ms) GROUP BY ALL),
n AS (SELECT l.day_id, l.photo_id, arg_min(t.set_id, (t.set_start_ms, t.set_id)) AS next_set FROM lost l JOIN ok t ON t.day_id = l.day_id AND t.set_start_ms > l.start_epoch_ms GROUP BY ALL)
SELECT l.day_id, l.photo_id, previous_set, next_set, CASE WHEN previous_set IS NULL AND next_set IS NULL THEN 'no_timeline' WHEN previous_set IS NULL THEN 'before_first' WHEN next_set IS NULL THEN 'after_last' ELSE 'between' END AS reason
FROM lost l LEFT JOIN e USING (day_id, photo_id) LEFT JOIN n USING (day_id, photo_id)"""
)
def unassigned_with_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.unassigned_with_neighbors(V.shots(spark, sf), V.assigned(spark, sf), V.the_timeline(spark, sf))


@query(
    f"""WITH {V.ASSIGNED}, b AS (SELECT day_id, set_id, min(start_epoch_ms) AS f, max(start_epoch_ms) AS l FROM assigned GROUP BY ALL),
near AS (SELECT day_id, set_id, lag(l) OVER w AS pl, lead(f) OVER w AS nf FROM b WINDOW w AS (PARTITION BY day_id ORDER BY f, set_id)),
d AS (SELECT a.*, CASE WHEN (start_epoch_ms - pl) / 1000.0 BETWEEN 0 AND 300 AND assignment_status = 'assigned' THEN (start_epoch_ms - pl) / 1000.0::DOUBLE END AS x, CASE WHEN (nf - start_epoch_ms) / 1000.0 BETWEEN 0 AND 300 AND assignment_status = 'assigned' THEN (nf - start_epoch_ms) / 1000.0::DOUBLE END AS y FROM assigned a JOIN near USING (day_id, set_id))
SELECT day_id, photo_id, set_id, round(least(x, y), 6) AS review_distance, CASE WHEN x IS NULL AND y IS NULL THEN NULL WHEN y IS NULL OR x <= y THEN 'near_previous' ELSE 'near_next' END AS review_reason,
  CASE WHEN x IS NOT NULL OR y IS NOT NULL THEN 'review' ELSE assignment_status END AS assignment_status FROM d"""
)
def review_margin(spark: SparkSession, sf: str) -> DataFrame:
    out = timeline.review_margin(V.assigned(spark, sf), 300)
    return r6(out.select("day_id", "photo_id", "set_id", "review_distance", "review_reason", "assignment_status"), "review_distance")


@query(f"WITH {V.ASSIGNED} SELECT t.day_id, t.set_id, count(a.photo_id) AS assigned_count, coalesce(count_if(a.assignment_status <> 'assigned'), 0) AS not_plain_count, min(start_epoch_ms) AS first_ms, max(start_epoch_ms) AS last_ms FROM tl t LEFT JOIN assigned a ON a.day_id = t.day_id AND a.set_id = t.set_id GROUP BY ALL")
def assignment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.assignment_summary(V.the_timeline(spark, sf), V.assigned(spark, sf))


@query(f"WITH {V.PHOTOS} SELECT stream_id, count(*) AS row_count, min(start_epoch_ms) AS first_ms, max(start_epoch_ms) AS last_ms FROM photos GROUP BY 1")
def stream_summary(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.stream_summary(V.photos(spark, sf))


@query(f"WITH {V.TIMELINE} SELECT day_id, " + ", ".join(f"count_if({c} = '{k}') AS n_{k}" for k, c in (("complete", "status"), ("open_end", "status"), ("invalid_overlap", "status"), ("normal", "duplicate_status"), ("duplicate_near", "duplicate_status"), ("duplicate_far", "duplicate_status"))) + " FROM tl GROUP BY 1")
def timeline_summary(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.timeline_summary(V.the_timeline(spark, sf))


@query(
    f"""WITH {V.TIMELINE}, j AS (SELECT t.day_id, t.set_id, t.set_start_ms, c.id, c.start_ms AS cs FROM tl t JOIN cands c ON c.day_id = t.day_id AND c.number = t.number)
SELECT day_id, set_id, coalesce(arg_max(id, (cs, id)) FILTER (WHERE cs <= set_start_ms), arg_min(id, (cs, id))) AS candidate_id FROM j GROUP BY day_id, set_id"""
)
def asof_announcement(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.asof_announcement(V.the_timeline(spark, sf), V.candidates(spark, sf)).select("day_id", "set_id", "candidate_id")


REFERENCE = f"{V.PHOTOS}, {V.CLIPS}, tot AS (SELECT day_id, stream_id, sum((end_ms - start_ms) / 1000.0::DOUBLE) AS s FROM clips GROUP BY ALL), ref AS (SELECT day_id, arg_max(stream_id, (s, stream_id)) AS reference_stream_id FROM tot GROUP BY 1)"


@query(f"WITH {REFERENCE} SELECT * FROM ref")
def pick_reference_stream(spark: SparkSession, sf: str) -> DataFrame:
    return sync.pick_reference_stream(V.clips(spark, sf))


@query(
    f"""WITH {REFERENCE}, p AS (SELECT a.day_id, b.stream_id, a.clip_id AS ref_clip, b.clip_id, greatest(a.start_ms, b.start_ms) AS lo, least(a.end_ms, b.end_ms) AS hi FROM ref r JOIN clips a ON a.day_id = r.day_id AND a.stream_id = r.reference_stream_id JOIN clips b ON b.day_id = r.day_id AND b.stream_id <> r.reference_stream_id WHERE least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms) >= 1000),
q AS (SELECT *, (hi - lo) / 1000.0::DOUBLE AS overlap_s, lo + (hi - lo) // 2 AS midpoint_ms FROM p), n AS (SELECT *, row_number() OVER (PARTITION BY day_id, stream_id ORDER BY midpoint_ms, ref_clip, clip_id) - 1 AS i, count(*) OVER (PARTITION BY day_id, stream_id) AS c FROM q),
s AS (SELECT *, CASE WHEN c <= 6 THEN i ELSE i * 6 // c END AS share FROM n), b AS (SELECT *, row_number() OVER (PARTITION BY day_id, stream_id, share ORDER BY overlap_s DESC, ref_clip, clip_id) AS r FROM s)
SELECT day_id, stream_id, ref_clip, clip_id, round(overlap_s, 6) AS overlap_s, midpoint_ms FROM b WHERE r = 1"""
)
def overlap_pairs(spark: SparkSession, sf: str) -> DataFrame:
    c = V.clips(spark, sf)
    return r6(sync.overlap_pairs(c, sync.pick_reference_stream(c)), "overlap_s")


@query(
    f"""WITH {V.TIMELINE}, {V.CLIPS} SELECT t.day_id, t.set_id, c.clip_id, greatest(t.set_start_ms - 2000, c.start_ms) AS export_start_ms, least(t.set_end_ms + 2000, c.end_ms) AS export_end_ms,
  round((greatest(t.set_start_ms - 2000, c.start_ms) - c.start_ms) / 1000.0::DOUBLE, 6) AS seek_s, round((least(t.set_end_ms + 2000, c.end_ms) - greatest(t.set_start_ms - 2000, c.start_ms)) / 1000.0::DOUBLE, 6) AS duration_s
FROM tl t JOIN clips c ON c.day_id = t.day_id AND t.set_start_ms <= c.end_ms AND c.start_ms <= t.set_end_ms WHERE t.set_end_ms >= t.set_start_ms"""
)
def export_markers(spark: SparkSession, sf: str) -> DataFrame:
    # whole milliseconds in seconds have three places already; rounding them took much of the time, row by row
    return sync.export_markers(V.the_timeline(spark, sf), V.clips(spark, sf))


ESTIMATES = f"{V.PHOTOS}, est AS (SELECT day_id, stream_id, value - 50 AS correction_s, (photo_id % 100) / 100.0::DOUBLE AS score, CASE WHEN photo_id % 11 = 0 THEN 'failed' ELSE 'ok' END AS status FROM photos)"


@query(
    f"""WITH {ESTIMATES}, g AS (SELECT * FROM est WHERE status = 'ok' AND score >= 0.3), m AS (SELECT day_id, stream_id, median(correction_s) AS m0 FROM g GROUP BY ALL),
k0 AS (SELECT g.*, abs(correction_s - m0) <= 30 AS near FROM g JOIN m USING (day_id, stream_id)), k AS (SELECT * FROM k0 QUALIFY near OR NOT bool_or(near) OVER (PARTITION BY day_id, stream_id)),
mid AS (SELECT day_id, stream_id, median(correction_s) AS c, count(*) AS n FROM k GROUP BY ALL), mad AS (SELECT day_id, stream_id, median(abs(correction_s - c)) AS d FROM k JOIN mid USING (day_id, stream_id) GROUP BY ALL)
SELECT e.day_id, e.stream_id, e.n AS pair_count, coalesce(mid.n, 0) AS successful_pairs, round(coalesce(c, 0), 6) AS correction_seconds, round(d, 6) AS median_abs_deviation
FROM (SELECT day_id, stream_id, count(*) AS n FROM est GROUP BY ALL) e LEFT JOIN mid USING (day_id, stream_id) LEFT JOIN mad USING (day_id, stream_id)"""
)
def robust_offset(spark: SparkSession, sf: str) -> DataFrame:
    e = V.photos(spark, sf).select("day_id", "stream_id", (F.col("value") - 50).alias("correction_s"), ((F.col("photo_id") % 100) / 100.0).alias("score"), F.when(F.col("photo_id") % 11 == 0, "failed").otherwise("ok").alias("status"))
    return r6(sync.robust_offset(e, 0.3, 30).select("day_id", "stream_id", "pair_count", "successful_pairs", "correction_seconds", "median_abs_deviation"), "correction_seconds", "median_abs_deviation")


@query("SELECT event_id, (epoch_us(ts) // 1000) + CASE user_id % 4 WHEN 1 THEN 1500 WHEN 2 THEN -2250 ELSE 0 END AS synced_ms FROM events")
def clock_offset(spark: SparkSession, sf: str) -> DataFrame:
    fixes = spark.createDataFrame([("p-1", 1.5), ("p-2", -2.25)], "stream_id string, correction_seconds double")
    e = V.read(spark, sf, "events").select("event_id", F.concat(F.lit("p-"), (F.col("user_id") % 4).cast("string")).alias("stream_id"), F.col("ts").alias("start_local"), F.col("ts").alias("end_local"))
    return timefuncs.apply_clock_offset(e, fixes).select("event_id", timefuncs.epoch_ms("start_synced").alias("synced_ms"))


@query(
    """WITH m AS (SELECT day, stream, t, v, id, (coalesce(s - lag(e) OVER w > 200000, true))::INT AS fresh, s, e FROM (SELECT strftime(ts, '%Y%m%d') AS day, user_id % 4 AS stream, (epoch_us(ts) // 1000) AS s, (epoch_us(ts) // 1000) + floor(value * 1000)::BIGINT AS e, event_id AS id, ts AS t, event_type AS v FROM events) WINDOW w AS (PARTITION BY day, stream ORDER BY s, id)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY day, stream ORDER BY s, id ROWS UNBOUNDED PRECEDING)::BIGINT AS chunk_index FROM m)
SELECT day AS day_id, 'p-' || stream::VARCHAR AS stream_id, chunk_index, min(s) AS start_ms, max(e) AS end_ms, count(*) AS segment_count, string_agg(v, ' ' ORDER BY s, id) AS text FROM g GROUP BY ALL"""
)
def chunk_segments(spark: SparkSession, sf: str) -> DataFrame:
    s = V.photos(spark, sf).select("day_id", "stream_id", F.col("start_epoch_ms").alias("start_ms"), (F.col("start_epoch_ms") + F.floor(F.col("value") * 1000)).alias("end_ms"), F.col("photo_id").alias("segment_index"), F.col("event_type").alias("text"))
    return transcripts.chunk_segments(s, 200)


@query(
    """WITH s AS (SELECT conv_id, turn, role = 'user' AND turn % 3 = 0 AS trig FROM conversations), x AS (SELECT *, max(CASE WHEN trig THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo,
  min(CASE WHEN trig THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi, min(turn) OVER (PARTITION BY conv_id) AS a, max(turn) OVER (PARTITION BY conv_id) AS b FROM s)
SELECT conv_id, turn AS center_index, greatest(turn - 2, coalesce(lo + 1, a), a) AS first_index, least(turn + 2, coalesce(hi - 1, b), b) AS last_index FROM x WHERE trig"""
)
def trigger_windows(spark: SparkSession, sf: str) -> DataFrame:
    t = V.turns(spark, sf).withColumn("trig", (F.col("role") == "user") & (F.col("turn") % 3 == 0))
    return transcripts.trigger_windows(t, "conv_id", "turn", "trig")


NORMALIZED = "nullif(list_aggregate(regexp_extract_all(replace(strip_accents(lower(text)), '№', ' nr '), '[a-z0-9]+'), 'string_agg', ' '), '')"


@query(f"SELECT conv_id, turn, {NORMALIZED} AS normalized FROM conversations")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return V.turns(spark, sf).select("conv_id", "turn", F.nullif(textfuncs.normalize_text(F.col("text")), F.lit("")).alias("normalized"))


@query()
def normalize_turns(spark: SparkSession, sf: str) -> DataFrame:
    """All turns, with accents, number signs and null texts; tests hold it against plain Python."""
    return V.turns(spark, sf).select("conv_id", "turn", F.nullif(textfuncs.normalize_text(F.col("text")), F.lit("")).alias("normalized"))


@query(
    """WITH t AS (SELECT doc_id, str_split(list_aggregate(regexp_extract_all(replace(strip_accents(lower(text)), '№', ' nr '), '[a-z0-9]+'), 'string_agg', ' '), ' ') AS w FROM documents),
k AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM t), m AS (SELECT doc_id, w[i] AS word, w[i + 1] AS number, w[i + 2:i + 8] AS later FROM k WHERE w[i] IN ('version', 'copyright') AND regexp_full_match(coalesce(w[i + 1], ''), '[0-9]{1,9}'))
SELECT doc_id, number::INT AS performance_number, 'digits' AS match_method, word AS match_keyword, CASE WHEN list_contains(later, 'reserved') THEN 0.99 ELSE 0.98 END AS confidence FROM m WHERE number::INT > 0"""
)
def spoken_announcements(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers after the words 'version' and 'copyright' of all documents, surer with 'reserved' near by; fixtures test number words."""
    found = transcripts.announcement_candidates(V.read(spark, sf, "documents").select("doc_id", "text"), keywords=("version", "copyright"), extra="reserved")
    return found.select("doc_id", "performance_number", "match_method", "match_keyword", "confidence")


@query(
    f"""WITH {V.TIMELINE}, h AS (SELECT t.day_id, t.set_id, c.id, c.stream_id, (c.start_ms - t.set_start_ms) / 1000.0::DOUBLE AS d FROM tl t JOIN cands c ON c.day_id = t.day_id AND c.number = t.number WHERE abs(c.start_ms - t.set_start_ms) <= 7200000),
r AS (SELECT *, row_number() OVER (PARTITION BY day_id, set_id ORDER BY (d > 0)::INT, abs(d), stream_id, id) AS r FROM h) SELECT day_id, set_id, id AS c_id, round(abs(d), 6) AS distance_s FROM r WHERE r = 1"""
)
def best_candidate_for_set(spark: SparkSession, sf: str) -> DataFrame:
    sets = V.the_timeline(spark, sf).select("day_id", "set_id", "number", F.col("set_start_ms").alias("first_ms"))
    return r6(review.best_candidate_for_set(sets, V.candidates(spark, sf), 7200), "distance_s")


@query(f"WITH {V.CANDIDATES} SELECT a.day_id, a.id, least(count(b.id), 3) AS conflicts FROM cands a LEFT JOIN cands b ON b.day_id = a.day_id AND b.number <> a.number AND abs(b.start_ms - a.start_ms) <= 900000 GROUP BY ALL")
def nearby_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    c = V.candidates(spark, sf)
    return review.nearby_conflicts(c.select("day_id", "id", "number", "start_ms"), c, 900).select("day_id", "id", "conflicts")


@query(
    f"""WITH {V.ASSIGNED}, g AS (SELECT *, (start_epoch_ms - lag(start_epoch_ms) OVER w) / 1000.0::DOUBLE AS gap FROM assigned WINDOW w AS (PARTITION BY day_id, set_id ORDER BY start_epoch_ms, photo_id))
SELECT day_id, set_id, count(*) AS photo_count, count_if(assignment_status <> 'assigned') AS review_count, min(start_epoch_ms) AS first_ms, max(start_epoch_ms) AS last_ms, round((max(start_epoch_ms) - min(start_epoch_ms)) / 1000.0::DOUBLE, 6) AS duration_s, round(max(CASE WHEN gap > 600 THEN gap END), 6) AS max_gap_s FROM g GROUP BY ALL"""
)
def set_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = review.set_stats(V.assigned(spark, sf).withColumn("review", F.col("assignment_status") != "assigned"))
    return r6(out.select("day_id", "set_id", "photo_count", "review_count", "first_ms", "last_ms", "duration_s", "max_gap_s"), "duration_s", "max_gap_s")


#: A stream's clock is late by so many minutes (stream 0 is right); a clip of four hours begins every three, eight a day.
LATE = {"v-0": 0, "v-1": 3, "v-2": -5, "v-3": 8}


@query(
    f"""WITH {V.PHOTOS}, days AS (SELECT DISTINCT day_id FROM photos), s(stream_id, late) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in LATE.items())})
SELECT day_id, stream_id, (-60.0 * late)::DOUBLE AS correction_seconds, CASE WHEN stream_id = 'v-0' THEN 'reference stream' ELSE '' END AS notes FROM days, s"""
)
def sync_map(spark: SparkSession, sf: str) -> DataFrame:
    """Clips of four cameras that hear the same day, three with a wrong clock: the corrections must be found from the loudness alone.
    Loudness: the sum of the events' values in each minute. SQL knows the clocks."""
    minute = F.floor((F.col("start_epoch_ms") % 86_400_000) / 60_000)
    heard = V.photos(spark, sf).groupBy("day_id", minute.alias("m")).agg(F.sum("value").alias("v"), F.min(F.col("start_epoch_ms") - F.col("start_epoch_ms") % 86_400_000).alias("day_ms"))
    days = heard.groupBy("day_id").agg(F.min("day_ms").alias("day_ms"), F.map_from_entries(F.collect_list(F.struct("m", "v"))).alias("loud"))
    streams = F.explode(F.array(*(F.struct(F.lit(k).alias("stream_id"), F.lit(v).alias("late")) for k, v in LATE.items())))
    clip = days.select("*", streams.alias("s")).select("*", F.explode(F.sequence(F.lit(0), F.lit(1200), F.lit(180))).alias("first"))
    clip = clip.select("day_id", "s.stream_id", "s.late", F.col("first").alias("clip_id"), "day_ms", "loud", F.least(F.lit(1440), F.col("first") + 240).alias("last"))
    start = F.col("day_ms") + (F.col("clip_id") + F.col("late")) * 60_000
    length = (F.col("last") - F.col("clip_id")) * 60_000 + F.when(F.col("stream_id") == "v-0", 1000).otherwise(0)
    clips = clip.select("day_id", "stream_id", "clip_id", start.alias("start_ms"), (start + length).alias("end_ms"))
    loudness = F.transform(F.sequence(F.col("clip_id"), F.col("last") - 1), lambda i: F.coalesce(F.element_at("loud", i.cast("long")), F.lit(0.0)).cast("float"))
    envelopes = clip.select("day_id", "stream_id", "clip_id", loudness.alias("envelope"))
    out = sync.sync_map(clips, envelopes, 1 / 60, margin_s=900, min_overlap_s=3600, max_window_s=14_400, min_score=0.5, max_deviation_s=30)
    return out.select("day_id", "stream_id", F.round("correction_seconds", 3).alias("correction_seconds"), "notes")
