"""The driver's tables in the roles of the library (thresholds scaled to about 333 events a day), and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions.timefuncs import epoch_ms
from eventweave.llm.shared import stored
from eventweave.operators import boundaries, order, ranges, timeline

SOFT, HARD, GAP, MERGE = 300, 900, 600, 900


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("day_id"), F.concat(F.lit("p-"), (F.col("user_id") % 4).cast("string")).alias("stream_id"), F.col("event_id").alias("photo_id"), epoch_ms("ts").alias("start_epoch_ms"), "user_id", "event_type", "value"
    )


PHOTOS = "photos AS (SELECT strftime(ts, '%Y%m%d') AS day_id, 'p-' || (user_id % 4)::VARCHAR AS stream_id, event_id AS photo_id, (epoch_us(ts) // 1000) AS start_epoch_ms, user_id, event_type, value FROM events)"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.adjacent_pairs(photos(spark, sf_dir), ["photo_id", "start_epoch_ms", "value"])


PAIRS = PHOTOS + """, lagged AS (SELECT day_id, photo_id AS left_photo_id, start_epoch_ms AS left_start_epoch_ms, value AS left_value, lead(photo_id) OVER w AS right_photo_id,
  lead(start_epoch_ms) OVER w AS right_start_epoch_ms, lead(value) OVER w AS right_value FROM photos WINDOW w AS (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id)),
pairs AS (SELECT *, (right_start_epoch_ms - left_start_epoch_ms) / 1000.0::DOUBLE AS time_gap_seconds FROM lagged WHERE right_photo_id IS NOT NULL)"""


def with_vectors(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Photos (or rows of them) with their vector (that of a photo: its id modulo the number of vectors)."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = vectors.count()
    rows = photos(spark, sf_dir) if rows is None else rows
    return rows.withColumn("vec_id", F.col("photo_id") % n).join(vectors, "vec_id")


def distances(rows: DataFrame) -> DataFrame:
    """Neighbouring pairs of photos with vectors, and the distance of these."""
    out = boundaries.pair_distances(order.adjacent_pairs(rows, ["photo_id", "start_epoch_ms", "value", "embedding"]))
    return out.drop("left_embedding", "right_embedding")


def near_distances(spark: SparkSession, sf_dir: str, before: int, after: int) -> DataFrame:
    """Distances of the pairs of each range and a halo of photos around it. The halo is made of narrow rows; vectors come to the photos
    when these have their ranges, and are sorted once for the neighbours."""
    shots_ = photos(spark, sf_dir).select("day_id", "photo_id", "start_epoch_ms", "value")
    near = ranges.with_halo(ranges.with_ranges(shots_, order.ORDER), order.ORDER, before, after)
    return distances(with_vectors(spark, sf_dir, near))


DISTANCES = PAIRS + """, n AS (SELECT count(*) AS n FROM embeddings), dist AS (SELECT p.*, 1 - greatest(-1, least(1, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))) AS distance
  FROM pairs p, n JOIN embeddings a ON a.vec_id = p.left_photo_id % n.n JOIN embeddings b ON b.vec_id = p.right_photo_id % n.n)"""

PAIR_ORDER = ["left_start_epoch_ms", "left_photo_id"]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all pairs. One halo serves the three steps: a score looks at the pairs from three before to one after it."""
    rolled = boundaries.rolling_distance_stats(near_distances(spark, sf_dir, 3, 2), PAIR_ORDER)
    return ranges.own_rows(boundaries.boundary_score(boundaries.smooth_z(rolled, PAIR_ORDER), soft_gap=SOFT, hard_gap=HARD))


ROLLED = DISTANCES + """, stats AS (SELECT *, avg(distance) OVER w AS rolling_mean, stddev_pop(distance) OVER w AS rolling_std FROM dist
  WINDOW w AS (PARTITION BY day_id ORDER BY left_start_epoch_ms, left_photo_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
rolled AS (SELECT *, CASE WHEN rolling_std < 1e-9 THEN 0 ELSE (distance - rolling_mean) / rolling_std END AS zscore FROM stats)"""
SCORES = ROLLED + f""", near AS (SELECT *, lag(zscore) OVER w AS zb, lead(zscore) OVER w AS za FROM rolled WINDOW w AS (PARTITION BY day_id ORDER BY left_start_epoch_ms, left_photo_id)),
smooth AS (SELECT *, (zscore * 0.5 + coalesce(zb * 0.25, 0) + coalesce(za * 0.25, 0)) / (0.5 + (CASE WHEN zb IS NULL THEN 0 ELSE 0.25 END) + (CASE WHEN za IS NULL THEN 0 ELSE 0.25 END)) AS smoothed_zscore FROM near),
based AS (SELECT *, greatest(0, least(1, smoothed_zscore / 3.0)) * 0.75 + greatest(0, least(1, distance / 0.35)) * 0.25 AS base,
  CASE WHEN time_gap_seconds >= {HARD} THEN 1.0 WHEN time_gap_seconds >= {SOFT} AND (smoothed_zscore >= 1.125 OR distance >= 0.2) THEN 0.25 ELSE 0.0 END AS time_gap_boost FROM smooth),
scored AS (SELECT *, CASE WHEN time_gap_seconds >= {HARD} THEN 1.0 ELSE greatest(0, least(1, base + time_gap_boost)) END AS boundary_score FROM based),
labelled AS (SELECT *, CASE WHEN time_gap_seconds >= {HARD} THEN 'hard' WHEN boundary_score >= 0.75 THEN 'soft' ELSE 'none' END AS boundary_label FROM scored)"""


def kept_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all pairs as a work table, for queries that join them several times."""
    return stored(scores(spark, sf_dir).select("day_id", "left_photo_id", "right_photo_id", "boundary_score", "boundary_label"), "scores")


def segments(spark: SparkSession, sf_dir: str, scored: DataFrame | None = None) -> DataFrame:
    """Segments of each day from cuts (label not none) on the pair before a photo. scored: the scores, if they are there already."""
    scored = scores(spark, sf_dir) if scored is None else scored
    cut = scored.select("day_id", F.col("right_photo_id").alias("photo_id"), F.col("boundary_score").alias("_s"), (F.col("boundary_label") != "none").alias("_c"))
    rows = ranges.with_ranges(photos(spark, sf_dir).select("day_id", "photo_id", "start_epoch_ms"), order.ORDER).join(cut, ["day_id", "photo_id"], "left")
    return boundaries.segments_from_cuts(rows, F.coalesce("_c", F.lit(False)), F.col("_s"), ["start_epoch_ms", "photo_id"])


SEGMENTS = SCORES + """, flagged AS (SELECT p.*, coalesce(l.boundary_label <> 'none', false) AS cut, l.boundary_score AS s FROM photos p LEFT JOIN labelled l ON l.right_photo_id = p.photo_id AND l.day_id = p.day_id),
numbered AS (SELECT *, sum(cut::INT) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id ROWS UNBOUNDED PRECEDING)::BIGINT AS segment_index FROM flagged),
seg0 AS (SELECT day_id, segment_index, arg_min(photo_id, (start_epoch_ms, photo_id)) AS start_photo_id, arg_max(photo_id, (start_epoch_ms, photo_id)) AS end_photo_id, min(start_epoch_ms) AS start_ms, max(start_epoch_ms) AS end_ms,
  count(*) AS photo_count, max(CASE WHEN cut THEN s END) AS left_score FROM numbered GROUP BY ALL),
segs AS (SELECT *, lead(left_score) OVER (PARTITION BY day_id ORDER BY segment_index) AS right_score FROM seg0)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcement candidates: sign-ups, number = user modulo 40, end = start + value seconds."""
    p = photos(spark, sf_dir).where("event_type = 'signup'")
    return p.select("day_id", F.col("photo_id").alias("id"), (F.col("user_id") % 40).alias("number"), "stream_id", F.col("start_epoch_ms").alias("start_ms"), (F.col("start_epoch_ms") + F.floor(F.col("value") * 1000)).alias("end_ms"), (0.5 + (F.col("photo_id") % 50) / 100.0).alias("confidence"))


CANDIDATES = PHOTOS + ", cands AS (SELECT day_id, photo_id AS id, user_id % 40 AS number, stream_id, start_epoch_ms AS start_ms, start_epoch_ms + floor(value * 1000)::BIGINT AS end_ms, 0.5 + (photo_id % 50) / 100.0::DOUBLE AS confidence FROM photos WHERE event_type = 'signup')"


def the_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.build_timeline(timeline.merge_candidates(candidates(spark, sf_dir), MERGE), far_s=36_000)


MERGED = CANDIDATES + f""", marked AS (SELECT *, (coalesce(lag(number) OVER w <> number OR start_ms - lag(start_ms) OVER w > {MERGE * 1000}, true))::INT AS fresh FROM cands WINDOW w AS (PARTITION BY day_id ORDER BY start_ms, number, stream_id, id)),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY day_id ORDER BY start_ms, number, stream_id, id ROWS UNBOUNDED PRECEDING)::BIGINT AS group_index FROM marked),
merged AS (SELECT day_id, group_index, min(number) AS number, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS candidate_count, string_agg(DISTINCT stream_id, ',' ORDER BY stream_id) AS source_streams, max(confidence) AS confidence FROM grouped GROUP BY ALL)"""
TIMELINE = MERGED + """, tl0 AS (SELECT *, end_ms + 1000 AS set_start_ms, lead(start_ms) OVER (PARTITION BY day_id ORDER BY start_ms, group_index) - 500 AS set_end_ms,
  (start_ms - lag(start_ms) OVER (PARTITION BY day_id, number ORDER BY start_ms, group_index)) / 1000.0 AS since, row_number() OVER (PARTITION BY day_id, number ORDER BY start_ms, group_index) AS occurrence_index FROM merged),
tl AS (SELECT *, CASE WHEN set_end_ms IS NULL THEN 'open_end' WHEN set_end_ms <= set_start_ms THEN 'invalid_overlap' ELSE 'complete' END AS status,
  CASE WHEN since IS NULL THEN 'normal' WHEN since > 36000 THEN 'duplicate_far' ELSE 'duplicate_near' END AS duplicate_status, number::VARCHAR || '-' || occurrence_index::VARCHAR AS set_id FROM tl0)"""


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The photos to assign: views and clicks."""
    return photos(spark, sf_dir).where("event_type in ('view', 'click')").select("day_id", "photo_id", "stream_id", "start_epoch_ms")


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.assign_to_intervals(shots(spark, sf_dir), the_timeline(spark, sf_dir))


ASSIGNED = TIMELINE + """, shots AS (SELECT day_id, photo_id, stream_id, start_epoch_ms FROM photos WHERE event_type IN ('view', 'click')),
hits AS (SELECT s.*, t.set_id, t.set_start_ms, t.set_end_ms, row_number() OVER (PARTITION BY s.day_id, s.photo_id ORDER BY t.set_start_ms, t.set_end_ms NULLS LAST, t.set_id) AS r
  FROM shots s JOIN tl t ON s.day_id = t.day_id AND s.start_epoch_ms >= t.set_start_ms AND (t.set_end_ms IS NULL OR (s.start_epoch_ms < t.set_end_ms AND t.set_end_ms > t.set_start_ms))),
assigned AS (SELECT day_id, photo_id, stream_id, start_epoch_ms, set_id, set_start_ms, (start_epoch_ms - set_start_ms) / 1000.0::DOUBLE AS seconds_from_start, (set_end_ms - start_epoch_ms) / 1000.0::DOUBLE AS seconds_to_end,
  CASE WHEN set_end_ms IS NULL THEN 'provisional_open_end' ELSE 'assigned' END AS assignment_status FROM hits WHERE r = 1)"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips: what one user did in a day, first to last."""
    return photos(spark, sf_dir).groupBy("day_id", "stream_id", F.col("user_id").alias("clip_id")).agg(F.min("start_epoch_ms").alias("start_ms"), F.max("start_epoch_ms").alias("end_ms"))


CLIPS = "clips AS (SELECT day_id, stream_id, user_id AS clip_id, min(start_epoch_ms) AS start_ms, max(start_epoch_ms) AS end_ms FROM photos GROUP BY ALL)"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth and prediction: the two labels of a document; a day is a hundred ids."""
    return read(spark, sf_dir, "labels").select("doc_id", F.floor(F.col("doc_id") / 100).cast("string").alias("day_id"), "quality", "toxic")
