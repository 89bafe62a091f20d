"""Queries of the order, boundary and window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.functions import textfuncs
from eventweave.operators import boundaries, dataset, order, ranges, review, validate
from eventweave.plans import views as V
from eventweave.plans.registry import query


def r6(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


@query(f"WITH {V.PHOTOS} SELECT day_id, photo_id, row_number() OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id) - 1 AS photo_order_index FROM photos")
def photo_order(spark: SparkSession, sf: str) -> DataFrame:
    return order.photo_order(V.photos(spark, sf)).select("day_id", "photo_id", "photo_order_index")


@query(f"WITH {V.PAIRS} SELECT day_id, left_photo_id, right_photo_id, round(time_gap_seconds, 6) AS time_gap_seconds FROM pairs")
def adjacent_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return r6(V.pairs(spark, sf).select("day_id", "left_photo_id", "right_photo_id", "time_gap_seconds"), "time_gap_seconds")


@query(f"WITH {V.DISTANCES} SELECT day_id, left_photo_id, right_photo_id, round(distance, 6) AS distance FROM dist")
def pair_distances(spark: SparkSession, sf: str) -> DataFrame:
    return r6(ranges.own_rows(V.near_distances(spark, sf, 0, 1)).select("day_id", "left_photo_id", "right_photo_id", "distance"), "distance")


@query(f"WITH {V.PAIRS} SELECT day_id, left_photo_id, round(abs(left_value - right_value), 6) AS brightness_delta FROM pairs")
def pair_deltas(spark: SparkSession, sf: str) -> DataFrame:
    p = V.pairs(spark, sf).withColumns({f"{s}_{k}": F.col(f"{s}_value") for s in ("left", "right") for k in ("brightness", "contrast")})
    return r6(boundaries.pair_deltas(p).select("day_id", "left_photo_id", "brightness_delta"), "brightness_delta")


@query(f"WITH {V.ROLLED} SELECT day_id, left_photo_id, round(rolling_mean, 5) AS rolling_mean, round(rolling_std, 5) AS rolling_std, round(zscore, 4) AS zscore FROM rolled")
def rolling_distance_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = ranges.own_rows(boundaries.rolling_distance_stats(V.near_distances(spark, sf, 2, 1), V.PAIR_ORDER))
    return out.select("day_id", "left_photo_id", F.round("rolling_mean", 5).alias("rolling_mean"), F.round("rolling_std", 5).alias("rolling_std"), F.round("zscore", 4).alias("zscore"))


@query(f"WITH {V.SCORES} SELECT day_id, left_photo_id, right_photo_id, round(smoothed_zscore, 4) AS smoothed_zscore, round(boundary_score, 4) AS boundary_score, time_gap_boost::DOUBLE AS time_gap_boost, boundary_label FROM labelled")
def boundary_scores(spark: SparkSession, sf: str) -> DataFrame:
    return V.scores(spark, sf).select("day_id", "left_photo_id", "right_photo_id", F.round("smoothed_zscore", 4).alias("smoothed_zscore"), F.round("boundary_score", 4).alias("boundary_score"), "time_gap_boost", "boundary_label")


@query(
    f"""WITH {V.SEGMENTS} SELECT day_id, segment_index, start_photo_id, end_photo_id, start_ms, end_ms, photo_count,
  round(CASE WHEN left_score IS NULL AND right_score IS NULL THEN 0 ELSE (coalesce(left_score, 0) + coalesce(right_score, 0)) / ((left_score IS NOT NULL)::INT + (right_score IS NOT NULL)::INT) END, 4) AS segment_confidence FROM segs"""
)
def segments_from_cuts(spark: SparkSession, sf: str) -> DataFrame:
    out = boundaries.segment_confidence(V.segments(spark, sf))
    return out.select("day_id", "segment_index", "start_photo_id", "end_photo_id", "start_ms", "end_ms", "photo_count", F.round("segment_confidence", 4).alias("segment_confidence"))


@query()
def min_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: which runs of photos of a day belong together, and how sure. Held against a plain rescan loop in the tests."""
    return boundaries.segment_confidence(boundaries.enforce_min_segments(V.segments(spark, sf)))


@query(f"WITH {V.PAIRS} SELECT day_id, left_photo_id, right_photo_id, round(time_gap_seconds, 6) AS time_gap_seconds FROM pairs WHERE time_gap_seconds > {V.GAP}")
def gap_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return r6(order.gap_candidates(V.pairs(spark, sf), V.GAP).select("day_id", "left_photo_id", "right_photo_id", "time_gap_seconds"), "time_gap_seconds")


@query(
    f"""WITH {V.PHOTOS}, f AS (SELECT day_id, photo_id, start_epoch_ms, list(photo_id) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS frames,
  (lead(start_epoch_ms) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id) - start_epoch_ms) / 1000.0 AS gap FROM photos)
SELECT day_id, photo_id, array_to_string(frames, ',') AS frame_ids, CASE WHEN len(frames) = 4 THEN 'full' ELSE 'incomplete' END AS window_status, round(gap::DOUBLE, 6) AS center_gap_seconds FROM f WHERE gap > {V.GAP}"""
)
def frame_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = order.frame_windows(V.photos(spark, sf), 2, V.GAP, F.col("photo_id"))
    return r6(out.select("day_id", "photo_id", F.array_join(F.col("frames").cast("array<string>"), ",").alias("frame_ids"), "window_status", "center_gap_seconds"), "center_gap_seconds")


@query(
    f"""WITH {V.PHOTOS}, x AS (SELECT day_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY day_id) AS n, (lead(start_epoch_ms) OVER w - start_epoch_ms) / 1000.0::DOUBLE AS gap FROM photos WINDOW w AS (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id)),
h AS (SELECT *, greatest(0, least(i - 4, n - 10)) AS start_row FROM x WHERE round_even(gap, 0) > {V.GAP}),
b AS (SELECT *, row_number() OVER (PARTITION BY day_id, start_row ORDER BY gap DESC, i) AS r FROM h)
SELECT day_id, start_row, least(start_row + 10, n) AS end_row, i AS cut_index, round(gap, 6) AS gap_seconds FROM b WHERE r = 1"""
)
def centered_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = order.centered_windows(V.photos(spark, sf), 5, V.GAP)
    return r6(out.select("day_id", F.col("start_row").cast("long"), F.col("end_row").cast("long"), F.col("cut_index").cast("long"), "gap_seconds"), "gap_seconds")


@query(
    f"""WITH {V.PHOTOS}, d AS (SELECT day_id, count(*) AS n FROM photos GROUP BY 1), s AS (SELECT day_id, n, unnest(range(0, greatest(0, n - 10) + 1, 5)) AS start_row FROM d UNION SELECT day_id, n, greatest(0, n - 10) FROM d)
SELECT day_id, start_row, least(start_row + 10, n) AS end_row FROM s"""
)
def stride_windows(spark: SparkSession, sf: str) -> DataFrame:
    return order.stride_windows(V.photos(spark, sf), 5)


@query(
    f"""WITH {V.PHOTOS}, c AS (SELECT *, coalesce((start_epoch_ms - lag(start_epoch_ms) OVER w >= {V.HARD * 1000})::INT, 0) AS cut FROM photos WINDOW w AS (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id))
SELECT day_id, photo_id, sum(cut) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run_id FROM c"""
)
def gap_runs(spark: SparkSession, sf: str) -> DataFrame:
    return order.gap_runs(V.photos(spark, sf), V.HARD).select("day_id", "photo_id", "run_id")


@query(
    f"""WITH {V.SEGMENTS}, lab AS (SELECT s.*, CASE WHEN left_score IS NULL AND right_score IS NULL THEN 0 ELSE (coalesce(left_score, 0) + coalesce(right_score, 0)) / ((left_score IS NOT NULL)::INT + (right_score IS NOT NULL)::INT) END AS conf, l.boundary_label AS left_label
  FROM segs s LEFT JOIN labelled l ON l.day_id = s.day_id AND l.right_photo_id = s.start_photo_id), c AS (SELECT *, lag(conf) OVER w AS left_conf, lead(conf) OVER w AS right_conf, lead(left_label) OVER w AS right_label FROM lab WINDOW w AS (PARTITION BY day_id ORDER BY segment_index)),
m AS (SELECT n.*, s.start_ms, s.end_ms, s.left_score, s.right_score, s.left_label, s.right_label, conf, left_conf, right_conf, row_number() OVER w AS f, lead(1) OVER w AS l FROM numbered n JOIN c s USING (day_id, segment_index) WINDOW w AS (PARTITION BY n.day_id, n.segment_index ORDER BY start_epoch_ms, photo_id)),
q AS (SELECT *, CASE WHEN f = 1 AND left_score IS NOT NULL THEN CASE WHEN left_score < 0.95 THEN 'boundary_score' WHEN left_conf < 0.95 OR conf < 0.95 THEN 'segment_confidence' WHEN left_label <> 'hard' THEN 'boundary_label' END END AS ra,
  CASE WHEN l IS NULL AND right_score IS NOT NULL THEN CASE WHEN right_score < 0.95 THEN 'boundary_score' WHEN conf < 0.95 OR right_conf < 0.95 THEN 'segment_confidence' WHEN right_label <> 'hard' THEN 'boundary_label' END END AS rb FROM m)
SELECT day_id, photo_id, round(least(CASE WHEN left_score IS NOT NULL THEN start_epoch_ms - start_ms END, CASE WHEN right_score IS NOT NULL THEN end_ms - start_epoch_ms END) / 1000.0::DOUBLE, 6) AS nearest_edge_seconds, coalesce(ra, rb) AS review_reason FROM q"""
)
def edge_review(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col("boundary_label")
    scored = V.kept_scores(spark, sf)
    cut = scored.select("day_id", F.col("right_photo_id").alias("photo_id"), F.when(label != "none", label).alias("_c"))
    rows = ranges.with_ranges(V.photos(spark, sf), order.ORDER).join(cut, ["day_id", "photo_id"], "left")
    numbered = ranges.running(ranges.with_ranges(rows, order.ORDER), order.ORDER, F.col("_c").isNotNull().cast("long"), "segment_index")
    labels = numbered.where("_c is not null").select("day_id", "segment_index", F.col("_c").alias("left_label"))
    w = Window.partitionBy("day_id").orderBy("segment_index")
    segs = boundaries.segment_confidence(V.segments(spark, sf, scored)).join(labels, ["day_id", "segment_index"], "left")
    beside = {"left_confidence": F.lag("segment_confidence").over(w), "right_confidence": F.lead("segment_confidence").over(w), "right_label": F.lead("left_label").over(w)}
    sides = segs.withColumns(beside).select("day_id", "segment_index", "left_score", "right_score", "left_label", "right_label", "segment_confidence", "left_confidence", "right_confidence")
    out = boundaries.edge_review(numbered.join(sides, ["day_id", "segment_index"]), ["start_epoch_ms", "photo_id"])
    return r6(out.select("day_id", "photo_id", "nearest_edge_seconds", "review_reason"), "nearest_edge_seconds")


@query(
    f"""WITH {V.PHOTOS}, f AS (SELECT day_id, photo_id, list(start_epoch_ms) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS t FROM photos),
g AS (SELECT day_id, photo_id, (t[2] - t[1]) / 1000.0::DOUBLE AS a, (t[3] - t[2]) / 1000.0::DOUBLE AS b, (t[4] - t[3]) / 1000.0::DOUBLE AS c FROM f WHERE len(t) = 4)
SELECT day_id, photo_id, round(b, 6) AS center_gap, round(a, 6) AS left_mean, round(c, 6) AS right_mean, round(a + b + c - greatest(a, b, c) - least(a, b, c), 5) AS median_gap, (b > 3 * (a + c) / 2)::INT AS gap_outlier, round(greatest(a, b, c), 6) AS max_gap FROM g"""
)
def gap_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = order.frame_windows(V.photos(spark, sf), 2, -1.0, F.col("start_epoch_ms")).where("window_status = 'full'").withColumnRenamed("frames", "t")
    out = rows.select("day_id", "photo_id", *(c.alias(n) for n, c in dataset.gap_features(F.col("t")).items()))
    return out.select("day_id", "photo_id", *(F.round(c, 6).alias(c) for c in ("center_gap", "left_mean", "right_mean", "max_gap")), F.round("median_gap", 5).alias("median_gap"), "gap_outlier")


@query(f"WITH {V.SCORES}, worn AS (SELECT *, CASE WHEN left_photo_id % 40 = 0 THEN 'none' ELSE boundary_label END AS label FROM labelled) SELECT 'label_score' AS rule, left_photo_id::VARCHAR AS key, '' AS detail FROM worn WHERE NOT (boundary_score BETWEEN 0 AND 1 AND ((label = 'none') = (boundary_score < 0.75)))")
def validate_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Every fortieth label is set to none; those that were not are broken now."""
    worn = F.when(F.col("left_photo_id") % 40 == 0, "none").otherwise(F.col("boundary_label"))
    return validate.label_score(V.scores(spark, sf).withColumn("boundary_label", worn), "left_photo_id")


@query(f"WITH {V.PHOTOS}, c AS (SELECT day_id, stream_id, count(*) AS n FROM photos GROUP BY ALL) SELECT 'unique' AS rule, day_id || '|' || stream_id AS key, n::VARCHAR AS detail FROM c WHERE n > 1")
def validate_unique(spark: SparkSession, sf: str) -> DataFrame:
    return validate.unique(V.photos(spark, sf), ["day_id", "stream_id"])


@query(
    f"""WITH {V.PAIRS}, w AS (SELECT left_photo_id, list(photo_id) AS x FROM pairs JOIN photos ON false GROUP BY 1), t AS (SELECT event_id AS photo_id, user_id::VARCHAR AS segment_id FROM events WHERE event_id % 7 <> 3),
c AS (SELECT p.day_id, l.segment_id <> r.segment_id AS boundary, (lag(p.left_photo_id) OVER w IS NOT NULL AND lead(p.left_photo_id) OVER w IS NOT NULL) AS whole, p.time_gap_seconds FROM pairs p LEFT JOIN t l ON l.photo_id = p.left_photo_id LEFT JOIN t r ON r.photo_id = p.right_photo_id WINDOW w AS (PARTITION BY p.day_id ORDER BY p.left_start_epoch_ms, p.left_photo_id))
SELECT day_id, count(*) AS generated, count_if(boundary IS NULL) AS missing_truth, count_if(boundary IS NOT NULL AND NOT whole) AS missing_window, count_if(boundary IS NOT NULL AND whole) AS retained, count_if(boundary) AS true_before, count_if(boundary AND whole) AS true_after
FROM c WHERE time_gap_seconds > {V.GAP} GROUP BY 1"""
)
def attrition(spark: SparkSession, sf: str) -> DataFrame:
    """Truth: a photo's user as its segment; a seventh of the photos has none."""
    p = V.photos(spark, sf)
    truth = p.where("photo_id % 7 <> 3").select("photo_id", F.col("user_id").cast("string").alias("segment_id"), F.lit("performance").alias("segment_type"))
    windows = order.frame_windows(p, 2, V.GAP, F.col("photo_id")).withColumn("right_photo_id", F.get("frames", F.array_position("frames", F.col("photo_id")).cast("int")))
    rows = dataset.with_truth(windows, truth, "photo_id", "right_photo_id").withColumn("status", dataset.candidate_status(F.col("boundary"), F.col("window_status")))
    return dataset.attrition(rows).drop("missing_artifact")


@query(
    f"""WITH {V.SCORES}, f AS (SELECT day_id, photo_id, event_type, lead(event_type) OVER w AS right_type, lag(photo_id) OVER w AS a, lead(photo_id, 2) OVER w AS d, (lead(start_epoch_ms) OVER w - start_epoch_ms) / 1000.0 AS gap, lead(photo_id) OVER w AS c
  FROM photos WINDOW w AS (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id))
SELECT photo_id::VARCHAR AS candidate_id, CASE WHEN f.day_id < '20240120' THEN 'train' WHEN f.day_id < '20240126' THEN 'validation' ELSE 'test' END AS split_name, f.event_type AS left_segment_type, f.right_type AS right_segment_type,
  f.event_type <> f.right_type AS boundary, f.event_type AS left_kind, f.right_type AS right_kind, round(b.boundary_score, 4)::DOUBLE AS score_02_03, round(l.smoothed_zscore, 4)::DOUBLE AS smooth_01_02, r.boundary_label AS label_03_04, round(gap::DOUBLE, 4) AS center_gap
FROM f JOIN labelled b ON b.left_photo_id = photo_id JOIN labelled l ON l.left_photo_id = a JOIN labelled r ON r.left_photo_id = c WHERE gap > {V.GAP} AND a IS NOT NULL AND d IS NOT NULL"""
)
def training_view(spark: SparkSession, sf: str) -> DataFrame:
    """Windows around long gaps as training rows; the kind of a photo is its event type, of which a tie takes that beside the gap."""
    p = V.photos(spark, sf)
    windows = order.frame_windows(p, 2, V.GAP, F.struct("photo_id", "start_epoch_ms", "event_type")).where("window_status = 'full'")
    pick = lambda f: F.transform("frames", lambda x: x[f])
    kind = lambda i: F.get("frames", F.lit(i))["event_type"]
    rows = windows.select(F.col("photo_id").cast("string").alias("candidate_id"), "day_id", F.lit(2).alias("window_radius"), pick("photo_id").alias("frame_ids"), pick("start_epoch_ms").alias("frame_ms"), kind(1).alias("left_segment_type"), kind(2).alias("right_segment_type"), (kind(1) != kind(2)).alias("boundary"))
    split = F.when(F.col("day_id") < "20240120", "train").when(F.col("day_id") < "20240126", "validation").otherwise("test")
    manifest = p.select("day_id").distinct().withColumn("split_name", split)
    described = p.select("photo_id", F.create_map(F.lit("kind"), F.array("event_type")).alias("values"))
    view = dataset.training_view(rows, manifest, V.scores(spark, sf), described, 2, {"kind": False})
    r4 = lambda c: F.round(c, 4)
    scores = [r4("heuristic_boundary_score_02_03").alias("score_02_03"), r4("heuristic_smoothed_zscore_01_02").alias("smooth_01_02"), F.col("heuristic_boundary_label_03_04").alias("label_03_04")]
    return view.select("candidate_id", "split_name", *dataset.LABELS, "left_kind", "right_kind", *scores, r4("center_gap").alias("center_gap"))


@query(
    f"""WITH {V.SEGMENTS}, inner_ AS (SELECT n.day_id, n.segment_index, l.boundary_score AS s, l.right_photo_id AS r,
  row_number() OVER (PARTITION BY n.day_id, n.segment_index ORDER BY l.boundary_score DESC, l.right_photo_id) AS k
  FROM numbered n JOIN labelled l ON l.day_id = n.day_id AND l.right_photo_id = n.photo_id WHERE l.boundary_label = 'none'),
t AS (SELECT day_id, segment_index, string_agg(r::VARCHAR, ',' ORDER BY k) AS top_photos, max(s) AS top_score FROM inner_ WHERE k <= 3 GROUP BY ALL)
SELECT g.day_id, g.segment_index, round(b.boundary_score, 6) AS score_before, round(a.boundary_score, 6) AS score_after, round(t.top_score, 6) AS top_score, t.top_photos
FROM segs g LEFT JOIN labelled b ON b.day_id = g.day_id AND b.right_photo_id = g.start_photo_id LEFT JOIN labelled a ON a.day_id = g.day_id AND a.left_photo_id = g.end_photo_id
LEFT JOIN t ON t.day_id = g.day_id AND t.segment_index = g.segment_index"""
)
def boundary_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """Each segment with the scores before and after it and the three largest ones inside."""
    scored = V.kept_scores(spark, sf).select("day_id", "left_photo_id", "right_photo_id", "boundary_score", (F.col("boundary_label") != "none").alias("is_cut"))
    rows = V.photos(spark, sf).select("day_id", "photo_id", "start_epoch_ms").join(scored.select("day_id", F.col("right_photo_id").alias("photo_id"), "is_cut"), ["day_id", "photo_id"], "left")
    numbered = ranges.running(ranges.with_ranges(rows, order.ORDER), order.ORDER, F.coalesce("is_cut", F.lit(False)).cast("long"), "segment_index")
    scored = scored.join(numbered.select("day_id", F.col("photo_id").alias("right_photo_id"), "segment_index"), ["day_id", "right_photo_id"])
    at = F.struct("start_epoch_ms", "photo_id")
    segments = numbered.groupBy("day_id", "segment_index").agg(F.min_by("photo_id", at).alias("start_photo_id"), F.max_by("photo_id", at).alias("end_photo_id"))
    out = review.boundary_diagnostics(segments, scored)
    top = F.array_join(F.transform("top_internal", lambda x: x["right_photo_id"].cast("string")), ",")
    out = out.select("day_id", "segment_index", "score_before", "score_after", F.get("top_internal", 0)["boundary_score"].alias("top_score"), top.alias("top_photos"))
    return r6(out, "score_before", "score_after", "top_score")


@query(
    f"""WITH {V.PHOTOS}, f AS (SELECT day_id, list({{'p': photo_id, 'ms': start_epoch_ms, 'u': user_id, 'e': event_type, 'v': value}}) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS f,
  (lead(start_epoch_ms) OVER (PARTITION BY day_id ORDER BY start_epoch_ms, photo_id) - start_epoch_ms) / 1000.0 AS gap FROM photos),
c AS (SELECT *, sha1('["' || day_id || '","' || f[2].p::VARCHAR || '","' || f[3].p::VARCHAR || '","v1|{{\\"window_radius\\":' || CASE WHEN f[3].u % 9 = 0 THEN '3' ELSE '2' END || '}}"]')[1:16] AS key,
  f[3].ms - floor(f[3].v * 60000)::BIGINT AS late FROM f WHERE gap > {V.GAP} AND len(f) = 4),
r AS (SELECT key, unnest([CASE WHEN f[3].u % 9 = 0 THEN 'params' END, CASE WHEN f[1].e = 'click' THEN 'window' END, CASE WHEN f[3].e = 'error' THEN 'center' END, CASE WHEN f[3].e = 'error' THEN 'id' END,
  CASE WHEN NOT (f[1].ms <= f[2].ms AND f[2].ms <= late AND late <= f[4].ms) THEN 'times' END, CASE WHEN f[2].e NOT IN ('view', 'click') THEN 'split' END,
  CASE WHEN (gap > {2 * V.GAP}) <> (f[2].u <> f[3].u) THEN 'boundary' END]) AS rule FROM c)
SELECT rule, key, '' AS detail FROM r WHERE rule IS NOT NULL"""
)
def candidate_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate rows of photos, some with a late clock, a wrong centre, other parameters, a turned window or an unknown split."""
    frame = F.struct(F.col("photo_id").alias("p"), F.col("start_epoch_ms").alias("ms"), F.col("user_id").alias("u"), F.col("event_type").alias("e"), F.col("value").alias("v"))
    rows = order.frame_windows(V.photos(spark, sf), 2, V.GAP, frame).where("window_status = 'full'")
    f = [F.get("frames", i) for i in range(4)]
    ids = F.array(*(x["p"] for x in f))
    params = F.concat(F.lit('{"window_radius":'), F.when(f[2]["u"] % 9 == 0, "3").otherwise("2"), F.lit("}"))
    times = [x["ms"] - F.floor(x["v"] * 60000) if i == 2 else x["ms"] for i, x in enumerate(f)]
    out = rows.select(
        "day_id",
        textfuncs.candidate_id(F.col("day_id"), f[1]["p"], f[2]["p"], F.concat(F.lit("v1|"), params)).alias("candidate_id"),
        F.lit("gap").alias("candidate_rule_name"),
        F.lit("v1").alias("candidate_rule_version"),
        params.alias("candidate_rule_params_json"),
        F.lit(2).alias("window_radius"),
        F.when(f[2]["e"] == "error", f[0]["p"]).otherwise(f[1]["p"]).alias("center_left_photo_id"),
        f[2]["p"].alias("center_right_photo_id"),
        F.when(f[0]["e"] == "click", F.reverse(ids)).otherwise(ids).alias("window_photo_ids"),
        *(x["p"].alias(f"frame_{i:02d}_photo_id") for i, x in enumerate(f, 1)),
        *(x.alias(f"frame_{i:02d}_timestamp") for i, x in enumerate(times, 1)),
        F.when(f[1]["e"] == "view", "train").when(f[1]["e"] == "click", "").otherwise(f[1]["e"]).alias("split_name"),
        f[1]["u"].alias("left_segment_id"),
        f[2]["u"].alias("right_segment_id"),
        (F.col("center_gap_seconds") > 2 * V.GAP).alias("boundary"),
    )
    return validate.candidate_rows(out, 2)
