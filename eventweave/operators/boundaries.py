"""Boundary scores between neighbours, and segments made from them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.functions.vectors import cosine_distance, norm
from eventweave.operators import ranges
from eventweave.operators.order import DAY

#: Under this a standard deviation counts as 0.
FLAT = 1e-9


def align_artifacts(photos: DataFrame, quality: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """photos with quality and vector by key; keys that are not in all three are an error."""
    joined = photos.withColumn("_p", F.lit(1)).join(quality.withColumn("_q", F.lit(1)), key, "full_outer").join(vectors.withColumn("_v", F.lit(1)), key, "full_outer")
    whole = F.col("_p").isNotNull() & F.col("_q").isNotNull() & F.col("_v").isNotNull()
    checked = F.when(~whole, F.raise_error(F.concat(F.lit("not in all tables: "), F.col(key).cast("string"))).cast("boolean")).otherwise(F.lit(True))
    return joined.where(checked).drop("_p", "_q", "_v")


def pair_distances(pairs: DataFrame, vector: str = "embedding") -> DataFrame:
    return pairs.withColumn("distance", cosine_distance(F.col(f"left_{vector}"), F.col(f"right_{vector}"), norm(F.col(f"left_{vector}")), norm(F.col(f"right_{vector}"))))


def pair_deltas(pairs: DataFrame) -> DataFrame:
    """brightness_delta and contrast_delta of neighbours."""
    return pairs.withColumn("brightness_delta", F.abs(F.col("left_brightness") - F.col("right_brightness"))).withColumn("contrast_delta", F.abs(F.col("left_contrast") - F.col("right_contrast")))


def rolling_distance_stats(pairs: DataFrame, order: list[str], n: int = 3, value: str = "distance") -> DataFrame:
    """Mean and population deviation over the last n pairs, and the value's z-score there (0 where all are equal)."""
    near, back = ranges.neighbourhood(pairs, order, n - 1, 0)
    w = ranges.in_range(order).rowsBetween(-(n - 1), 0)
    out = back(near.withColumn("rolling_mean", F.avg(value).over(w)).withColumn("rolling_std", F.stddev_pop(value).over(w)))
    return out.withColumn("zscore", F.when(F.col("rolling_std") < FLAT, F.lit(0.0)).otherwise((F.col(value) - F.col("rolling_mean")) / F.col("rolling_std")))


def smooth_z(pairs: DataFrame, order: list[str], z: str = "zscore") -> DataFrame:
    """Weights 1/4, 1/2, 1/4 over neighbours; at the ends over what is there."""
    near, back = ranges.neighbourhood(pairs, order, 1, 1)
    w = ranges.in_range(order)
    before, after = F.lag(z).over(w), F.lead(z).over(w)
    side = lambda c: F.when(c.isNull(), 0.0).otherwise(0.25)
    value = (F.col(z) * 0.5 + F.coalesce(before * 0.25, F.lit(0.0)) + F.coalesce(after * 0.25, F.lit(0.0))) / (F.lit(0.5) + side(before) + side(after))
    return back(near.withColumn("smoothed_zscore", value))


def boundary_score(pairs: DataFrame, z_threshold: float = 1.5, soft_gap: float = 20, hard_gap: float = 90, z: str = "smoothed_zscore", d: str = "distance") -> DataFrame:
    """time_gap_boost, boundary_score in [0, 1], boundary_label (none under 0.75, soft, hard) and boundary_reason."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    gap, dist, zed = F.col("time_gap_seconds"), F.col(d), F.col(z)
    base = clamp(zed / (2 * z_threshold)) * 0.75 + clamp(dist / 0.35) * 0.25
    backed = (zed >= 0.75 * z_threshold) | (dist >= 0.2)
    boost = F.when(gap >= hard_gap, 1.0).when((gap >= soft_gap) & backed, 0.25).otherwise(0.0)
    score = F.when(gap >= hard_gap, F.lit(1.0)).otherwise(clamp(base + boost))
    label = F.when(gap >= hard_gap, "hard").when(score >= 0.75, "soft").otherwise("none")
    reason = F.when(gap >= hard_gap, "hard_gap").when((score >= 0.75) & (boost > 0), "distance_and_gap").when(score >= 0.75, "distance").otherwise("none")
    return pairs.withColumns({"time_gap_boost": boost, "boundary_score": score, "boundary_label": label, "boundary_reason": reason})


def segments_from_cuts(photos: DataFrame, cut: Column, score: Column, order: list[str]) -> DataFrame:
    """Contiguous segments of each day from a flag on the first photo after a cut: segment_index, first and last photo and time, count, and
    the score of the cut on its right (null at the day's end)."""
    marked = photos.select(DAY, "photo_id", *(c for c in order if c != "photo_id"), *(c for c in photos.columns if c == ranges.RANGE), cut.cast("long").alias("_cut"), F.when(cut, score).alias("_left"))
    # segments inside a range first; of these few rows, those that do not begin with a cut go on with the segment of the range before
    local = F.sum("_cut").over(ranges.in_range(order).rowsBetween(Window.unboundedPreceding, 0))
    at = F.struct(*(c for c in order if c != "photo_id"), "photo_id")
    rows = ranges.with_ranges(marked, order).withColumn("_local", local)
    ends = [F.min(at).alias("_first"), F.max(at).alias("_last"), F.min("start_epoch_ms").alias("start_ms"), F.max("start_epoch_ms").alias("end_ms")]
    parts = rows.groupBy(*ranges.KEYS, "_local").agg(*ends, F.count(F.lit(1)).alias("photo_count"), F.max("_left").alias("left_score"))
    begun = F.sum((F.col("_local") > 0).cast("long")).over(ranges.over([DAY], [ranges.RANGE, "_local"]).rowsBetween(Window.unboundedPreceding, 0))
    whole = parts.withColumn("segment_index", begun).groupBy(DAY, "segment_index").agg(
        F.min("_first").getField("photo_id").alias("start_photo_id"),
        F.max("_last").getField("photo_id").alias("end_photo_id"),
        F.min("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        F.sum("photo_count").alias("photo_count"),
        F.max("left_score").alias("left_score"),
    )
    return whole.withColumn("right_score", F.lead("left_score").over(Window.partitionBy(DAY).orderBy("segment_index")))


def enforce_min_segments(segments: DataFrame, min_photos: int = 8, min_seconds: float = 5) -> DataFrame:
    """While a segment of a day is too small, the leftmost such one loses its weaker cut (equal: the left). One pass over the rows of a
    day's segments; left of the place of work all segments are large enough. Bounded by the number of segments of a day."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("segment_index").to_dict("records")
        i = 0
        while i < len(rows):
            r = rows[i]
            small = r["photo_count"] < min_photos or (r["end_ms"] - r["start_ms"]) / 1000.0 < min_seconds
            if not small or len(rows) == 1:
                i += 1
                continue
            left = r["left_score"] if i > 0 else None
            right = r["right_score"] if i + 1 < len(rows) else None
            j = i - 1 if right is None or (left is not None and left <= right) else i
            a, b = rows[j], rows[j + 1]
            rows[j : j + 2] = [a | {"end_photo_id": b["end_photo_id"], "end_ms": b["end_ms"], "photo_count": a["photo_count"] + b["photo_count"], "right_score": b["right_score"]}]
            i = j
        for k, r in enumerate(rows):
            r["segment_index"] = k
        return pd.DataFrame(rows, columns=pdf.columns)

    return segments.groupBy(DAY).applyInPandas(merge, segments.schema)


def segment_confidence(segments: DataFrame) -> DataFrame:
    """Mean score of the cuts on both sides that are there; 0 without any."""
    n = F.col("left_score").isNotNull().cast("int") + F.col("right_score").isNotNull().cast("int")
    total = F.coalesce("left_score", F.lit(0.0)) + F.coalesce("right_score", F.lit(0.0))
    return segments.withColumn("segment_confidence", F.when(n == 0, F.lit(0.0)).otherwise(total / n))


def review_reason(score: Column, label: Column, left_confidence: Column, right_confidence: Column, certain: float = 0.95) -> Column:
    """Why a cut is uncertain: its score, the confidence of a segment beside it, or a label that is not hard; null if it is certain."""
    return (
        F.when(score < certain, "boundary_score")
        .when((left_confidence < certain) | (right_confidence < certain), "segment_confidence")
        .when(F.coalesce(label != "hard", F.lit(True)), "boundary_label")
    )


def edge_review(members: DataFrame, order: list[str], certain: float = 0.95) -> DataFrame:
    """nearest_edge_seconds (to an edge of the segment that has a neighbour) and review_reason, and review (whether there is one): of the
    first and last photo of a segment whose cut there is uncertain (of the two of a single photo, the left one first).

    members: photos with segment_index, left_score, right_score (null without a neighbour), left_label, right_label, segment_confidence,
    left_confidence and right_confidence (of the neighbours)."""
    w = Window.partitionBy(DAY, "segment_index").orderBy(*order)
    whole = Window.partitionBy(DAY, "segment_index")
    out = members.withColumns({"_f": F.row_number().over(w) == 1, "_l": F.lead(F.lit(1)).over(w).isNull(), "_a": F.min("start_epoch_ms").over(whole), "_b": F.max("start_epoch_ms").over(whole)})
    left, right = F.col("left_score").isNotNull(), F.col("right_score").isNotNull()
    near = F.least(F.when(left, F.col("start_epoch_ms") - F.col("_a")), F.when(right, F.col("_b") - F.col("start_epoch_ms"))) / 1000.0
    at_left = F.when(F.col("_f") & left, review_reason(F.col("left_score"), F.col("left_label"), F.col("left_confidence"), F.col("segment_confidence"), certain))
    at_right = F.when(F.col("_l") & right, review_reason(F.col("right_score"), F.col("right_label"), F.col("segment_confidence"), F.col("right_confidence"), certain))
    reason = F.coalesce(at_left, at_right)
    return out.withColumns({"nearest_edge_seconds": near, "review_reason": reason, "review": reason.isNotNull()}).drop("_f", "_l", "_a", "_b")
