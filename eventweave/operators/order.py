"""Order inside a day: positions, neighbours, gap runs and frame windows. Days are worked on by time ranges (``ranges``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.operators import ranges

DAY = "day_id"
ORDER = ("start_epoch_ms", "photo_id")


def photo_order(df: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    out = ranges.running(ranges.with_ranges(df, order), order, F.lit(1).cast("long"), "photo_order_index")
    return out.withColumn("photo_order_index", F.col("photo_order_index") - 1).drop(ranges.RANGE)


def adjacent_pairs(df: DataFrame, columns: list[str], order: tuple[str, ...] = ORDER) -> DataFrame:
    """left_* and right_* columns of neighbours, and time_gap_seconds; n rows of a day give n - 1 pairs. With a halo in df the pairs keep
    that of their left photo."""
    near, back = ranges.neighbourhood(df, order, 0, 1)
    w = ranges.in_range(order)
    right = [F.lead(c).over(w).alias(f"right_{c}") for c in columns]
    out = near.select(*ranges.KEYS, ranges.OWN, *(F.col(c).alias(f"left_{c}") for c in columns), *right, F.lead(F.lit(1)).over(w).alias("_r"))
    out = back(out.where("_r = 1").drop("_r"))
    return out.withColumn("time_gap_seconds", (F.col("right_start_epoch_ms") - F.col("left_start_epoch_ms")) / 1000.0)


def gap_candidates(pairs: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Pairs whose gap is strictly above the threshold."""
    return pairs.where(F.col("time_gap_seconds") > threshold)


def gap_runs(df: DataFrame, gap_s: float, order: tuple[str, ...] = ORDER) -> DataFrame:
    """run_id: counts the gaps of at least gap_s before a row in its day."""
    near = ranges.with_halo(ranges.with_ranges(df, order), order, 1, 0)
    before = F.lag("start_epoch_ms").over(ranges.in_range(order))
    marked = near.withColumn("_cut", F.coalesce(((F.col("start_epoch_ms") - before) >= gap_s * 1000).cast("long"), F.lit(0).cast("long")))
    return ranges.running(marked.where(ranges.OWN).drop(ranges.OWN), order, F.col("_cut"), "run_id").drop("_cut", ranges.RANGE)


def frame_windows(df: DataFrame, radius: int, threshold: float, frame: Column, order: tuple[str, ...] = ORDER) -> DataFrame:
    """For each gap above the threshold the 2 * radius frames around it (frames), and window_status full or incomplete."""
    near, back = ranges.neighbourhood(df, order, radius - 1, radius)
    w = ranges.in_range(order)
    around = w.rowsBetween(-(radius - 1), radius)
    out = back(near.withColumn("frames", F.collect_list(frame).over(around)).withColumn("_next", F.lead("start_epoch_ms").over(w)))
    out = out.withColumn("center_gap_seconds", (F.col("_next") - F.col("start_epoch_ms")) / 1000.0).where(F.col("center_gap_seconds") > threshold)
    return out.withColumn("window_status", F.when(F.size("frames") == 2 * radius, "full").otherwise("incomplete")).drop("_next")


def centered_windows(df: DataFrame, radius: int, gap_s: float, order: tuple[str, ...] = ORDER) -> DataFrame:
    """start_row and end_row of windows around gaps whose rounded seconds exceed gap_s, held inside the day; of several gaps with one
    start the largest (then the first) stays. cut_index is the left row of the gap."""
    size = 2 * radius
    near = ranges.with_halo(ranges.with_ranges(df.select(DAY, *order), order), order, 0, 1)
    gap = (F.lead("start_epoch_ms").over(ranges.in_range(order)) - F.col("start_epoch_ms")) / 1000.0
    placed = ranges.running(near.withColumn("gap", gap).where(ranges.OWN).drop(ranges.OWN), order, F.lit(1).cast("long"), "i")
    days = df.groupBy(F.col(DAY).alias("_day")).agg(F.count(F.lit(1)).alias("n"))
    rows = placed.withColumn("i", F.col("i") - 1).where(F.bround("gap") > gap_s).join(days, F.col(DAY).eqNullSafe(F.col("_day")))
    hits = rows.withColumn("start_row", F.greatest(F.lit(0), F.least(F.col("i") - (radius - 1), F.col("n") - size)))
    best = F.row_number().over(Window.partitionBy(DAY, "start_row").orderBy(F.desc("gap"), "i"))
    end = F.least(F.col("start_row") + size, F.col("n")).alias("end_row")
    return hits.withColumn("r", best).where("r = 1").select(DAY, "start_row", end, F.col("i").alias("cut_index"), F.col("gap").alias("gap_seconds"))


def stride_windows(df: DataFrame, radius: int) -> DataFrame:
    """Windows of 2 * radius rows every radius rows, and one that ends at the last row."""
    size = 2 * radius
    days = df.groupBy(DAY).agg(F.count(F.lit(1)).alias("n"))
    last = F.greatest(F.lit(0), F.col("n") - size)
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0).cast("long"), last, F.lit(radius).cast("long")), F.array(last)))
    return days.select(DAY, "n", F.explode(starts).alias("start_row")).select(DAY, "start_row", F.least(F.col("start_row") + size, F.col("n")).alias("end_row"))
