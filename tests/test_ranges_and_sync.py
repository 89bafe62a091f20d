"""Days by ranges against plain windows by day, and the chain from clips and loudness to clock corrections."""

from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventweave.operators import boundaries, order, ranges, sync

SCHEMA = "day_id string, photo_id long, start_epoch_ms long, value double, cut boolean"


def photos(spark, seed=1):
    """Days of several lengths: one photo, a burst inside one minute, ties, long gaps, and a day without an id."""
    r = random.Random(seed)
    rows = [("one", 1, 5, 0.5, False)]
    rows += [("burst", i, 60_000 + r.randrange(3000), r.random(), r.random() < 0.1) for i in range(150)]
    rows += [("ties", i, 1000 * (i // 7), r.random(), r.random() < 0.2) for i in range(60)]
    rows += [(None, i, r.randrange(10**7), r.random(), i % 9 == 0) for i in range(40)]
    t = 0
    for i in range(300):
        t += r.choice([10, 500, 70_000, 900_000])
        rows.append(("long", i, t, r.random(), r.random() < 0.05))
    r.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(params=[7, 60, 200_000])
def size(request, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", request.param)
    return request.param


def by_day():
    return Window.partitionBy("day_id").orderBy("start_epoch_ms", "photo_id")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_positions_and_runs(spark, size):
    p = photos(spark)
    assert rows(order.photo_order(p), "day_id", "photo_id", "photo_order_index") == rows(p.withColumn("i", F.row_number().over(by_day()) - 1), "day_id", "photo_id", "i")
    cut = (F.coalesce(F.col("start_epoch_ms") - F.lag("start_epoch_ms").over(by_day()), F.lit(0)) >= 60_000).cast("long")
    plain = p.withColumn("c", cut).withColumn("run", F.sum("c").over(by_day()))
    assert rows(order.gap_runs(p, 60), "day_id", "photo_id", "run_id") == rows(plain, "day_id", "photo_id", "run")
    if size == 7:
        assert ranges.with_ranges(p, order.ORDER).groupBy("day_id", "range_no").count().agg(F.max("count"), F.count("*")).first()[1] > 30


def test_pairs_and_statistics(spark, size):
    p = photos(spark)
    pairs = order.adjacent_pairs(p, ["photo_id", "start_epoch_ms", "value"])
    w = by_day()
    plain = p.withColumns({"r": F.lead("photo_id").over(w), "t": F.lead("start_epoch_ms").over(w)}).where("r is not null")
    assert rows(pairs, "day_id", "left_photo_id", "right_photo_id", "right_start_epoch_ms") == rows(plain, "day_id", "photo_id", "r", "t")
    o = ["left_start_epoch_ms", "left_photo_id"]
    d = pairs.withColumn("distance", F.abs(F.col("left_value") - F.col("right_value")))
    got = boundaries.smooth_z(boundaries.rolling_distance_stats(d, o), o)
    v = Window.partitionBy("day_id").orderBy(*o)
    z = F.when(F.col("s") < 1e-9, 0.0).otherwise((F.col("distance") - F.col("m")) / F.col("s"))
    want = d.withColumns({"m": F.avg("distance").over(v.rowsBetween(-2, 0)), "s": F.stddev_pop("distance").over(v.rowsBetween(-2, 0))}).withColumn("z", z)
    weights = [F.coalesce(c.over(v) * 0.25, F.lit(0.0)) for c in (F.lag("z"), F.lead("z"))]
    there = [F.when(c.over(v).isNull(), 0.0).otherwise(0.25) for c in (F.lag("z"), F.lead("z"))]
    want = want.withColumn("smooth", (F.col("z") * 0.5 + weights[0] + weights[1]) / (0.5 + there[0] + there[1]))
    r = lambda c: F.round(c, 9)
    assert rows(got, "day_id", "left_photo_id", r("rolling_mean"), r("smoothed_zscore")) == rows(want, "day_id", "left_photo_id", r("m"), r("smooth"))
    # one halo for all steps
    near = ranges.with_halo(ranges.with_ranges(p, order.ORDER), order.ORDER, 3, 2)
    d = order.adjacent_pairs(near, ["photo_id", "start_epoch_ms", "value"]).withColumn("distance", F.abs(F.col("left_value") - F.col("right_value")))
    fused = ranges.own_rows(boundaries.smooth_z(boundaries.rolling_distance_stats(d, o), o))
    assert rows(fused, "day_id", "left_photo_id", r("smoothed_zscore")) == rows(got, "day_id", "left_photo_id", r("smoothed_zscore"))


def test_windows_and_segments(spark, size):
    p = photos(spark)
    w = by_day()
    got = order.frame_windows(p, 3, 0.4, F.col("photo_id"))
    around = F.collect_list("photo_id").over(w.rowsBetween(-2, 3))
    plain = p.withColumns({"f": around, "gap": (F.lead("start_epoch_ms").over(w) - F.col("start_epoch_ms")) / 1000}).where("gap > 0.4")
    assert rows(got, "day_id", "photo_id", "frames") == rows(plain, "day_id", "photo_id", "f")
    got = boundaries.segments_from_cuts(p, F.col("cut"), F.col("value"), ["start_epoch_ms", "photo_id"])
    numbered = p.withColumn("s", F.sum(F.col("cut").cast("long")).over(w))
    plain = numbered.groupBy("day_id", "s").agg(F.count("*").alias("n"), F.min("start_epoch_ms").alias("a"), F.max(F.when(F.col("cut"), F.col("value"))).alias("l"))
    # a day whose first photo has a cut begins with segment 1 by either rule
    lowest = plain.groupBy(F.col("day_id").alias("d")).agg(F.min("s").alias("low")).collect()
    assert {r["low"] for r in lowest} <= {0, 1}
    assert rows(got, "day_id", "segment_index", "photo_count", "start_ms", "left_score") == rows(plain, "day_id", "s", "n", "a", "l")


def test_centered_windows(spark, size):
    got = rows(order.centered_windows(photos(spark).where("day_id is not null"), 2, 60), "day_id", "start_row", "end_row", "cut_index")
    want = []
    every = sorted(photos(spark).where("day_id is not null").collect(), key=lambda r: (r["day_id"], r["start_epoch_ms"], r["photo_id"]))
    for day, own in itertools.groupby(every, key=lambda r: r["day_id"]):
        t = [r["start_epoch_ms"] for r in own]
        best = {}
        for i in range(len(t) - 1):
            if round((t[i + 1] - t[i]) / 1000) > 60:
                best.setdefault(max(0, min(i - 1, len(t) - 4)), []).append((t[i] - t[i + 1], i))
        want += [(day, s, min(s + 4, len(t)), min(g)[1]) for s, g in best.items()]
    assert got == sorted(want, key=repr)


def test_windows_over_photos_are_by_range(spark):
    """The plan of a chain over photos has no window by day over more than a row a range or a bucket."""
    plan = order.gap_runs(photos(spark), 60)._jdf.queryExecution().optimizedPlan().toString()
    specs = [line for line in plan.split("\n") if "Window [" in line]
    assert any("range_no" in s.rsplit("], [", 2)[1] for s in specs)
    alone = [s for s in specs if "range_no" not in s.rsplit("], [", 2)[1]]
    assert alone and all("_bucket" in s or "_tail" in s or "_head" in s or "_t#" in s for s in alone)


def brute_pairs(clips, ref, least, most):
    out = []
    for stream in sorted({c[0] for c in clips} - {ref}):
        pairs = []
        for s, i, a, b in clips:
            for t, j, c, d in clips:
                if s == ref and t == stream and min(b, d) - max(a, c) >= least * 1000:
                    lo, hi = max(a, c), min(b, d)
                    pairs.append((lo + (hi - lo) // 2, i, j, (hi - lo) / 1000))
        pairs.sort()
        shares = {}
        for k, p in enumerate(pairs):
            shares.setdefault(k if len(pairs) <= most else k * most // len(pairs), []).append(p)
        out += [(stream, *min(g, key=lambda p: (-p[3], p[1], p[2]))) for g in shares.values()]
    return sorted(out)


@pytest.mark.parametrize(("seed", "n", "span", "step"), [(1, 12, 50_000, 1 << 20), (2, 40, 3000, 64), (3, 25, 400, 7), (4, 3, 9000, 1)])
def test_overlap_pairs_brute(spark, monkeypatch, seed, n, span, step):
    monkeypatch.setattr(sync, "STEP", step)
    r = random.Random(seed)
    clips = [(f"v{k}", 100 * k + i, a := 1000 * r.randrange(span // 100), a + r.randrange(1, span)) for k in range(3) for i in range(n)]
    df = spark.createDataFrame([("d", *c) for c in clips] + [("e", "v0", 1, 0, 9)], "day_id string, stream_id string, clip_id long, start_ms long, end_ms long")
    ref = spark.createDataFrame([("d", "v1"), ("e", "v0")], "day_id string, reference_stream_id string")
    got = sorted((x["stream_id"], x["midpoint_ms"], x["ref_clip"], x["clip_id"], x["overlap_s"]) for x in sync.overlap_pairs(df, ref, 0.2, 6).collect())
    assert got == brute_pairs(clips, "v1", 0.2, 6)


def test_overlap_pairs_of_many_clips_are_counted_not_listed():
    """900 million pairs of one midpoint and length: the shares begin at known ids, and no step looks at all pairs."""
    n, began = 30_000, time.process_time()
    clips = {"start": np.zeros(n, np.int64), "end": np.full(n, 10_000), "rank": np.arange(n)}
    firsts = [-(-k * n * n // 6) for k in range(6)]
    assert sync._chosen(clips, clips, 1000, 6) == [(f // n, f % n, 5000, 10_000) for f in firsts]
    assert time.process_time() - began < 20


def test_sync_map_finds_clocks(spark):
    """Three cameras hear one signal; clocks are late by known seconds. A flat clip, one without loudness and a short overlap are errors."""
    rate, r = 2.0, np.random.default_rng(5)
    signal = r.random(4000).astype(np.float32)
    late = {"v-a": 0, "v-b": 7, "v-c": -12}
    clips, loud = [], []
    for s, by in late.items():
        for i, first in enumerate((0, 500, 1000)):
            length = 400 + (s == "v-a")
            clips.append(("d", s, i, (first + by) * 1000, (first + by + length) * 1000))
            loud.append(("d", s, i, signal[int(first * rate) : int((first + length) * rate)].tolist()))
    clips += [("d", "v-b", 8, 1_500_000, 1_700_000), ("d", "v-a", 9, 1_500_000, 1_700_000), ("d", "v-d", 1, 1_500_000, 1_700_000), ("d", "v-e", 1, 9_000_000, 9_100_000)]
    loud += [("d", "v-b", 8, [1.0] * 400), ("d", "v-a", 9, signal[-400:].tolist())]
    c = spark.createDataFrame(clips, "day_id string, stream_id string, clip_id int, start_ms long, end_ms long")
    e = spark.createDataFrame(loud, "day_id string, stream_id string, clip_id int, envelope array<float>")
    got = {x["stream_id"]: x for x in sync.sync_map(c, e, rate).collect()}
    assert {k: got[k]["correction_seconds"] for k in late} == {"v-a": 0.0, "v-b": -7.0, "v-c": 12.0}
    assert got["v-a"]["notes"] == "reference stream" and got["v-e"]["notes"] == "no overlapping clips" and got["v-d"]["notes"] == "no usable pair"
    assert got["v-b"]["pair_count"] == 4 and got["v-b"]["successful_pairs"] == 3 and got["v-b"]["notes"] == "pairs rejected"


def test_sync_windows(spark):
    rows_ = [(0, 100.0, 30_000, 100.0, 70.0), (0, 1000.0, 300_000, 1000.0, 700.0), (0, 61.0, 1000, 500.0, 60.0), (50_000, 300.0, 0, 110.0, 60.0)]
    w = sync.sync_windows(spark.createDataFrame(rows_, "ref_start_ms long, ref_duration_s double, start_ms long, duration_s double, overlap_s double")).collect()
    assert [(x["ref_window_s"], x["window_start_s"], x["window_s"], x["message"]) for x in w] == [(10.0, 0.0, 90.0, None), (280.0, 0.0, 180.0, None), (0.0, 0.0, 61.0, None), (0.0, 30.0, 80.0, None)]
