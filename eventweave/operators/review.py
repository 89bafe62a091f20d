"""Replay of review decisions: splits, merges, selections, statistics, cases."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = "day_id"


def apply_splits(photos: DataFrame, specs: DataFrame) -> DataFrame:
    """photos (day_id, set_id, pos, filename): a set is cut before each named file. The part before the first cut keeps its id, later parts are
    ``base::file``. Files that the set does not have cut nothing."""
    marks = specs.select(DAY, F.col("base_set_id").alias("set_id"), F.col("start_filename").alias("filename"), F.lit(1).alias("_c")).distinct()
    w = Window.partitionBy(DAY, "set_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = photos.join(marks, [DAY, "set_id", "filename"], "left").withColumn("_f", F.last(F.when((F.col("_c") == 1) & (F.col("pos") > 0), F.col("filename")), True).over(w))
    return out.withColumn("base_set_id", F.col("set_id")).withColumn("set_id", F.when(F.col("_f").isNull(), F.col("set_id")).otherwise(F.concat("set_id", F.lit("::"), "_f"))).drop("_c", "_f")


def merge_map(sets: DataFrame, merges: DataFrame) -> DataFrame:
    """set_id, final_set_id: merges of a day in order of seq. A merge whose target or source is gone (already consumed, or unknown) does
    nothing. A task looks at the set ids and merges of one day."""
    rows = sets.select(DAY, "set_id").distinct().select(DAY, F.lit(-1).alias("seq"), "set_id", F.lit(None).cast("string").alias("source")).union(merges.select(DAY, F.col("seq").cast("int"), F.col("target_set_id"), F.col("source_set_id")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known = {s: [s] for s in pdf.loc[pdf["seq"] < 0, "set_id"]}
        for r in pdf[pdf["seq"] >= 0].sort_values("seq").itertuples():
            if r.set_id in known and r.source in known and r.set_id != r.source:
                known[r.set_id] += known.pop(r.source)
        return pd.DataFrame([(pdf[DAY].iloc[0], s, t) for t, members in known.items() for s in members], columns=[DAY, "set_id", "final_set_id"])

    return rows.groupBy(DAY).applyInPandas(run, f"{DAY} string, set_id string, final_set_id string")


def apply_merges(photos: DataFrame, merges: DataFrame) -> DataFrame:
    moved = photos.join(merge_map(photos, merges), [DAY, "set_id"])
    return moved.withColumn("set_id", F.col("final_set_id")).drop("final_set_id")


def reviewed_truth(photos: DataFrame) -> DataFrame:
    """photo_id, segment_id, segment_type; a blank or doubled photo is an error."""
    n = F.count(F.lit(1)).over(Window.partitionBy("photo_id"))
    bad = F.when(F.coalesce(F.col("photo_id").cast("string"), F.lit("")) == "", "blank photo").when(n > 1, "doubled photo")
    out = photos.withColumn("_bad", bad)
    return out.select("photo_id", F.when(F.col("_bad").isNotNull(), F.raise_error("_bad").cast("string")).otherwise(F.col("set_id")).alias("segment_id"), "segment_type")


def set_stats(photos: DataFrame, gap_s: float = 600) -> DataFrame:
    """Per set: counts, first and last time, duration, and the largest inner gap with the photos around it (only above gap_s)."""
    w = Window.partitionBy(DAY, "set_id").orderBy("start_epoch_ms", "photo_id")
    rows = photos.withColumn("_g", (F.col("start_epoch_ms") - F.lag("start_epoch_ms").over(w)) / 1000.0).withColumn("_p", F.lag("photo_id").over(w))
    big = F.max(F.when(F.col("_g") > gap_s, F.struct("_g", (-F.col("start_epoch_ms")).alias("t"), F.col("_p").alias("a"), F.col("photo_id").alias("b"))))
    out = rows.groupBy(DAY, "set_id").agg(F.count(F.lit(1)).alias("photo_count"), F.count_if("review").alias("review_count"), F.min("start_epoch_ms").alias("first_ms"), F.max("start_epoch_ms").alias("last_ms"), big.alias("_m"))
    return out.select(DAY, "set_id", "photo_count", "review_count", "first_ms", "last_ms", ((F.col("last_ms") - F.col("first_ms")) / 1000.0).alias("duration_s"), F.col("_m._g").alias("max_gap_s"), F.col("_m.a").alias("gap_left"), F.col("_m.b").alias("gap_right"))


def resolve_selection(selection: DataFrame, photos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Selected rows matched by source path, else by stream and file (of several photos the one with the smallest path), distinct paths in
    order; and the rows without a match."""
    by_path = photos.groupBy(F.col("source_path").alias("_sp")).agg(F.min("relative_path").alias("_a"))
    by_file = photos.groupBy(F.col("stream_id").alias("_st"), F.col("filename").alias("_fn")).agg(F.min("relative_path").alias("_b"))
    out = selection.join(by_path, F.col("source_path") == F.col("_sp"), "left").join(by_file, (F.col("stream_id") == F.col("_st")) & (F.col("filename") == F.col("_fn")), "left").withColumn("relative_path", F.coalesce("_a", "_b"))
    hit = out.where("relative_path is not null").groupBy("relative_path").agg(F.min("order").alias("order"))
    return hit, out.where("relative_path is null").select(*selection.columns)


def boundary_diagnostics(segments: DataFrame, scores: DataFrame, top: int = 3) -> DataFrame:
    """segments (day_id, segment_index, start_photo_id, end_photo_id) with score_before and score_after, of the pairs around them (null at
    the ends of a day), and top_internal, the ``top`` largest scores inside. scores (day_id, left_photo_id, right_photo_id, boundary_score,
    is_cut) has the segment_index of its right photo."""
    w = Window.partitionBy(DAY, "segment_index").orderBy(F.desc("boundary_score"), "right_photo_id")
    inner = scores.where("not is_cut").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
    largest = F.array_sort(F.collect_list(F.struct("_r", "boundary_score", "left_photo_id", "right_photo_id")))
    inner = inner.groupBy(DAY, "segment_index").agg(F.transform(largest, lambda s: s.dropFields("_r")).alias("top_internal"))
    before = scores.select(DAY, F.col("right_photo_id").alias("start_photo_id"), F.col("boundary_score").alias("score_before"))
    after = scores.select(DAY, F.col("left_photo_id").alias("end_photo_id"), F.col("boundary_score").alias("score_after"))
    out = segments.join(before, [DAY, "start_photo_id"], "left").join(after, [DAY, "end_photo_id"], "left")
    return out.join(inner, [DAY, "segment_index"], "left")


def merge_review_entries(entries: DataFrame, mapping: DataFrame) -> DataFrame:
    """Entries of all base sets of a final set: flags by OR, counts by max, first view earliest, last view latest, first non-blank override."""
    rows = entries.join(mapping.select(DAY, "set_id", "final_set_id"), [DAY, "set_id"])
    override = F.nullif(F.trim("segment_type_override"), F.lit(""))
    return rows.groupBy(DAY, "final_set_id").agg(F.max("viewed").alias("viewed"), F.max("view_count").alias("view_count"), F.min("first_viewed").alias("first_viewed"), F.max("last_viewed").alias("last_viewed"), F.min_by(override, F.when(override.isNotNull(), F.col("entry_order"))).alias("segment_type_override"))


def find_set(sets: DataFrame, name: str) -> DataFrame:
    """Exactly one set of that display name; none or several are an error that lists them."""
    n = sets.where(F.col("display_name") == name).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("set_id")).alias("ids"))
    return n.select(F.when(F.col("n") == 1, F.get("ids", 0)).otherwise(F.raise_error(F.concat(F.lit("matches: "), F.array_join("ids", ", ")))).alias("set_id"))


def presence_flags(sets: DataFrame, files: DataFrame) -> DataFrame:
    """Per set the photos without a proxy file, and the first and last that exist."""
    out = sets.join(files.select("path", F.lit(True).alias("_e")), "path", "left")
    there = F.col("_e").isNotNull()
    return out.groupBy(DAY, "set_id").agg(F.count_if(~there).alias("missing_count"), F.min_by("path", F.when(there, F.struct("start_epoch_ms", "path"))).alias("first_proxy"), F.max_by("path", F.when(there, F.struct("start_epoch_ms", "path"))).alias("last_proxy"))


def best_candidate_for_set(sets: DataFrame, candidates: DataFrame, max_s: float) -> DataFrame:
    """The candidate of the set's number within max_s of its first photo: not-later ones first, then the nearest, then by stream and id.

    Sets and candidates of a number stand in one order of time, once forwards (the last candidate by then) and once backwards (the next
    one), so no row is made for a pair of them."""
    none = {c: F.lit(None).cast(candidates.schema[c].dataType).alias(c) for c in ("stream_id", "id")}
    said = candidates.select(DAY, "number", F.col("start_ms").alias("t"), F.lit(0).alias("kind"), "stream_id", "id", F.lit(None).cast(sets.schema["set_id"].dataType).alias("set_id"))
    begun = sets.select(DAY, "number", F.col("first_ms").alias("t"), F.lit(1).alias("kind"), *none.values(), "set_id")
    rows = said.unionByName(begun).where(F.col(DAY).isNotNull() & F.col("number").isNotNull() & F.col("t").isNotNull())
    rows = rows.withColumn("_c", F.when(F.col("kind") == 0, F.struct("t", "stream_id", "id")))
    w = Window.partitionBy(DAY, "number")
    order = {"_back": ("t", "kind"), "_next": (F.desc("t"), F.desc("kind"))}
    sides = {k: F.last("_c", True).over(w.orderBy(*by, F.desc("stream_id"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)) for k, by in order.items()}
    delta = lambda c: (c["t"] - F.col("t")) / 1000.0
    near = lambda k: F.when(F.abs(delta(F.col(k))) <= max_s, F.struct((delta(F.col(k)) > 0).alias("later"), F.abs(delta(F.col(k))).alias("distance_s"), F.col(k)["stream_id"].alias("stream_id"), F.col(k)["id"].alias("c_id")))
    found = rows.withColumns(sides).where("kind = 1").select(DAY, "set_id", F.coalesce(near("_back"), near("_next")).alias("_f"))
    best = found.where("_f is not null").groupBy(DAY, "set_id").agg(F.min("_f").alias("_f"))
    return best.select(DAY, "set_id", F.col("_f.c_id").alias("c_id"), F.col("_f.distance_s").alias("distance_s"))


def nearby_conflicts(windows: DataFrame, candidates: DataFrame, seconds: float = 90, cap: int = 3) -> DataFrame:
    """Per window the candidates of another number within the band, counted up to ``cap`` (a score, as in the cases' difficulty).

    A window asks three time buckets for their candidates: the last ones of the bucket before, all of its own, the first ones of the next.
    Running counts in a bucket, of all numbers less those of the window's own, answer that without a row a pair."""
    size = int(seconds * 1000)
    start, bucket = F.col("start_ms"), F.floor(F.col("start_ms") / size)
    # what is asked of a bucket: its candidates from t on, up to t, or all (up to the bucket's end); kind 1 is a candidate
    asked = [(bucket - 1, start - size, 0), (bucket, (bucket + 1) * size, 2), (bucket + 1, start + size, 2)]
    ask = F.explode(F.array(*(F.struct(b.cast("long").alias("b"), t.cast("long").alias("t"), F.lit(k).alias("kind")) for b, t, k in asked))).alias("q")
    own = windows.where("start_ms is not null and number is not null").select(DAY, "id", "number", ask).select(DAY, "id", "number", "q.*")
    said = candidates.where("number is not null").select(DAY, F.lit(None).cast(windows.schema["id"].dataType).alias("id"), "number", bucket.cast("long").alias("b"), start.cast("long").alias("t"), F.lit(1).alias("kind"))
    rows = own.unionByName(said)
    one = (F.col("kind") == 1).cast("long")

    def counted(*keys: str) -> Column:
        w = Window.partitionBy(DAY, "b", *keys)
        upto = F.sum(one).over(w.orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0))
        return F.when(F.col("kind") == 0, F.sum(one).over(w) - upto).otherwise(upto)

    found = rows.withColumn("_all", counted()).withColumn("_same", counted("number")).where("kind <> 1")
    hits = found.groupBy(DAY, "id").agg(F.sum(F.col("_all") - F.col("_same")).alias("n"))
    return windows.join(hits, [DAY, "id"], "left").withColumn("conflicts", F.least(F.coalesce("n", F.lit(0).cast("long")), F.lit(cap).cast("long"))).drop("n")


MODES = ("hardest", "random", "stratified", "range", "list")


def sample_cases(
    cases: DataFrame,
    mode: str,
    per_day: int | None = None,
    seed: int = 0,
    max_cases: int | None = None,
    between: tuple[int, int] | None = None,
    numbers: list[int] | None = None,
) -> DataFrame:
    """Cases (day_id, case_id, difficulty, number, start_ms) by one of MODES: hardest first, in hash order, some of each third of a day by
    difficulty, those with a number in ``between`` by number, or those with one of ``numbers`` in the order of the list.

    Each day gives at most ``per_day`` cases (``list`` ignores it); without it, and with cases of several days, a day's share of max_cases,
    rounded up. Stratified days take their quota evenly from the thirds, hardest third first, and fill what is missing from the rest in
    hash order. At most max_cases are returned, in the order of the mode. Hash orders are by MD5 of seed and case_id."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    if mode == "range":
        if between is None or between[1] <= between[0]:
            raise ValueError(f"a range needs two rising numbers: {between}")
        cases = cases.where(F.col("number").between(*between))
    if mode == "list":
        numbers, per_day = list(dict.fromkeys(numbers or [])), None
        if not numbers:
            raise ValueError("a list needs numbers")
        cases = cases.where(F.col("number").isin(numbers))
    if per_day is None and max_cases is not None:
        days = cases.agg(F.count_distinct(DAY)).first()[0]
        per_day = max(1, -(-max_cases // days)) if days > 1 else None
    dice = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col("case_id").cast("string")))
    hard, by_time = F.desc("difficulty"), [DAY, "start_ms", "case_id"]
    place = F.array_position(F.lit(numbers or [0]), F.col("number").cast("int"))
    whole = {"hardest": [hard, DAY, "number", "case_id"], "random": [dice, "case_id"], "stratified": [hard, *by_time], "range": [DAY, "number", "start_ms", "case_id"], "list": [place, *by_time]}[mode]
    if per_day is not None:
        inside = [F.col("_order")] if mode == "stratified" else by_time if mode == "list" else whole
        rows = _by_thirds(cases, per_day, dice) if mode == "stratified" else cases
        rank = F.row_number().over(Window.partitionBy(DAY).orderBy(*inside))
        cases = rows.withColumn("_r", rank).where(F.col("_r") <= per_day).drop("_r", "_order")
    return cases if max_cases is None else cases.orderBy(*whole).limit(max_cases)


def _by_thirds(cases: DataFrame, quota: int, dice: Column) -> DataFrame:
    """cases and _order: the order in which a day's quota is filled (a day of fewer than three cases has as many parts)."""
    day = Window.partitionBy(DAY)
    n, at = F.count(F.lit(1)).over(day), F.row_number().over(day.orderBy(F.desc("difficulty"), "number", "case_id"))
    rows = cases.withColumn("_n", n).withColumn("_k", F.least("_n", F.lit(3))).withColumn("_t", F.ceil(at * F.col("_k") / F.col("_n")))
    rows = rows.withColumn("_i", F.row_number().over(Window.partitionBy(DAY, "_t").orderBy(dice, "case_id")))
    first = F.col("_i") <= F.greatest(F.ceil(F.lit(quota) / F.col("_k")), F.lit(1))
    rest = F.when(first, F.struct(F.lit(0).alias("late"), F.col("_t").alias("t"), dice.alias("h"), F.col("case_id").alias("id")))
    order = rest.otherwise(F.struct(F.lit(1).alias("late"), F.lit(0).cast("long").alias("t"), dice.alias("h"), F.col("case_id").alias("id")))
    return rows.withColumn("_order", order).drop("_n", "_k", "_t", "_i")


def normalize_cut_pairs(results: DataFrame, rows: DataFrame) -> DataFrame:
    """Cut photos of a result row from its window's start and the cut's number (rows: day_id, i, photo_id)."""
    k = F.nullif(F.regexp_extract("decision", r"^cut_after_(\d+)$", 1), F.lit("")).try_cast("int")
    out = results.withColumn("_i", F.col("start_row") + k - 1)
    side = lambda n, d: rows.select(F.col(DAY).alias(f"_{n}d"), (F.col("i") - d).alias(f"_{n}i"), F.col("photo_id").alias(f"cut_{n}"))
    for n, d in (("left", 0), ("right", 1)):
        out = out.join(side(n, d), (F.col(DAY) == F.col(f"_{n}d")) & (F.col("_i") == F.col(f"_{n}i")), "left").drop(f"_{n}d", f"_{n}i")
    return out.drop("_i")


def hint_windows(results: DataFrame, photos: DataFrame) -> DataFrame:
    """Distinct probed pairs (array frame_ids) with their frames' rows."""
    once = results.dropDuplicates(["cut_left", "cut_right"]).select("cut_left", "cut_right", F.posexplode("frame_ids").alias("i", "photo_id"))
    return once.join(photos, "photo_id").groupBy("cut_left", "cut_right").agg(F.array_sort(F.collect_list(F.struct("i", "photo_id", "start_epoch_ms"))).alias("frames"))
