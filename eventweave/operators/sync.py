"""Clock offsets between streams, and clips against intervals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "day_id"


def pick_reference_stream(clips: DataFrame) -> DataFrame:
    """The stream of a day with the largest total duration (equal: the larger id)."""
    total = clips.groupBy(DAY, "stream_id").agg(F.sum((F.col("end_ms") - F.col("start_ms")) / 1000.0).alias("total_s"))
    return total.groupBy(DAY).agg(F.max_by("stream_id", F.struct("total_s", "stream_id")).alias("reference_stream_id"))


def _bucketed(df: DataFrame, start: str, end: str, bucket_ms: int) -> DataFrame:
    return df.withColumn("b", F.explode(F.sequence(F.floor(F.col(start) / bucket_ms), F.floor(F.col(end) / bucket_ms))))


#: Clips whose counts are looked up in one vectorised step.
STEP = 1 << 20


class Ends:
    """The ends of clips in order of their starts, as a wavelet matrix: for any number of first clips, how many of their ends are under a
    limit, and the k-th smallest of them, in as many steps as an end's number has bits."""

    def __init__(self, end: np.ndarray) -> None:
        self.values, code = np.unique(end, return_inverse=True)
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(len(self.values).bit_length())):
            one = (code >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate(([0], np.cumsum(~one))))
            code = np.concatenate((code[~one], code[one]))

    def _walk(self, first: np.ndarray, code: np.ndarray | None, k: np.ndarray | None) -> np.ndarray:
        """Down the bits of code, counting the ends under it; without a code, along those of the k-th smallest end, which is the result."""
        low, high, out = np.zeros(len(first), np.int64), first, np.zeros(len(first), np.int64)
        for level, zeros in enumerate(self.zeros):
            bit = len(self.zeros) - 1 - level
            a, b = zeros[low], zeros[high]
            if code is not None:
                up = (code >> bit & 1).astype(bool)
                out += np.where(up, b - a, 0)
            else:
                up = k >= b - a
                k = np.where(up, k - (b - a), k)
                out |= up.astype(np.int64) << bit
            low, high = np.where(up, zeros[-1] + low - a, a), np.where(up, zeros[-1] + high - b, b)
        return out

    def under(self, first: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Of the first so many clips, the number of ends under the limit."""
        code = np.searchsorted(self.values, limit)
        return np.concatenate([np.zeros(0, np.int64), *(self._walk(first[k : k + STEP], code[k : k + STEP], None) for k in range(0, len(first), STEP))])

    def kth(self, first: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Of the first so many clips, the k-th smallest end (0: the smallest)."""
        return self.values[np.concatenate([np.zeros(0, np.int64), *(self._walk(first[j : j + STEP], None, k[j : j + STEP]) for j in range(0, len(first), STEP))])]


class Crossing:
    """Pairs of a reference clip and another one that began by then and ends first. What is asked of the other clip's end is an interval,
    so the pairs of a reference clip are counted without looking at them. Pairs that cross the other way are these with time turned round."""

    def __init__(self, start: np.ndarray, end: np.ndarray, other_start: np.ndarray, other_end: np.ndarray, least: int) -> None:
        order = np.argsort(other_start, kind="stable")
        self.start, self.end, self.least = start, end, start + least
        self.ends = Ends(other_end[order])
        self.first = np.searchsorted(other_start[order], start, "right")
        self.all_under = self.ends.under(self.first, end)
        self.short = np.minimum(self.ends.under(self.first, self.least), self.all_under)

    def upto(self, limit: int) -> int:
        """Pairs whose start and end add up to the limit at most."""
        return int((np.clip(self.ends.under(self.first, limit - self.start + 1), self.short, self.all_under) - self.short).sum())

    def bounds(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        lower = np.maximum(self.least, low - self.start)
        return lower, np.maximum(np.minimum(self.end, high - self.start + 1), lower)

    def counts(self, low: int, high: int) -> np.ndarray:
        """For each reference clip its pairs whose start and end add up to low to high."""
        lower, upper = self.bounds(low, high)
        return self.ends.under(self.first, upper) - self.ends.under(self.first, lower)

    def longest(self, low: int, high: int) -> np.ndarray:
        """For each reference clip the longest overlap among these pairs (-1: none)."""
        lower, upper = self.bounds(low, high)
        n, out = self.ends.under(self.first, upper), np.full(len(self.start), -1)
        some = np.flatnonzero(n)
        if len(some):
            last = self.ends.kth(self.first[some], n[some] - 1)
            out[some] = np.where(last >= lower[some], last - self.start[some], -1)
        return out


#: Beyond all sums of two times.
FAR = 1 << 60


class Pairs:
    """The pairs of reference and other clips that overlap by least_ms, in order of midpoint, reference and other id, without a list of them.

    A pair's overlap begins with one of its clips and ends with one, which makes four kinds: either clip inside the other (midpoint and
    length are those of the inner clip), and two ways to cross. Twice the midpoint is the sum of the overlap's start and end."""

    def __init__(self, ref: dict[str, np.ndarray], other: dict[str, np.ndarray], least_ms: int) -> None:
        # an overlap is no longer than either clip
        ref, other = ({k: v[x["end"] - x["start"] >= least_ms] for k, v in x.items()} for x in (ref, other))
        self.ref, self.other, self.least = ref, other, least_ms
        self.cross = Crossing(ref["start"], ref["end"], other["start"], other["end"], least_ms)
        self.turned = Crossing(-ref["end"], -ref["start"], -other["end"], -other["start"], least_ms)
        #: Others around each reference clip, and references that reach beyond each other clip on both sides.
        self.around = self.cross.first - self.cross.all_under
        self.outside = self._beyond(np.arange(len(ref["start"])), np.arange(len(other["start"])))
        self.inner = {k: (x["start"] + x["end"], n) for k, x, n in (("ref", ref, self.around), ("other", other, self.outside))}
        self.sorted = []
        for sums, n in self.inner.values():
            order = np.argsort(sums, kind="stable")
            self.sorted.append((sums[order], np.concatenate(([0], np.cumsum(n[order])))))
        self.known: dict[int, int] = {}

    def _beyond(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each of the other clips j, how many of the reference clips i reach beyond it on both sides."""
        a, b = {k: v[i] for k, v in self.ref.items()}, {k: v[j] for k, v in self.other.items()}
        order = np.argsort(a["start"], kind="stable")
        first = np.searchsorted(a["start"][order], b["start"], "left")
        return first - Ends(a["end"][order]).under(first, b["end"] + 1)

    def _within(self, j: np.ndarray) -> np.ndarray:
        """For each reference clip, how many of the other clips j lie inside it."""
        b = {k: v[j] for k, v in self.other.items()}
        order = np.argsort(b["start"], kind="stable")
        ends, n = Ends(b["end"][order]), len(self.ref["start"])
        return ends.under(np.full(n, len(j)), self.ref["end"]) - ends.under(np.searchsorted(b["start"][order], self.ref["start"], "right"), self.ref["end"])

    def upto(self, mid: int) -> int:
        """Pairs with a midpoint of mid at most."""
        if mid not in self.known:
            limit = 2 * mid + 1
            inner = sum(int(n[np.searchsorted(sums, limit, "right")]) for sums, n in self.sorted)
            turned = int((self.turned.all_under - self.turned.short).sum()) - self.turned.upto(-limit - 1)
            self.known[mid] = inner + self.cross.upto(limit) + turned
        return self.known[mid]

    def midpoint(self, rank: int, low: int, high: int) -> int:
        """The midpoint of the pair with this rank; it lies above low and not above high. Steps go by the counts and by halves in turn."""
        for mid, n in self.known.items():
            low, high = (max(low, mid), high) if n <= rank else (low, min(high, mid))
        halve = False
        while high - low > 1:
            a, b = self.known.get(low, 0), self.upto(high)
            mid = (low + high) // 2 if halve else low + int((high - low) * (rank + 0.5 - a) / max(b - a, 1))
            mid, halve = min(max(mid, low + 1), high - 1), not halve
            low, high = (mid, high) if self.upto(mid) <= rank else (low, mid)
        return high

    def row(self, i: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The other clips that pair with reference clip i, with sums of low to high, and the overlaps."""
        start, end = np.maximum(self.ref["start"][i], self.other["start"]), np.minimum(self.ref["end"][i], self.other["end"])
        j = np.flatnonzero((end - start >= self.least) & (start + end >= low) & (start + end <= high))
        return j, (end - start)[j]

    def at(self, rank: int, low: int, high: int) -> tuple[int, int, int]:
        """Midpoint and ids' ranks of the pair with this rank."""
        mid = self.midpoint(rank, low, high)
        sums = (2 * mid, 2 * mid + 1)
        own = (self.inner["ref"][0] >= sums[0]) & (self.inner["ref"][0] <= sums[1])
        inside = np.flatnonzero((self.inner["other"][0] >= sums[0]) & (self.inner["other"][0] <= sums[1]))
        n = np.where(own, self.around, 0) + self._within(inside) + self.cross.counts(*sums) + self.turned.counts(-sums[1], -sums[0])
        order = np.argsort(self.ref["rank"])
        total, left = np.cumsum(n[order]), rank - self.upto(mid - 1)
        k = int(np.searchsorted(total, left, "right"))
        i = int(order[k])
        ids = np.sort(self.other["rank"][self.row(i, *sums)[0]])
        return mid, int(self.ref["rank"][i]), int(ids[left - (int(total[k - 1]) if k else 0)])

    def best(self, low: int, high: int, allowed: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The longest pair of the allowed reference clips with sums of low to high, ties by ids (as ``listed`` gives it; none: empty)."""
        own, n = self.inner["ref"]
        length = np.where((own >= low) & (own <= high) & (n > 0), self.ref["end"] - self.ref["start"], -1)
        length = np.maximum(length, np.maximum(self.cross.longest(low, high), self.turned.longest(-high, -low)))
        length[~allowed] = -1
        sums, n = self.inner["other"]
        inside = np.flatnonzero((sums >= low) & (sums <= high) & (n > 0))
        if len(inside) and not allowed.all():
            inside = inside[self._beyond(np.flatnonzero(allowed), inside) > 0]
        inner = (self.other["end"] - self.other["start"])[inside]
        most = max(int(length.max(initial=-1)), int(inner.max(initial=-1)))
        if most < 0:
            return []
        holds = length == most
        if (inner == most).any():
            holds |= allowed & (self._within(inside[inner == most]) > 0)
        i = np.flatnonzero(holds)
        i = int(i[self.ref["rank"][i].argmin()])
        return self.listed(i, *self.row(i, low, high))

    def listed(self, i: int, j: np.ndarray, length: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Of the pairs of one reference clip the longest: -overlap, ranks of both ids, midpoint (a list of one, or none)."""
        if not len(j):
            return []
        k = np.lexsort((self.other["rank"][j], -length))[0]
        lo = max(int(self.ref["start"][i]), int(self.other["start"][j[k]]))
        return [(-int(length[k]), int(self.ref["rank"][i]), int(self.other["rank"][j[k]]), lo + int(length[k]) // 2)]

    def share(self, begin: tuple[int, int, int] | None, stop: tuple[int, int, int] | None) -> tuple[int, int, int, int]:
        """The longest pair from the one at ``begin`` to that before ``stop``, in order of midpoint and ids."""
        rank, found = self.ref["rank"], []
        after = -FAR if begin is None else 2 * begin[0] + 2
        until = FAR if stop is None else 2 * stop[0] - 1
        if after <= until:
            found += self.best(after, until, np.ones(len(rank), bool))
        for mid in sorted({x[0] for x in (begin, stop) if x is not None}):
            a = begin[1:] if begin is not None and begin[0] == mid else None
            b = stop[1:] if stop is not None and stop[0] == mid else None
            allowed = np.ones(len(rank), bool) if a is None else rank > a[0]
            if b is not None:
                allowed &= rank < b[0]
            found += self.best(2 * mid, 2 * mid + 1, allowed)
            for edge in {x[0] for x in (a, b) if x is not None}:
                i = int(np.flatnonzero(rank == edge)[0])
                j, length = self.row(i, 2 * mid, 2 * mid + 1)
                key = self.other["rank"][j]
                ok = np.ones(len(j), bool)
                if a is not None:
                    ok &= (edge > a[0]) | (key >= a[1])
                if b is not None:
                    ok &= (edge < b[0]) | (key < b[1])
                found += self.listed(i, j[ok], length[ok])
        return min(found)


def _chosen(ref: dict[str, np.ndarray], other: dict[str, np.ndarray], least_ms: int, shares: int) -> list[tuple[int, int, int, int]]:
    """The longest pair of each of ``shares`` equal shares of the pairs in order of their midpoints (or all pairs, if there are no more):
    ranks of both ids, midpoint, overlap. Pairs are counted, not listed, so the work grows with the clips and not with the pairs."""
    pairs = Pairs(ref, other, least_ms)
    low, high = int(min(ref["start"].min(), other["start"].min())) - 1, int(max(ref["end"].max(), other["end"].max())) + 1
    n = pairs.upto(high)
    if not n:
        return []
    # the first rank of each share but the first; fewer pairs than shares are a share each
    firsts = range(1, n) if n <= shares else [-(-k * n // shares) for k in range(1, shares)]
    limits = [None, *(pairs.at(rank, low, high) for rank in firsts), None]
    return [(a, b, mid, -length) for length, a, b, mid in (pairs.share(*x) for x in zip(limits, limits[1:], strict=False))]


def overlap_pairs(clips: DataFrame, reference: DataFrame, min_overlap_s: float = 1, max_pairs: int = 6) -> DataFrame:
    """Overlapping clips of the reference and each other stream of a day. With more than max_pairs, the pairs in time order are dealt to
    max_pairs equal shares and the longest overlap of each stays.

    A task holds the clips of two streams of one day, counts their pairs by bisection and finds the longest ones without a list of them;
    no row is made for a pair that is not chosen."""
    least_ms = int(np.ceil(min_overlap_s * 1000))
    side = clips.join(reference, DAY).select(DAY, "stream_id", "clip_id", "start_ms", "end_ms", "reference_stream_id")
    others = side.where("stream_id <> reference_stream_id").drop("reference_stream_id")
    streams = others.select(DAY, "stream_id").distinct()
    ref = side.where("stream_id = reference_stream_id").select(DAY, F.col("clip_id").alias("ref_clip"), F.col("start_ms").alias("rs"), F.col("end_ms").alias("re"))
    given = ref.join(streams, DAY).select(F.col(DAY).alias("_day"), F.col("stream_id").alias("_stream"), "ref_clip", "rs", "re")

    def arrays(pdf: pd.DataFrame, clip: str, start: str, end: str) -> tuple[dict[str, np.ndarray], np.ndarray]:
        pdf = pdf.dropna(subset=[start, end]).sort_values([clip, start])
        return {"start": pdf[start].to_numpy(np.int64), "end": pdf[end].to_numpy(np.int64), "rank": np.arange(len(pdf))}, pdf[clip].to_numpy()

    def pick(key: tuple, own: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        a, a_ids = arrays(there, "ref_clip", "rs", "re")
        b, b_ids = arrays(own, "clip_id", "start_ms", "end_ms")
        rows = _chosen(a, b, least_ms, max_pairs) if len(a_ids) and len(b_ids) else []
        out = [(*key, a_ids[i], b_ids[j], length / 1000.0, mid) for i, j, mid, length in rows]
        return pd.DataFrame(out, columns=[DAY, "stream_id", "ref_clip", "clip_id", "overlap_s", "midpoint_ms"])

    kind = {f.name: f.dataType.simpleString() for f in clips.schema.fields}
    schema = f"{DAY} {kind[DAY]}, stream_id {kind['stream_id']}, ref_clip {kind['clip_id']}, clip_id {kind['clip_id']}, overlap_s double, midpoint_ms long"
    return others.groupBy(DAY, "stream_id").cogroup(given.groupBy("_day", "_stream")).applyInPandas(pick, schema)


def clips_for_sets(sets: DataFrame, clips: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """Clips whose closed interval touches the set's closed interval."""
    a = _bucketed(sets.select(DAY, "set_id", F.col("set_start_ms").alias("s"), F.col("set_end_ms").alias("e")).where("e >= s"), "s", "e", bucket_ms)
    b = _bucketed(clips.select(DAY, "clip_id", "start_ms", "end_ms"), "start_ms", "end_ms", bucket_ms)
    hit = a.join(b, [DAY, "b"]).where("s <= end_ms and start_ms <= e").where(F.col("b") == F.floor(F.greatest("s", "start_ms") / bucket_ms))
    return hit.select(DAY, "set_id", "clip_id", "s", "e", "start_ms", "end_ms")


def export_markers(sets: DataFrame, clips: DataFrame, trim_s: float = 0, pad_s: float = 2) -> DataFrame:
    """For each clip of a set the part to export: seek inside the clip and duration, in seconds."""
    hit = clips_for_sets(sets, clips)
    lo = F.greatest(F.col("s") - int((pad_s - trim_s) * 1000), F.col("start_ms"))
    hi = F.least(F.col("e") + int((pad_s - trim_s) * 1000), F.col("end_ms"))
    return hit.select(DAY, "set_id", "clip_id", lo.alias("export_start_ms"), hi.alias("export_end_ms"), ((lo - F.col("start_ms")) / 1000.0).alias("seek_s"), ((hi - lo) / 1000.0).alias("duration_s"))


def lag_correlation(pairs: DataFrame, margin: int) -> DataFrame:
    """lag (samples), score and status for each row with envelope_a, envelope_b (array<float>): best correlation of the z-normalised
    envelopes with the lag inside +- margin, by FFT. Rows are independent; Arrow batches of pairs."""

    def run(batches):
        for pdf in batches:
            lags, scores, status = [], [], []
            for a, b in zip(pdf["envelope_a"], pdf["envelope_b"], strict=True):
                a, b = np.asarray([] if a is None else a, float), np.asarray([] if b is None else b, float)
                if min(len(a), len(b)) < 2 or a.std() == 0 or b.std() == 0:
                    lags.append(None)
                    scores.append(None)
                    status.append("too_short" if min(len(a), len(b)) < 2 else "flat")
                    continue
                a, b = (a - a.mean()) / a.std(), (b - b.mean()) / b.std()
                size = 1 << (len(a) + len(b) - 1).bit_length()
                full = np.fft.irfft(np.fft.rfft(a, size) * np.conj(np.fft.rfft(b, size)), size)
                m = min(margin, len(a) - 1, len(b) - 1)
                at = np.arange(-m, m + 1)
                value = full[at % size] / min(len(a), len(b))
                k = int(np.argmax(np.round(value, 9)))
                lags.append(int(at[k]))
                scores.append(float(value[k]))
                status.append("ok")
            out = pdf.drop(columns=["envelope_a", "envelope_b"])
            yield out.assign(lag=pd.array(lags, "Int64"), score=scores, status=status)

    kept = [f for f in pairs.schema.fields if f.name not in ("envelope_a", "envelope_b")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lag long, score double, status string"
    return pairs.mapInPandas(run, schema)


def robust_offset(estimates: DataFrame, min_score: float, max_deviation_s: float) -> DataFrame:
    """Per day and stream the median correction of the usable pairs: status ok and score at least min_score, then without those farther
    than max_deviation_s from the provisional median (unless that is all). Also the median absolute deviation, extremes and counts."""
    keys = [DAY, "stream_id"]
    good = estimates.where((F.col("status") == "ok") & (F.col("score") >= min_score))
    first = good.groupBy(keys).agg(F.median("correction_s").alias("m0"))
    far = F.abs(F.col("correction_s") - F.col("m0")) > max_deviation_s
    near = good.join(first, keys).withColumn("near", ~far)
    some = near.groupBy(keys).agg(F.max("near").alias("any_near"))
    kept = near.join(some, keys).where("near or not any_near")
    mid = kept.groupBy(keys).agg(F.median("correction_s").alias("correction_seconds"), F.min("correction_s").alias("min_correction"), F.max("correction_s").alias("max_correction"), F.median("score").alias("median_score"), F.count(F.lit(1)).alias("successful_pairs"))
    mad = kept.join(mid, keys).groupBy(keys).agg(F.median(F.abs(F.col("correction_s") - F.col("correction_seconds"))).alias("median_abs_deviation"))
    every = estimates.groupBy(keys).agg(F.count(F.lit(1)).alias("pair_count"))
    out = every.join(mid, keys, "left").join(mad, keys, "left")
    notes = F.when(F.col("correction_seconds").isNull(), "no usable pair").when(F.col("successful_pairs") < F.col("pair_count"), "pairs rejected").otherwise("")
    return out.withColumn("notes", notes).withColumn("correction_seconds", F.coalesce("correction_seconds", F.lit(0.0))).withColumn("successful_pairs", F.coalesce("successful_pairs", F.lit(0).cast("long")))


def sync_windows(pairs: DataFrame, margin_s: float = 20, min_overlap_s: float = 60, max_window_s: float = 180) -> DataFrame:
    """Where the envelopes of a pair are to be compared: ref_window_s and window_start_s (seconds into the reference and the other clip),
    window_s (their common length), and message where that is too short.

    pairs: ref_start_ms, ref_duration_s, start_ms, duration_s and overlap_s. A window begins a margin before the overlap, or at the start
    of the clip, and is as long as the overlap and two margins, the rest of either clip and the longest window allow."""
    from_start = lambda start: F.greatest(F.lit(0.0), (F.greatest("ref_start_ms", "start_ms") - F.col(start)) / 1000.0 - margin_s)
    out = pairs.withColumns({"ref_window_s": from_start("ref_start_ms"), "window_start_s": from_start("start_ms")})
    rest = lambda duration, start: F.greatest(F.lit(0.0), F.col(duration) - F.col(start))
    length = F.least(F.col("overlap_s") + 2 * margin_s, rest("ref_duration_s", "ref_window_s"), rest("duration_s", "window_start_s"), F.lit(float(max_window_s)))
    out = out.withColumn("window_s", length)
    return out.withColumn("message", F.when(F.col("window_s") < min_overlap_s, "window too short"))


def pair_offsets(windows: DataFrame, envelopes: DataFrame, rate: float, margin_s: float = 20, min_overlap_s: float = 60) -> DataFrame:
    """correction_s, score, status and message of each pair of sync_windows(): the lag of the best correlation inside the margin, less the
    distance that the clocks say lies between the two windows.

    envelopes: day_id, stream_id, clip_id, envelope (array<float>, ``rate`` values a second). Only the window of an envelope goes on."""
    cut = lambda start: F.slice("envelope", (F.floor(F.col(start) * rate + 1e-6) + 1).cast("int"), F.floor(F.col("window_s") * rate + 1e-6).cast("int"))
    heard = windows.where("message is null")
    clip = lambda stream, name: envelopes.select(DAY, F.col("stream_id").alias(stream), F.col("clip_id").alias(name), "envelope")
    ref = heard.join(clip("reference_stream_id", "ref_clip"), [DAY, "reference_stream_id", "ref_clip"], "left").withColumn("envelope_a", cut("ref_window_s")).drop("envelope")
    both = ref.join(clip("stream_id", "clip_id"), [DAY, "stream_id", "clip_id"], "left").withColumn("envelope_b", cut("window_start_s")).drop("envelope")
    n = F.least(F.size("envelope_a"), F.size("envelope_b"))
    flat = lambda c: F.coalesce(F.size(c) < 1, F.lit(True)) | F.coalesce(F.array_max(c) - F.array_min(c) <= 1e-6, F.lit(True))
    said = F.when(flat("envelope_a") | flat("envelope_b"), "missing or flat audio").when(n < F.lit(int(rate * min_overlap_s)), "not enough audio samples")
    # both are as long as the shorter one
    short = lambda c: F.when(F.col("message").isNull(), F.slice(c, F.lit(1), n))
    ready = both.withColumn("message", said).withColumns({"envelope_a": short("envelope_a"), "envelope_b": short("envelope_b")})
    found = lag_correlation(ready, int(round(margin_s * rate)))
    apart = ((F.col("start_ms") - F.col("ref_start_ms")) / 1000.0 + F.col("window_start_s")) - F.col("ref_window_s")
    done = found.withColumn("correction_s", F.col("lag") / rate - apart)
    early = windows.where("message is not null").withColumns({"lag": F.lit(None).cast("long"), "score": F.lit(None).cast("double"), "status": F.lit("error"), "correction_s": F.lit(None).cast("double")})
    ok = (F.col("status") == "ok") & F.col("message").isNull()
    return done.withColumn("status", F.when(ok, "ok").otherwise("error")).unionByName(early)


def sync_map(
    clips: DataFrame, envelopes: DataFrame, rate: float, reference: DataFrame | None = None, margin_s: float = 20, min_overlap_s: float = 60, max_window_s: float = 180, max_pairs: int = 6, min_score: float = 0.25, max_deviation_s: float = 5
) -> DataFrame:
    """From clips (day_id, stream_id, clip_id, start_ms, end_ms) and their loudness to the clock correction of each stream of a day: pairs
    that overlap, windows, lags, and the robust middle of these. The reference stream has correction 0."""
    reference = pick_reference_stream(clips) if reference is None else reference
    pairs = overlap_pairs(clips, reference, min_overlap_s, max_pairs).join(reference, DAY)
    times = clips.select(DAY, "stream_id", "clip_id", "start_ms", ((F.col("end_ms") - F.col("start_ms")) / 1000.0).alias("duration_s"))
    ref_times = times.toDF(DAY, "reference_stream_id", "ref_clip", "ref_start_ms", "ref_duration_s")
    timed = pairs.join(times, [DAY, "stream_id", "clip_id"]).join(ref_times, [DAY, "reference_stream_id", "ref_clip"])
    offsets = robust_offset(pair_offsets(sync_windows(timed, margin_s, min_overlap_s, max_window_s), envelopes, rate, margin_s, min_overlap_s), min_score, max_deviation_s)
    streams = clips.select(DAY, "stream_id").distinct().join(reference, DAY)
    out = streams.join(offsets, [DAY, "stream_id"], "left")
    is_ref = F.col("stream_id") == F.col("reference_stream_id")
    none = F.coalesce("pair_count", F.lit(0).cast("long"))
    notes = F.when(is_ref, "reference stream").when(none == 0, "no overlapping clips").otherwise(F.col("notes"))
    return out.withColumns({"correction_seconds": F.coalesce("correction_seconds", F.lit(0.0)), "pair_count": none, "successful_pairs": F.coalesce("successful_pairs", F.lit(0).cast("long")), "notes": notes})
