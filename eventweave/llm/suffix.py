"""Repeated byte strings by suffix order and longest previous factors.

A position is *repeated* if the ``length`` bytes from it also start anywhere else. Its longest previous factor reaches ``length``
if one of those other places comes before it. No machine holds one suffix array of the corpus; suffixes are dealt by content:

1. In every string of ``length`` bytes the k-mer with the smallest hash is its anchor, so equal strings have equal anchors.
   Anchors that occur once in the corpus are dropped.
2. For each other anchor its surroundings (the bytes of all strings that could have it as anchor) are sent to the anchor's group;
   equal surroundings are sent once by each task, with their number, so groups of copies stay small. An anchor with more than ``HOT``
   distinct surroundings is split: strings whose anchor stands in one of ``PARTS`` ranges of places share the bytes that all of them
   have beside it, and are dealt by these bytes too.
3. A group sorts its surroundings by the bytes after the anchor and by those before it, read backwards, with the length of the common
   prefix of neighbours. That gives the order of the suffixes that begin any number of bytes before the anchor: by the bytes before
   it, then by the order after it. In this order the previous and the next smaller place, inside a run of suffixes that have ``length``
   bytes in common, are the nearest earlier matches; where there is one, the longest previous factor reaches ``length``. The same with
   the places reversed gives the matches that come after, which the first copy has. Bytes are compared, not hashes.
4. The spans go back to the documents, are united, and are cut out of the texts.

``keep_first`` True removes only what has an earlier match (in order of doc_id, then place), so one copy stays; False removes all
copies, the first too. Texts are UTF-8 bytes; matches lie within a text, and places within one text count too.

Defined results: null and empty texts, and texts under ``length`` bytes, lose nothing (null has 0 bytes); repeated rows are copies
of each other; null ids come last in the order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.shared import BROADCAST_IDS, packed, stored, table, unpacked

LENGTH = 200
#: Long enough to seldom recur by chance: a short one keeps most anchors of a corpus with few distinct syllables.
KMER = 64
_PLACE = np.uint64((1 << 24) - 1)
#: Bytes of distinct surroundings that a task holds back to find equal ones before it sends them.
HOLD_BYTES = 8 << 20
#: Distinct surroundings of an anchor up to which they are one group, and the ranges of places in which the strings of others are dealt.
HOT = 2000
PARTS = 4
#: Suffixes that a group task ranks at a time (whole groups, except for a group larger than this).
RANK_AT_ONCE = 100_000
NAMES = ["g", "c", "rid", "at", "left", "ctx", "n", "doc"]
_C2 = np.uint64(0xD6E8FEB86659FD93)


def anchors(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all anchors in a slice of texts, and their keys."""
    span = length - KMER + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = K.prefix_hash(data)
    key = K.mix((h[KMER:] - h[:-KMER]) * K._powers("down", len(h) - KMER))
    ranked = (key & ~_PLACE) | (np.arange(len(key), dtype=np.uint64) & _PLACE)
    n = len(ranked)
    rows = -(-n // span)
    full = np.full(rows * span, np.uint64(2**64 - 1))
    full[:n] = ranked
    block = full.reshape(rows, span)
    left = np.minimum.accumulate(block, axis=1).reshape(-1)
    right = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(right[: n - span + 1], left[span - 1 : n])
    start = np.arange(len(least))
    end = offs[np.searchsorted(offs, start, "right")] if len(start) else start
    at = (least[start + length <= end] & _PLACE).astype(np.int64)
    at = np.unique(at) if len(at) else at
    return at, key[at]


def doc_anchors(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """anchors() for slices of any size: one very long text is done in overlapping pieces."""
    piece = 1 << 23
    if len(data) <= 2 * piece:
        return anchors(data, offs, length)
    found = []
    for lo in range(0, len(data), piece):
        hi = min(len(data), lo + piece + length - 1)
        inner = np.concatenate(([0], offs[(offs > lo) & (offs < hi)] - lo, [hi - lo]))
        at, key = anchors(data[lo:hi], inner, length)
        found.append((at + lo, key))
    at = np.concatenate([a for a, _ in found])
    at, first = np.unique(at, return_index=True)
    return at, np.concatenate([k for _, k in found])[first]


def _with_row(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """With did and rid, which name a row by its id (null as the largest) and a hash of its text: rows that share both are taken as equal."""
    return docs.select("doc_id", "text", *keep, F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("rid"))


def repeated_anchors(rows: DataFrame, length: int) -> DataFrame:
    """did, rid, keys: for each text the anchors that occur again in the corpus."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, rid = b.column("did").to_numpy(), b.column("rid").to_numpy()
            for lo, _, data, offs in K.text_chunks(b.column("text")):
                at, key = doc_anchors(data, offs, length)
                doc = np.searchsorted(offs, at, "right") - 1
                order = np.lexsort((key, doc))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                more = np.diff(np.concatenate((first, [len(key)]))) > 1
                row = lo + doc[first]
                yield pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(did[row]), pa.array(rid[row]), pa.array(more)], names=["key", "did", "rid", "more"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, int, bool] | None = None  # the last row, and whether it is known to be repeated
        names = ["key", "did", "rid"]

        def last() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in held[:3]], names=names)

        for b in batches:
            key, did, rid, more = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "did", "rid", "more"))
            if not len(key):
                continue
            same = key[1:] == key[:-1]
            hit = more.copy()
            hit[1:] |= same
            hit[:-1] |= same
            if held is not None:
                if held[0] == key[0]:
                    hit[0] = True
                    held = (*held[:3], True)
                if held[3]:
                    yield last()
            held = (int(key[-1]), int(did[-1]), int(rid[-1]), bool(hit[-1]))
            hit[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (key, did, rid)], names=names)
        if held is not None and held[3]:
            yield last()

    dealt = rows.select("did", "rid", "text").mapInArrow(K.tidy(find), "key long, did long, rid long, more boolean").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(again, "key long, did long, rid long").groupBy("did", "rid").agg(F.collect_list("key").alias("keys"))


def surroundings(texts: DataFrame, length: int) -> DataFrame:
    """One table of two kinds of rows from (doc_id, rid, z, keys): where a surrounding is (rid, at), and the distinct ones (bytes)."""
    reach = length - KMER

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        room = 0

        def flush() -> pa.RecordBatch:
            g, c, left, ctx, n, doc, at = [], [], [], [], [], [], []
            for (key, code), (x, y, m, d, p) in held.items():
                g.append(key)
                c.append(code)
                left.append(x)
                ctx.append(y)
                n.append(m)
                doc.append(d)
                at.append(p)
            held.clear()
            k = len(g)
            return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.nulls(k, pa.int64()), pa.array(at, pa.int64()), pa.array(left, pa.int32()), pa.array(ctx, pa.binary()), pa.array(n, pa.int32()), pa.array(doc, pa.int64())], names=NAMES)

        for b in batches:
            rid, ids, wanted, packs = b.column("rid").to_numpy(), b.column("doc_id").to_pylist(), b.column("keys"), b.column("z")
            places: list[tuple[np.ndarray, ...]] = []
            for i in range(b.num_rows):
                raw = zlib.decompress(packs[i].as_py())
                data = np.frombuffer(raw, np.uint8)
                at, key = doc_anchors(data, np.array([0, len(data)]), length)
                ok = np.isin(key.view(np.int64), wanted[i].values.to_numpy())
                at, key = at[ok], key[ok].view(np.int64)
                if not len(at):
                    continue
                h = K.prefix_hash(data)
                lo, hi = np.maximum(at - reach, 0), np.minimum(at + KMER + reach, len(data))
                code = (K.span_hash(h, lo, hi) + (at - lo).astype(np.uint64) * _C2).view(np.int64)
                doc = ids[i] if ids[i] is not None else np.iinfo(np.int64).max
                for a, g, c, x, y in zip(at.tolist(), key.tolist(), code.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    old = held.get((g, c))
                    if old is None:
                        held[g, c] = [a - x, raw[x:y], 1, doc, a]
                        room += y - x
                    else:
                        old[2] += 1
                        if (doc, a) < (old[3], old[4]):
                            old[3], old[4] = doc, a
                k = len(at)
                places.append((key, code, np.full(k, rid[i]), at, np.full(k, doc)))
                if room > HOLD_BYTES:
                    yield flush()
                    room = 0
            if places:
                key, code, row, at, doc = (np.concatenate(x) for x in zip(*places, strict=True))
                k = len(key)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(code), pa.array(row), pa.array(at), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.array(doc)], names=NAMES)
        if held:
            yield flush()

    return texts.mapInArrow(K.tidy(cut), "g long, c long, rid long, at long, left int, ctx binary, n int, doc long")


def runs_of(flag: np.ndarray, row: np.ndarray, delta: np.ndarray, n_rows: int) -> list[list[int]]:
    """For each row the runs [first, last, first, last, ...] of the deltas whose flag is set (input ordered by row, then delta)."""
    k = np.flatnonzero(flag)
    out: list[list[int]] = [[] for _ in range(n_rows)]
    if len(k):
        new = np.ones(len(k), bool)
        new[1:] = (row[k[1:]] != row[k[:-1]]) | (delta[k[1:]] != delta[k[:-1]] + 1)
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:] - 1, [len(k) - 1]))
        for r, x, y in zip(row[k[first]].tolist(), delta[k[first]].tolist(), delta[k[last]].tolist(), strict=True):
            out[r] += (x, y)
    return out


def common_prefixes(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of bytes: the place of each in the order by group and bytes; and starts[p, d], where in this order the run of rows begins
    that has d bytes in common with the one at p."""
    m, width = rows.shape
    text = [x.tobytes() for x in rows]
    order = np.array(sorted(range(m), key=lambda i: (group[i], text[i])), np.int64)
    at = np.empty(m, np.int64)
    at[order] = np.arange(m)
    sorted_rows, sorted_groups = rows[order], group[order]
    differs = sorted_rows[1:] != sorted_rows[:-1]
    common = np.full(m, -1, np.int64)
    common[1:] = np.where(sorted_groups[1:] != sorted_groups[:-1], -1, np.where(differs.any(1), differs.argmax(1), width))
    starts = np.where(common[:, None] < np.arange(width + 1), np.arange(m)[:, None], 0).astype(np.int32)
    return at, np.maximum.accumulate(starts, axis=0)


def previous_smaller(value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each value the nearest one before it in its run (they begin where begins is set) that is smaller, -1 without one."""
    out = np.arange(-1, len(value) - 1)
    out[begins] = -1
    open_ = np.arange(len(value))
    while len(open_):
        open_ = open_[(out[open_] >= 0) & (value[np.maximum(out[open_], 0)] >= value[open_])]
        out[open_] = out[out[open_]]  # what lies between is not smaller
    return out


def earlier_matches(place: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which suffixes have a match at a smaller place: a previous or next smaller place in suffix order, in a run of equal prefixes."""
    ends = np.concatenate((begins[1:], [True]))
    return (previous_smaller(place, begins) >= 0) | (previous_smaller(place[::-1], ends[::-1])[::-1] >= 0)


def dealt(cut: DataFrame, length: int) -> DataFrame:
    """The distinct surroundings with the group they are dealt to (deal) and the places before the anchor that are judged there (low, high)."""
    reach = length - KMER
    width = reach // PARTS
    distinct = cut.where("ctx is not null").select("g", "c", "left", "ctx", "n", "doc", "at")
    hot = distinct.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > HOT).select("g", F.lit(True).alias("hot"))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(-1)))
    rows = distinct.join(hot, "g", "left").withColumn("part", F.explode(parts))
    low, high = F.col("part") * width, F.when(F.col("part") == PARTS - 1, F.lit(reach)).otherwise((F.col("part") + 1) * width - 1)
    rows = rows.select("*", F.when(F.col("part") < 0, 0).otherwise(low).alias("low"), F.when(F.col("part") < 0, reach).otherwise(high).alias("high"))
    whole = F.expr(f"part < 0 or left >= low and octet_length(ctx) - left - {KMER} >= {reach} - high")  # else it has no such string
    beside = F.expr(f"xxhash64(g, part, substring(ctx, left - low + 1, low), substring(ctx, left + {KMER} + 1, {reach} - high))")
    return rows.where(whole).select(F.when(F.col("part") < 0, F.col("g")).otherwise(beside).alias("deal"), "g", "c", "left", "ctx", "n", "doc", "at", "low", "high")


def ranked_groups(cut: DataFrame, length: int) -> DataFrame:
    """g, c, doc0, at0 (first place of the surrounding), spans and later: offsets before the anchor of repeated strings, and of those
    that have an earlier match than the first place. A surrounding of a hot anchor has a row for each part."""
    reach = length - KMER
    result = ["g", "c", "doc0", "at0", "spans", "later"]

    def rank(t: pa.Table) -> pa.RecordBatch:
        deal, g, c, n, doc, at, least, most = (t.column(k).to_numpy() for k in ("deal", "g", "c", "n", "doc", "at", "low", "high"))
        new = np.ones(len(g), bool)
        new[1:] = (deal[1:] != deal[:-1]) | (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)  # rows of one surrounding are sorted by doc and place
        total = np.add.reduceat(n, first)
        deal, g, c, doc, at, least, most = (x[first] for x in (deal, g, c, doc, at, least, most))
        left = t.column("left").to_numpy()[first].astype(np.int64)
        ctx = t.column("ctx").combine_chunks().take(pa.array(first))
        _, _, data, offs = next(K.text_chunks(ctx, 1 << 40))
        size = np.diff(offs)
        low, high = np.maximum(least, length - (size - left)), np.minimum(np.minimum(left, reach), most)
        many = np.maximum(high - low + 1, 0)
        row = np.repeat(np.arange(len(g)), many)
        delta = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + low[row]
        group = np.cumsum(np.concatenate(([True], (deal[1:] != deal[:-1]) | (g[1:] != g[:-1])))) - 1
        alone = (np.bincount(group) == 1)[group]
        repeated, later = total[row] > 1, np.zeros(len(row), bool)
        k = np.flatnonzero(~alone[row])
        if len(k):
            m = len(g)
            place = np.empty(m, np.int64)
            place[np.lexsort((at, doc))] = np.arange(m)
            step = np.arange(reach)
            after = offs[:-1, None] + left[:, None] + KMER + step
            before = offs[:-1, None] + left[:, None] - 1 - step
            padded = np.append(data, np.uint8(0))
            at_right, same_after = common_prefixes(padded[np.where(after < offs[1:, None], after, len(data))], group)
            at_left, same_before = common_prefixes(padded[np.where(before >= offs[:-1, None], before, len(data))], group)
            own, far = row[k], delta[k]
            prefix, rest = same_before[at_left[own], far].astype(np.int64), same_after[at_right[own], reach - far]
            order = np.argsort((far * m + prefix) * m + at_right[own])  # suffix order for each number of bytes before the anchor
            prefix, rest, far = prefix[order], rest[order], far[order]
            begins = np.concatenate(([True], (far[1:] != far[:-1]) | (prefix[1:] != prefix[:-1]) | (rest[1:] != rest[:-1])))
            earlier = earlier_matches(place[own][order], begins)
            later[k[order]] = earlier
            repeated[k[order]] |= earlier | earlier_matches(-place[own][order], begins)  # in reversed places: a match that comes after
        spans, after = runs_of(repeated, row, delta, len(g)), runs_of(later, row, delta, len(g))
        keep = pa.array([bool(x) for x in spans])
        out = pa.RecordBatch.from_arrays([pa.array(g), pa.array(c), pa.array(doc), pa.array(at), pa.array(spans, pa.list_(pa.int32())), pa.array(after, pa.list_(pa.int32()))], names=result)
        return out.filter(keep)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        room = 0
        limit = max(1, RANK_AT_ONCE // (reach + 1))
        for b in batches:
            lo = 0
            while lo < b.num_rows:  # pieces, so that little more than the limit is ranked at a time
                piece = b.slice(lo, limit)
                lo += piece.num_rows
                held.append(piece)
                room += piece.num_rows
                if room >= limit:
                    whole = pa.Table.from_batches(held)
                    deal = whole.column("deal").to_numpy()
                    border = int(np.searchsorted(deal, deal[-1]))
                    if border:
                        yield rank(whole.slice(0, border))
                        held, room = whole.slice(border).to_batches(), whole.num_rows - border
        if room:
            yield rank(pa.Table.from_batches(held))

    return dealt(cut, length).repartition("deal").sortWithinPartitions("deal", "g", "c", "doc", "at").mapInArrow(K.tidy(stream), "g long, c long, doc0 long, at0 long, spans array<int>, later array<int>")


def united(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def whole_characters(raw: bytes, gone: list[tuple[int, int]]) -> str:
    """The text without the spans, of which each is narrowed to whole characters (bytes 0x80 to 0xBF go on with one)."""
    left, at = [], 0
    for x, y in gone:
        while x < y and raw[x] & 0xC0 == 0x80:
            x += 1
        while y > x and y < len(raw) and raw[y] & 0xC0 == 0x80:
            y -= 1
        left.append(raw[at:x])
        at = y
    return b"".join([*left, raw[at:]]).decode()


def removed_spans(docs: DataFrame, length: int = LENGTH, keep_first: bool = True) -> DataFrame:
    """did, rid, cuts (array of struct at, deltas): what to remove from each text that loses something; did and rid as in _with_row."""
    rows = _with_row(docs)
    wanted = stored(repeated_anchors(rows, length), "anchors")
    texts = packed(_only(rows, wanted, "left_semi"), ["doc_id", "did", "rid"]).join(wanted, ["did", "rid"])
    cut = stored(surroundings(texts, length), "surroundings")
    found = ranked_groups(cut, length)
    place = cut.where("rid is not null").select("g", "c", "rid", "at", "doc")
    joined = place.join(found, ["g", "c"])
    own = F.when((F.col("doc") == F.col("doc0")) & (F.col("at") == F.col("at0")), F.col("later")).otherwise(F.col("spans")) if keep_first else F.col("spans")
    hit = joined.select(F.col("doc").alias("did"), "rid", "at", own.alias("deltas")).where(F.size("deltas") > 0)
    return hit.groupBy("did", "rid").agg(F.collect_set(F.struct("at", "deltas")).alias("cuts"))


def _only(rows: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    ids = wanted.select("did", "rid")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, ["did", "rid"], how)


def cut_texts(docs: DataFrame, length: int = LENGTH, keep_first: bool = True, with_text: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, n_bytes, n_removed, n_spans, kept_sha256 and, with_text, the text that is left (there a cut that would split
    a character leaves the whole character; the numbers and the digest are of the bytes). One row per row of docs."""
    rows = _with_row(docs, keep)
    cuts = stored(removed_spans(docs, length, keep_first), "cuts")
    own = ["doc_id", "did", "rid", *keep]
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in own) + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = unpacked(b.column("z")) if "z" in b.schema.names else b.column("text").cast(pa.large_binary())
            cuts = b.column("cuts").to_pylist() if "cuts" in b.schema.names else [None] * b.num_rows
            size, removed, spans, sha, kept = [], [], [], [], []
            for t, cut in zip(texts, cuts, strict=True):
                raw = t.as_py() or b""
                gone = united([(x["at"] - d[k + 1], x["at"] - d[k] + length) for x in cut or () for d in (x["deltas"],) for k in range(0, len(d), 2)])
                left, at = [], 0
                for x, y in gone:
                    left.append(raw[at:x])
                    at = y
                rest = b"".join([*left, raw[at:]])
                size.append(len(raw))
                removed.append(len(raw) - len(rest))
                spans.append(len(gone))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(whole_characters(raw, gone) if with_text else None)
            cols = [*(b.column(k) for k in own), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())]
            names = [*own, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array(kept, pa.string())] * with_text)], names=[*names, *["text"] * with_text])

    clean = _only(rows, cuts, "left_anti").mapInArrow(K.tidy(apply), schema)
    hit = packed(_only(rows, cuts, "left_semi"), own).join(cuts, ["did", "rid"]).mapInArrow(K.tidy(apply), schema)
    return clean.unionByName(hit).drop("did", "rid")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies go, the first too, as the query's contract has it."""
    return cut_texts(table(spark, sf_dir, "documents"), keep_first=False, with_text=False)
