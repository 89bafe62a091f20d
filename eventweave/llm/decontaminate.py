"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a run of ``width`` words of a benchmark item (an item with fewer words is one pattern of its own length). The
alphabet of the search is the word: blocks are pairs of words. A shift table, indexed by a block's hash, says how far the search
may move on; where it says 0, the bucket of that block, in order of the whole pattern's hash, gives the patterns that may end so,
and their bytes are compared directly. The cursors of all segments of a batch move together, so each step of the search is one
vectorised table lookup. The benchmark's words are kept once, as places in one run of bytes; a pattern is the number of its first.

Patterns of at most ``MAX_PATTERN_BYTES`` of benchmark text are sent to the tasks at a time. A larger benchmark is searched in
blocks of that size, one search each, and the hits of all blocks are united for each document.

Defined results: null, empty or word-less texts have n_words 0 and are not contaminated; null or word-less items match nothing;
words of an item without id are hit, but no id is listed for them; repeated items or item ids count each id once; a document word
is hit once however many patterns cover it; an empty benchmark hits nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.shared import table

WIDTH = 10
MAX_PATTERN_BYTES = 16 << 20
SEGMENT = 512
#: Slots of a shift table for each block of the patterns, and the least and most bits of its index.
SLOTS_A_BLOCK, LEAST_BITS, MOST_BITS = 4, 12, 25


@dataclass
class Spans:
    """Words as places in lower-cased bytes."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def same(self, at: np.ndarray, other: Spans, there: np.ndarray, n: int) -> np.ndarray:
        """Whether the n words from each ``at`` are, byte for byte, those of ``other`` from the place of the same row in ``there``."""
        ok = np.ones(len(at), bool)
        for k in range(n):
            ok &= self.end[at + k] - self.start[at + k] == other.end[there + k] - other.start[there + k]
        for k in range(n):
            left = np.flatnonzero(ok)
            here, far = self.start[at[left] + k], other.start[there[left] + k]
            size = self.end[at[left] + k] - here
            row = np.repeat(np.arange(len(left)), size)
            step = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            ok[left[row[self.low[here[row] + step] != other.low[far[row] + step]]]] = False
        return ok


@dataclass
class Benchmark:
    """Distinct item ids in order, the words of all items, and the search tables by length of pattern."""

    ids: list[str]
    words: Spans
    patterns: list[Patterns]


class Patterns:
    """Shift table and buckets for all patterns of one length. starts: their first words; items: number of their id or -1."""

    def __init__(self, length: int, codes: np.ndarray, words: Spans, starts: np.ndarray, items: np.ndarray) -> None:
        self.length = length
        self.block = min(2, length)
        reach = length - self.block + 1
        self.bits = int(np.clip(np.ceil(np.log2(SLOTS_A_BLOCK * reach * len(starts))), LEAST_BITS, MOST_BITS))
        self.shift = np.full(1 << self.bits, reach, np.int8 if reach < 128 else np.int64)
        slots = self.slots(codes)
        for j in range(reach):  # a block that ends k words before the pattern's end allows a move of k; smaller moves overwrite
            self.shift[slots[starts + j]] = reach - 1 - j
        key = self.keys(slots[starts + length - self.block], K.windows(codes, length)[starts])
        order = np.lexsort((items, key))
        key, starts, items = key[order], starts[order], items[order]
        # Equal neighbours are one pattern with several items; unequal ones that share a key stay patterns of their own.
        new = np.ones(len(key), bool)
        near = np.flatnonzero(key[1:] == key[:-1]) + 1
        new[near] = ~words.same(starts[near], words, starts[near - 1], length)
        self.key, self.start = key[new], starts[new].astype(np.int32)
        self.item, self.first_item = items.astype(np.int32), np.append(np.flatnonzero(new), len(key)).astype(np.int32)

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """Slot of the block that starts at each word."""
        return (K.windows(codes, self.block) >> np.uint64(64 - self.bits)).astype(np.int64)

    def keys(self, slot: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Order of the buckets: slot of the last block, then hash of the whole pattern."""
        return slot.astype(np.uint64) << np.uint64(64 - self.bits) | whole >> np.uint64(self.bits)

    def find(self, code: np.ndarray, first: np.ndarray, words: Spans, own: Spans) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which a pattern occurs, and the number of the pattern."""
        n, m = len(code), self.length
        none = np.zeros(0, np.int64)
        if n < m:
            return none, none
        slot = self.slots(code)
        begin, end = first[:-1], first[1:]
        parts = -(-np.maximum(end - begin - m + 1, 0) // SEGMENT)
        begin = np.repeat(begin, parts) + SEGMENT * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        last = np.minimum(begin + SEGMENT, np.repeat(end - m + 1, parts))  # start positions of this segment end here
        at, stop, hits = begin + m - self.block, last + m - self.block, []
        while len(at):
            move = self.shift[slot[at]].astype(np.int64)
            hits.append(at[move == 0] - (m - self.block))
            at = at + np.maximum(move, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        found = np.sort(np.concatenate(hits)) if hits else none
        if not len(found):
            return none, none
        whole = K.windows(code[found[:, None] + np.arange(m)].reshape(-1), m)[::m]
        key = self.keys(slot[found + m - self.block], whole)
        lo, hi = np.searchsorted(self.key, key), np.searchsorted(self.key, key, "right")
        at = np.repeat(found, hi - lo)
        pattern = np.repeat(lo, hi - lo) + np.arange(len(at)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
        ok = words.same(at, own, self.start[pattern].astype(np.int64), m)
        return at[ok], pattern[ok]

    def items_of(self, pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of ``pattern`` and number of an item, for each item of each of these patterns."""
        lo = self.first_item[pattern]
        n = self.first_item[pattern + 1] - lo
        row = np.repeat(np.arange(len(pattern)), n)
        return row, self.item[np.repeat(lo, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]


def build(items: list[tuple[object, str | None]], width: int) -> Benchmark:
    ids = sorted({str(i) for i, _ in items if i is not None})
    number = {name: k for k, name in enumerate(ids)}
    own = np.array([-1 if i is None else number[str(i)] for i, _ in items], np.int64)
    texts = pa.array([t or "" for _, t in items], pa.large_string())
    data, offs = next(((d, o) for _, _, d, o in K.text_chunks(texts, 1 << 62)), (np.zeros(0, np.uint8), np.zeros(1, np.int64)))
    codes, start, end, first = K.words(data, offs, K.PUNCTUATION)
    words, patterns = Spans(K.lowered(data), start.astype(np.int32), end.astype(np.int32)), []
    count = np.diff(first)
    windows = np.where(count >= width, count - width + 1, 1)
    for n in np.unique(np.minimum(count, width)).tolist():
        if n:
            which = np.flatnonzero(np.minimum(count, width) == n)
            item = np.repeat(which, windows[which])
            starts = first[item] + np.arange(len(item)) - np.repeat(np.cumsum(windows[which]) - windows[which], windows[which])
            patterns.append(Patterns(n, codes, words, starts, own[item]))
    return Benchmark(ids, words, patterns)


def lists_by(row: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """One list for each of n rows, from values in order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def search(docs: DataFrame, benchmark: Benchmark, whole: bool, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: word count, hit words (their number, or with ``whole`` False their positions) and item ids found."""
    sent = docs.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        ids, none = pa.array(known.ids, pa.string()), np.zeros(0, np.int64)
        for b in batches:
            n_words, doc, place, holder, listed = np.zeros(b.num_rows, np.int64), [none], [none], [none], [none]
            for lo, hi, data, offs in K.text_chunks(b.column("text")):
                code, s, e, first = K.words(data, offs, K.PUNCTUATION)
                words, cover = Spans(K.lowered(data), s, e), np.zeros(len(code) + 1, np.int64)
                for p in known.patterns:
                    at, pattern = p.find(code, first, words, known.words)
                    cover += np.bincount(at, minlength=len(cover)) - np.bincount(at + p.length, minlength=len(cover))
                    row, item = p.items_of(pattern)
                    holder.append(lo + np.searchsorted(first, at[row], "right") - 1)
                    listed.append(item.astype(np.int64))
                hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
                own = np.searchsorted(first, hit, "right") - 1
                n_words[lo:hi] = np.diff(first)
                doc.append(lo + own)
                place.append(hit - first[own])
            doc, place, holder, listed = (np.concatenate(x) for x in (doc, place, holder, listed))
            pairs = np.unique(np.stack((holder, listed), 1)[listed >= 0], axis=0)
            hits = pa.array(np.bincount(doc, minlength=b.num_rows)) if whole else lists_by(doc, pa.array(place), b.num_rows)
            items = lists_by(pairs[:, 0], ids.take(pa.array(pairs[:, 1])), b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(n_words), hits, items], names=[*keys, "n_words", "hits", "items"])

    kind = "long" if whole else "array<long>"
    return docs.select(*keys, "text").mapInArrow(run, f"{', '.join(f'{k} long' for k in keys)}, n_words long, hits {kind}, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_bytes: int = MAX_PATTERN_BYTES) -> DataFrame:
    """doc_id, n_words, hits (number of hit words), items (sorted ids). One row per row of docs."""
    weight = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    total = benchmark.agg(F.sum(weight)).first()[0] or 0
    if total <= max_bytes:
        return search(docs, build([(r[0], r[1]) for r in benchmark.select("item_id", "text").collect()], width), True)
    # Beyond the bound: equal shares of the items by hash, one search for each, hits united per document.
    blocks = -(-2 * total // max_bytes)
    share = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("b"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    distinct = keyed.dropDuplicates(["doc_id", "h"])
    parts = None
    for k in range(blocks):
        own = build([(r[0], r[1]) for r in share.where(F.col("b") == k).select("item_id", "text").collect()], width)
        part = search(distinct, own, False, ("doc_id", "h"))
        parts = part if parts is None else parts.unionByName(part)
    one = parts.groupBy("doc_id", "h").agg(F.first("n_words").alias("n_words"), F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    copies = keyed.groupBy("doc_id", "h").count()
    same = (F.col("a.doc_id").eqNullSafe(F.col("c.doc_id"))) & (F.col("a.h") == F.col("c.h"))
    return one.alias("a").join(copies.alias("c"), same).select("a.doc_id", "n_words", "hits", "items", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("k")).drop("k")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    joined = F.array_join("items", ",")
    return found.select(
        "doc_id", "n_words", F.col("hits").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), (F.col("hits") > 0).alias("contaminated")
    )
