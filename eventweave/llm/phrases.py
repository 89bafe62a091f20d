"""Collocated phrases by stripes: each prefix keys a counter of the words that follow it.

1. Texts are split into pieces and words. A batch of texts of one language becomes a sequence of numbers of its own distinct words; the
   words are counted over the corpus, and those with at least ``least`` occurrences get a number that holds everywhere, which goes back
   to the batches that have them, as one list from each counting task. Rarer words and the ends of pieces become gaps: no phrase that counts can hold them.
2. For prefixes of one to four words in turn, a task builds stripes: prefix -> how often each word follows (and how often none that
   counts does). Stripes of one prefix are merged elementwise, in parts by the following word, so that the stripe of a hot prefix is
   dealt over tasks. They travel in bundles, by a hash of prefix and part; there are more bundles the more frequent words there are. A longer prefix is only looked at where it and its parts were frequent; a bit filter of bounded size says so, and
   what it lets pass too much ends at the merge.
3. From the merged stripes follow: the extensions (phrases of one word more with their counts), the totals of a prefix (its own count),
   and the subsumption maxima: the most frequent word after a phrase, and, by the tails of the extensions, the most frequent one before
   it. A phrase inside a longer one of at least its count is also inside one that is one word longer with that count, since counts never
   rise with length; so the maxima decide. The longest phrases have none.
4. Each cut of a phrase looks up the counts of both parts; scores are exact, in decimals.

Defined results: null texts are empty, a null lang is ``und``; repeated rows count each; ties of cuts go to the shortest first part,
ties of rank to the more frequent phrase and then to the one that sorts first by bytes; extra columns are ignored, and doc_id is not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.shared import discard, stored, table

LONGEST = 5
LEAST = 100
TOP = 2000
#: Bytes of text of one language that are numbered together.
BATCH_BYTES = 8 << 20
#: Occurrences of a word up to which its stripe stays in one part; the stripe of a more frequent one is dealt by the following word.
PART_WORDS = 1 << 17
#: Bits of the filter of frequent phrases: at least 16 for each, and this many at most (32 MB).
FILTER_BITS = 1 << 28
#: Entries that a task gathers before it merges and gives out its stripes.
GATHERED = 1 << 21
#: Frequent words for each bundle of stripes, and the least number of bundles of a language (a power of two).
BUNDLE_WORDS, BUNDLES = 1 << 8, 1 << 9
#: Words that are hashed and compared in one step.
STEP = 1 << 16
#: Where a phrase ends: any ASCII character between pieces. Words are separated by blanks and tabs besides.
PIECES = K.separators([(0x2E, 0x2E), (0x2C, 0x2C), (0x3A, 0x3B), (0x21, 0x21), (0x3F, 0x3F), (0x0A, 0x0D)])
WORDS = PIECES | K.separators([(0x20, 0x20), (0x09, 0x09)])
#: Between pieces and in place of rarer words. Numbers of words are above it.
GAP = 0
#: Low bits of a word's number: the power of two of the parts of its stripes.
PART_BITS = 4
U64 = np.uint64


def distinct(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word low[start:end] among the distinct ones, and those. Words of one hash are compared byte by byte."""
    code = np.empty(len(start), U64)
    for lo in range(0, len(start), STEP):
        a, b = start[lo : lo + STEP], end[lo : lo + STEP]
        code[lo : lo + STEP] = K.span_hash(K.prefix_hash(low[a[0] : b[-1]]), a - a[0], b - a[0])
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    exact = True
    for lo in range(0, len(start), STEP):
        a, b, like = start[lo : lo + STEP], end[lo : lo + STEP], first[number[lo : lo + STEP]]
        length = b - a
        exact = exact and bool((length == end[like] - start[like]).all())
        if exact:
            at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            exact = bool((low[np.repeat(a, length) + at] == low[np.repeat(start[like], length) + at]).all())
    raw = low.tobytes()
    if exact:
        return number, [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(raw[a:b], len(known)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int64, len(start))
    return number, list(known)


def squeezed(seq: np.ndarray) -> bytes:
    """32-bit numbers, most of them small, as compressed bytes: all lowest bytes, then all second ones, and so on."""
    return zlib.compress(seq.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unsqueezed(z: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(zlib.decompress(z), np.uint8).reshape(4, -1).T.tobytes(), "<u4")


def numbered(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: batch, lang, seq (squeezed numbers of the batch's own words, the most frequent first, 0 between pieces); and
    batch, lang, own, word, n."""
    names = ["batch", "lang", "seq", "own", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        room: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal batch
            # a line end between texts keeps their pieces apart
            data = np.frombuffer(b"\n".join(held.pop(lang)), np.uint8)
            room.pop(lang)
            low = K.lowered(data)
            inside = np.concatenate(([False], ~WORDS[low], [False]))
            start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
            if not len(start):
                return
            number, words = distinct(low, start, end)
            ends = np.cumsum(PIECES[low])
            fresh = np.concatenate(([0], (ends[start[1:]] != ends[start[:-1]]).astype(np.int64)))
            n = np.bincount(number, minlength=len(words))
            k = len(words)
            own = np.empty(k, np.int32)
            own[np.argsort(-n, kind="stable")] = np.arange(1, k + 1)
            seq = np.zeros(len(start) + int(fresh.sum()), np.uint32)
            seq[np.arange(len(start)) + np.cumsum(fresh)] = own[number]
            yield pa.RecordBatch.from_arrays([pa.array([batch]), pa.array([lang]), pa.array([squeezed(seq)], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())], names=names)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, batch)), pa.array([lang] * k), pa.nulls(k, pa.binary()), pa.array(own), pa.array(words, pa.binary()), pa.array(n)], names=names)
            batch += 1

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                if text.is_valid and len(raw := text.as_buffer()):
                    if room.get(lang, 0) + len(raw) > BATCH_BYTES and lang in held:
                        yield from flush(lang)
                    held.setdefault(lang, []).append(raw.to_pybytes())
                    room[lang] = room.get(lang, 0) + len(raw)
        for lang in list(held):
            yield from flush(lang)

    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return read.mapInArrow(K.tidy(run), "batch long, lang string, seq binary, own int, word binary, n long")


def frequent(both: DataFrame, least: int) -> DataFrame:
    """Two kinds of rows: task, at, bits, lang, word, f (the words with ``least`` occurrences, at from 0 in each task; bits: the power of
    two of the parts of the word's stripes); and task, batch, own, to (what a batch has of them: differences of its own numbers in order,
    and at << PART_BITS | bits of each). Words come together by one shuffle, in which each batch has a row a word at most."""
    names = ["task", "at", "bits", "lang", "word", "f", "batch", "own", "to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        held: pa.Table | None = None
        lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        room = 0

        def given(t: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            """The words of t; the last one waits for more rows, if there may be."""
            nonlocal held, at, room
            lang, word = t.column("lang").combine_chunks(), t.column("word").combine_chunks()
            same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(word[1:], word[:-1])).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            if not last:
                held = t.slice(int(first[-1]))
                t, first = t.slice(0, int(first[-1])), first[:-1]
                if not len(first):
                    return
            f = np.add.reduceat(t.column("n").to_numpy(), first)
            keep = f >= least
            place = at + np.cumsum(keep) - 1
            at += int(keep.sum())
            k = int(keep.sum())
            bits = np.clip(np.ceil(np.log2(f / PART_WORDS)), 0, (1 << PART_BITS) - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, task, np.int32)), pa.array(place[keep]), pa.array(bits[keep]), lang.take(pa.array(first[keep])), word.take(pa.array(first[keep])), pa.array(f[keep]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], names=names)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, t.num_rows)))
            rows = keep[group]
            to = ((place << PART_BITS) | bits).astype(np.uint32)
            lists.append((t.column("batch").to_numpy()[rows], t.column("own").to_numpy()[rows].astype(np.uint32), to[group[rows]]))
            room += int(rows.sum())

        def flush() -> pa.RecordBatch:
            nonlocal room
            batch, own, to = (np.concatenate(c) for c in zip(*lists, strict=True))
            lists.clear()
            room = 0
            order = np.lexsort((own, batch))
            batch, own, to = batch[order], own[order], to[order]
            first = np.flatnonzero(np.concatenate(([True], batch[1:] != batch[:-1])))
            step = own.copy()
            step[1:] -= own[:-1]
            step[first] = own[first]
            cut, k = np.append(first, len(batch)) * 4, len(first)
            binary = lambda data: pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, task, np.int32)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.string()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()), pa.array(batch[first]), binary(step), binary(to)], names=names)

        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                yield from given(pa.concat_tables([held, t]) if held is not None else t, last=False)
                if room > GATHERED:
                    yield flush()
        if held is not None:
            yield from given(held, last=True)
        if room:
            yield flush()

    words = both.where("word is not null").select("batch", "lang", "own", "word", "n")
    return words.repartition("lang", "word").sortWithinPartitions("lang", "word").mapInArrow(K.tidy(run), "task int, at long, bits int, lang string, word binary, f long, batch long, own binary, to binary")


def renumbered(both: DataFrame, known: DataFrame, starts: dict[int, int]) -> DataFrame:
    """lang, seq: each batch's sequence in numbers that hold everywhere (32 bits: place << PART_BITS | parts), GAP for rarer words."""
    lists = known.where("batch is not null").groupBy("batch").agg(F.collect_list(F.struct("task", "own", "to")).alias("known"))
    # the lists of all batches are no table to broadcast: they grow with the corpus
    rows = both.where("seq is not null").select("batch", "lang", "seq").join(lists.hint("merge"), "batch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, seq, known in zip(b.column("lang"), b.column("seq"), b.column("known"), strict=True):
                seq = unsqueezed(seq.as_buffer())
                to = np.zeros(int(seq.max(initial=0)) + 1, np.uint32)
                for task, own, place in zip(*(known.values.field(c) for c in ("task", "own", "to")), strict=True):
                    at = np.cumsum(np.frombuffer(own.as_buffer(), np.uint32), dtype=np.int64)
                    to[at] = np.frombuffer(place.as_buffer(), np.uint32) + np.uint32(starts[task.as_py()] + 1 << PART_BITS)
                out = to[seq]
                keep = (out != GAP) | np.concatenate(([False], out[:-1] != GAP))  # one gap in a row says as much as many
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()]), pa.array([out[keep].tobytes()], pa.binary())], names=["lang", "seq"])

    return rows.select("lang", "seq", "known").mapInArrow(K.tidy(run), "lang string, seq binary")


def spelled_out(known: DataFrame, starts: dict[int, int]) -> DataFrame:
    """id, word: the number of each frequent word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            task, at, bits = (b.column(c).to_pylist() for c in ("task", "at", "bits"))
            ids = [(starts[t] + a + 1 << PART_BITS) | p for t, a, p in zip(task, at, bits, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), b.column("word")], names=["id", "word"])

    return known.where("word is not null").select("task", "at", "bits", "word").mapInArrow(run, "id long, word binary")


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of numbers."""
    h = np.full(len(columns[0]), len(columns), U64)
    for c in columns:
        h = K.mix(h * U64(0x9E3779B97F4A7C15) + c.astype(U64))
    return h


def bits_of(phrases: DataFrame, size: int) -> np.ndarray | None:
    """A bit filter of the phrases (arrays of ``size`` ids), or None if there are none. The driver gets its words: at most 32 MB."""
    many = phrases.count()
    if not many:
        return None
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(10, (16 * many - 1).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("phrase").flatten().to_numpy().reshape(-1, size)
            h = mixed(list(ids.T))
            for part in (h, K.mix(h)):
                at = (part & U64(bits - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.ones(len(at), U64) << (at & 63).astype(U64)).view(np.int64))], names=["at", "bit"])

    rows = phrases.select("phrase").mapInArrow(place, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bit").to_numpy()
    return out.view(U64)


def passes(filter_: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    h = mixed(columns)
    out = np.ones(len(h), bool)
    for part in (h, K.mix(h)):
        at = part & U64((len(filter_) << 6) - 1)
        out &= (filter_[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) == 1
    return out


def summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of numbers, in order of the columns, with their n added up."""
    order = np.argsort((columns[0].astype(U64) << U64(32)) | columns[1].astype(U64)) if len(columns) == 2 else np.lexsort(columns[::-1])
    columns, n = [c[order] for c in columns], n[order]
    new = np.zeros(len(n), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n, first) if len(first) else n


def binaries(data: np.ndarray, cut: np.ndarray) -> pa.Array:
    """A binary column of 32-bit numbers, each row from one cut to the next."""
    offsets = (cut * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.astype(np.uint32).tobytes())])


def as_stripes(lang: str, columns: list[np.ndarray], n: np.ndarray, bundles: int) -> pa.RecordBatch:
    """One row for each bundle: its prefixes (all columns but the last), how many words follow each, those words (differences of their
    sorted numbers), and how often each does. The least frequent word of a prefix says in how many parts its words are dealt, everywhere
    alike; a hash of prefix and part gives the bundle."""
    bits = columns[0] & ((1 << PART_BITS) - 1)
    for c in columns[1:-1]:
        bits = np.minimum(bits, c & ((1 << PART_BITS) - 1))
    part = (columns[-1] >> PART_BITS) & ((1 << bits) - 1)
    bundle = (mixed([*columns[:-1], part]) & U64(bundles - 1)).astype(np.uint16 if bundles <= 1 << 16 else np.int64)
    order = np.argsort(bundle, kind="stable")  # prefixes and words stay in order
    bundle, columns, n = bundle[order], [c[order] for c in columns], n[order]
    new = np.ones(len(n), bool)
    new[1:] = bundle[1:] != bundle[:-1]
    row = np.append(np.flatnonzero(new), len(n))
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    step = columns[-1].copy()
    step[1:] -= np.where(new[1:], 0, columns[-1][:-1]).astype(np.uint32)
    stripe = np.searchsorted(first, row)
    prefix = np.stack(columns[:-1], 1)[first]
    lists = [binaries(prefix, stripe * prefix.shape[1]), binaries(np.diff(np.append(first, len(n))), stripe), binaries(step, row), binaries(n, row)]
    return pa.RecordBatch.from_arrays([pa.array([lang] * (len(row) - 1)), pa.array(bundle[row[:-1]].astype(np.int32)), *lists], names=["lang", "bundle", "prefix", "many", "next", "times"])


#: Stripes of tasks, and merged ones.
PARTIAL = "lang string, bundle int, prefix binary, many binary, next binary, times binary"
STRIPES = "lang string, prefix array<long>, next array<long>, times array<long>"


def stripes(sequences: DataFrame, size: int, filter_: np.ndarray | None, bundles: int = BUNDLES) -> DataFrame:
    """Stripes of each task: prefixes of ``size`` frequent words, and the counter of the words after them (GAP: none that counts)."""
    sent = None if filter_ is None else sequences.sparkSession.sparkContext.broadcast(filter_)

    def counts(seq: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        seq = np.append(seq, np.uint32(GAP))
        n = len(seq) - size
        columns = [seq[k : k + n] for k in range(size + 1)]
        there = columns[0] != GAP
        for c in columns[1:-1]:
            there &= c != GAP
        at = np.flatnonzero(there)
        columns = [c[at] for c in columns]
        if sent is not None and len(at):
            ok = passes(sent.value, columns[:-1])
            columns = [c[ok] for c in columns]
            # a word follows if the last words with it were frequent too; else the end of the stripe's counter takes the occurrence
            tail = passes(sent.value, columns[1:]) if len(columns[0]) else np.zeros(0, bool)
            columns[-1] = np.where(tail, columns[-1], np.uint32(GAP))
        return summed(columns, np.ones(len(columns[0]), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[list[np.ndarray], np.ndarray]]] = {}
        room: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            own = held.pop(lang)
            room.pop(lang)
            columns, n = summed([np.concatenate([o[0][k] for o in own]) for k in range(size + 1)], np.concatenate([o[1] for o in own]))
            yield as_stripes(lang, columns, n, bundles)

        for b in batches:
            for lang, seq in zip(b.column("lang").to_pylist(), b.column("seq"), strict=True):
                columns, n = counts(np.frombuffer(seq.as_buffer(), np.uint32))
                if len(n):
                    held.setdefault(lang, []).append((columns, n))
                    room[lang] = room.get(lang, 0) + len(n)
                    if room[lang] > GATHERED:
                        yield from flush(lang)
        for lang in list(held):
            yield from flush(lang)

    return sequences.mapInArrow(K.tidy(run), PARTIAL)


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit numbers of a binary column, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), np.uint32), np.diff(offsets) // 4


def merged(parts: DataFrame, size: int, least: int) -> DataFrame:
    """The counters of each lang and prefix (of each part or more) merged elementwise. Only words that follow ``least`` times or more stay
    in them; the others are added to GAP, so that the sum of a prefix is unchanged. A task holds one bundle at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        room = 0

        def together() -> tuple[list[np.ndarray], np.ndarray]:
            return summed([np.concatenate([h[0][k] for h in held]) for k in range(size + 1)], np.concatenate([h[1] for h in held]))

        for b in batches:
            if not b.num_rows:
                continue
            keys = list(zip(b.column("lang").to_pylist(), b.column("bundle").to_pylist(), strict=True))
            prefix = numbers(b.column("prefix"))[0].reshape(-1, size)
            many = numbers(b.column("many"))[0].astype(np.int64)
            step, entries = numbers(b.column("next"))
            times = numbers(b.column("times"))[0].astype(np.int64)
            total = np.concatenate(([0], np.cumsum(step, dtype=np.int64)))
            word = (total[1:] - np.repeat(total[np.cumsum(many) - many], many)).astype(np.uint32)
            columns = [*(np.repeat(c, many) for c in prefix.T), word]
            cut = np.concatenate(([0], np.cumsum(entries)))
            lo = 0
            while lo < len(keys):
                hi = lo + 1
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != key:
                    if held:
                        yield given(key[0], *together())
                    key, held, room = keys[lo], [], 0
                x, y = cut[lo], cut[hi]
                held.append(([c[x:y].copy() for c in columns], times[x:y].copy()))
                room += int(y - x)
                if room > GATHERED and len(held) > 1:
                    held = [together()]
                    room = 0  # what is left is no longer than the merged bundle
                lo = hi
        if held:
            yield given(key[0], *together())

    def given(lang: str, columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(n), bool)
        new[1:] = False
        for c in columns[:-1]:
            new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        stripe, k = np.cumsum(new) - 1, len(first)
        stay = (n >= least) & (columns[-1] != GAP)
        rest = np.add.reduceat(np.where(stay, 0, n), first)
        gap = np.flatnonzero(rest)
        of = np.concatenate((stripe[stay], gap))
        order = np.argsort(of, kind="stable")
        words, times = np.concatenate((columns[-1][stay].astype(np.int64), np.full(len(gap), GAP)))[order], np.concatenate((n[stay], rest[gap]))[order]
        lists = lambda data, offsets: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(data.astype(np.int64)))
        ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=k))))
        prefix = np.stack(columns[:-1], 1)[first].reshape(-1)
        return pa.RecordBatch.from_arrays([pa.array([lang] * k), lists(prefix, np.arange(k + 1) * size), lists(words, ends), lists(times, ends)], names=["lang", "prefix", "next", "times"])

    key = ["lang", "bundle"]
    return parts.repartition(*key).sortWithinPartitions(*key).mapInArrow(K.tidy(run), STRIPES)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    both = stored(numbered(docs), "numbered")
    words = both.where("word is not null")
    total = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known = stored(frequent(both, least), "frequent")
    sizes = known.where("word is not null").groupBy("task").agg(F.count(F.lit(1)).alias("k")).collect()  # one row a task
    starts, at = {}, 0
    for r in sorted(sizes, key=lambda r: r["task"]):
        starts[r["task"]] = at
        at += r["k"]
    if at >= (1 << 32 - PART_BITS) - 1:
        raise ValueError("numbers of words must fit 32 bits")
    vocabulary = stored(spelled_out(known, starts), "vocabulary")
    sequences = stored(renumbered(both, known, starts), "sequences")
    bundles = max(BUNDLES, 1 << (at // BUNDLE_WORDS).bit_length())
    found, filter_, made = [], None, []
    for size in range(1, longest):
        merged_ = stored(merged(stripes(sequences, size, filter_, bundles), size, least), "stripes")
        made.append(merged_)
        entries = merged_.select("lang", "prefix", F.explode(F.arrays_zip("next", "times")).alias("e")).where(F.col("e.next") != GAP)
        found.append(entries.select("lang", F.concat("prefix", F.array("e.next")).alias("phrase"), F.col("e.times").alias("f")))
        if size + 1 < longest:
            filter_ = bits_of(found[-1], size + 1)
            if filter_ is None:
                break
    discard(both, sequences)
    phrases = found[0]
    for f in found[1:]:
        phrases = phrases.union(f)
    phrases = stored(phrases, "phrases")
    # totals of the stripes: a prefix that was looked at has its own count there, and so have single words
    own = made[0]
    for m in made[1:]:
        own = own.union(m)
    totals = own.groupBy("lang", "prefix").agg(F.sum(F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y)).alias("f"), F.max(F.array_max(F.filter(F.transform(F.arrays_zip("next", "times"), lambda e: F.when(e["next"] != GAP, e["times"])), lambda t: t.isNotNull()))).alias("after"))
    totals = stored(totals.withColumnRenamed("prefix", "phrase"), "totals")
    before = phrases.groupBy("lang", F.slice("phrase", 2, longest).alias("phrase")).agg(F.max("f").alias("before"))
    candidates = phrases.join(totals.select("lang", "phrase", "after"), ["lang", "phrase"], "left").join(before, ["lang", "phrase"], "left")
    free = candidates.where("100 * greatest(coalesce(after, 0), coalesce(before, 0)) < 100 * f").select("lang", "phrase", F.col("f").alias("a"))
    cuts = free.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
    cuts = cuts.withColumn("first", F.expr("slice(phrase, 1, k)")).withColumn("rest", F.expr("slice(phrase, k + 1, size(phrase))"))
    counts = totals.select("lang", "phrase", "f")
    both_ = cuts.join(counts.toDF("lang", "first", "l"), ["lang", "first"]).join(counts.toDF("lang", "rest", "r"), ["lang", "rest"]).join(F.broadcast(total) if few(total) else total, "lang")
    exact = F.expr("(cast(a as decimal(19, 0)) * cast(n as decimal(19, 0)) * 1000) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    scored = both_.withColumn("score", exact).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s"))
    spelled = with_words(scored.select("lang", "phrase", "s.*"), vocabulary)
    return ranked(spelled, top)


def few(langs: DataFrame) -> bool:
    """Whether the totals of the languages may be sent to all tasks."""
    return langs.limit(10_001).count() <= 10_000


def with_words(scored: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The phrases (arrays of ids) spelled out."""
    ids = scored.select("lang", "phrase", F.posexplode("phrase").alias("pos", "id")).join(vocabulary.select("id", "word"), "id")
    text = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: F.decode(w["word"], "UTF-8")))
    return scored.join(ids.groupBy("lang", "phrase").agg(text.alias("text")), ["lang", "phrase"])


def ranked(spelled: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language. Parts of a language are cut to their own first ones before they meet."""
    order = [F.desc("score"), F.desc("a"), F.col("text").cast("binary")]
    parted = spelled.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(64)))
    near = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    out = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
with docs as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) p from docs),
lists as (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from pieces),
totals as (select lang, sum(len(w))::hugeint n from lists group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) i from lists),
grams as (select lang, w[i : i + k - 1] g, k from starts, (values (1), (2), (3), (4), (5)) s(k) where i + k - 1 <= len(w)),
f as (select lang, g, any_value(k) k, count(*)::hugeint f from grams group by lang, g having count(*) >= 100),
cand as (select * from f where k >= 2),
longer as (select lang, g, f, k, unnest(range(1, k)) m from cand),
held as (
  select lang, h, max(f) f from (select lang, g[j : j + m - 1] h, f from (select *, unnest(range(1, k - m + 2)) j from longer)) group by lang, h),
free as (select c.lang, c.g, c.f a, c.k from cand c left join held on held.lang = c.lang and held.h = c.g where held.f is null or 100 * held.f < 100 * c.f),
cuts as (select lang, g, a, unnest(range(1, k)) c, k from free),
scored as (
  select cuts.lang, cuts.g, a, x.f l, y.f r, n, (1000 * a * n) // (x.f * y.f) score, c from cuts
  join f x on x.lang = cuts.lang and x.g = cuts.g[1 : c] join f y on y.lang = cuts.lang and y.g = cuts.g[c + 1 : cuts.k] join totals on totals.lang = cuts.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, g order by score, c) = 1),
named as (select lang, array_to_string(g, ' ') phrase, a, l, r, n, score from lowest)
select lang, rank, phrase, a::bigint a, l::bigint l, r::bigint r, n::bigint n, score::bigint score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from named) where rank <= 2000
"""
