"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, give the probability of each byte of a word (A-Z lower-cased, with a border symbol at both
ends) after up to ``ORDER - 1`` symbols of the word before it. An n-gram is its symbols themselves, packed into one 64-bit integer, so
nothing is hashed. The counts come from all labelled training rows: raw counts for the longest n-grams and for those that begin a word,
continuation counts (distinct symbols to the left) below. Each class and order takes an absolute discount off its counts, from its own
counts of counts, and gives it to the next shorter context; under ``LOWEST`` symbols both classes share the counts. So an expression
that is rare in both classes gets nearly the same probability in both, and parts of words speak for forms never seen.

A text's score is a logistic curve of one number, its length-normalised difference of both log-likelihoods: the difference of each word
against the text's median word is shrunk towards 0 by ``SHRINK`` (the median takes out what a language or style adds to every word, the
shrinking what chance adds to a single one), summed over the whole text and divided by its number of words. The curve is fitted to the
logarithm of that number on all training rows that were left out of the counts, by sums that Spark adds up in each round.

All counts are Spark tables that grow with the corpus, and no n-gram is left out. What an n-gram says itself is weighed against its
shorter context by its evidence: with a share of ``HALF`` of the counts of its order in a class it has half of the weight, with less it
goes mostly by the shorter context. Up to ``BROADCAST_GRAMS`` n-grams are sent to the tasks; beyond, the ratio of each distinct n-gram is
found by joins, and each dealt batch of texts gets the ratios of its n-grams.

Defined results: null, empty and word-less texts score as a text with difference 0; unlabelled rows and null labels are not learned
from; rows of one id with several labels count once for each; without both classes in the training rows every score is the share of
toxic rows (0 if there are none); repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.shared import discard, held_out, rows, stored, table, text_column, unpacked, with_label

#: Symbols in the longest n-gram (8 bits each in a positive 64-bit integer), and in the shortest that is counted for each class.
ORDER, LOWEST = 7, 5
BORDER = 0x20
#: Share of its order's counts, in some class, that gives an n-gram half of its weight, and the power with which weights rise.
HALF, RISE = 1e-4, 4
#: Longest n-grams up to which a model is sent to the tasks (the shorter ones are no more for each order).
BROADCAST_GRAMS = 1_000_000
#: Bytes of text that are dealt together where n-grams get their ratios by joins.
DEALT = 16 << 20
#: Log ratio that a word may have by chance.
SHRINK = 1.5
#: Added before the logarithm is taken.
LEAST = 1e-3
#: N-grams that a task adds up at a time while counting.
TASK_GRAMS = 500_000
CHUNK = 1 << 20
THRESHOLD = 0.7
U64 = np.uint64


def vocabulary(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of one place of each distinct word, which of them each word is, and the first word of each text."""
    code, s, e, first = K.words(data, offs, K.PUNCTUATION)
    _, one, which = np.unique(code, return_index=True, return_inverse=True)
    return s[one], e[one], which, first


def grams(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The longest n-gram at each symbol of some words (their bytes, then a border), newest symbol lowest, and the word of each."""
    size = end - start + 2  # a border before and after
    at = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    z = np.full(int(size.sum()), BORDER, np.uint8)
    inside = np.ones(len(z), bool)
    inside[at] = inside[at + size - 1] = False
    k = np.flatnonzero(inside)
    z[k] = low[start[word[k]] + k - at[word[k]] - 1]
    first = np.zeros(len(z), bool)
    first[at] = True
    i = np.flatnonzero(~first)
    key, alive = z[i].astype(U64), np.ones(len(i), bool)
    for d in range(1, ORDER):
        j = i - d
        key[alive] |= z[j[alive]].astype(U64) << U64(8 * d)
        alive &= ~first[np.maximum(j, 0)]
    return key, word[i]


def gram_counts(labelled: DataFrame) -> DataFrame:
    """gram, n0, n1: how often each longest n-gram stands in ordinary and in toxic rows. Each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        room = 0
        for b in batches:
            toxic = np.asarray(b.column("toxic").to_pylist(), np.int64) != 0
            for lo, hi, data, offs in K.text_chunks(text_column(b), CHUNK):
                s, e, which, first = vocabulary(data, offs)
                if not len(s):
                    continue
                marked = np.repeat(toxic[lo:hi], np.diff(first))
                n = np.stack([np.bincount(which[marked == c], minlength=len(s)) for c in (False, True)], 1)
                key, word = grams(K.lowered(data), s, e)
                held.append(added(key.view(np.int64), n[word]))
                room += len(held[-1])
                if room > TASK_GRAMS:
                    held = [added(*parts(held))]
                    room = len(held[0])
                    if room > TASK_GRAMS:
                        yield batch(held[0])
                        held, room = [], 0
        if held:
            yield batch(added(*parts(held)))

    def parts(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t = np.concatenate(held)
        return t[:, 0], t[:, 1:]

    def added(key: np.ndarray, n: np.ndarray) -> np.ndarray:
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        return np.concatenate((key[first][:, None], np.add.reduceat(n[order], first)), 1)

    def batch(t: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in t.T], names=["gram", "n0", "n1"])

    return labelled.mapInArrow(K.tidy(count), "gram long, n0 long, n1 long").groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def of_length(k: int) -> Column:
    """Whether a gram has k symbols (none is zero)."""
    return (F.col("gram") >= 1 << 8 * (k - 1)) & (F.col("gram") < (1 << 8 * k))


def scale(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The discount of each class, and the count that gives an n-gram half of its weight (0: all have the whole)."""
    both = [f"sum(n{c}) as t{c}, count_if(n{c} = 1) as o{c}, count_if(n{c} = 2) as w{c}" for c in (0, 1)]
    sums = counted.selectExpr(*", ".join(both).split(", ")).first()
    total, once, twice = [np.array([sums[f"{x}{c}"] or 0 for c in (0, 1)], float) for x in "tow"]
    half = np.where(HALF * total > 1, np.ceil(HALF * total) - 0.5, 0)
    return np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5), half


class Level:
    """The n-grams of one order, sorted, in a model that is sent to the tasks: their counts in both classes, and the discounts."""

    def __init__(self, counted: DataFrame, order: int) -> None:
        self.discount, half = scale(counted)
        t = counted.toArrow().sort_by("gram")  # BROADCAST_GRAMS rows at most
        self.gram = t.column("gram").to_numpy().copy()
        self.n = np.stack([t.column(f"n{c}").to_numpy() for c in (0, 1)], 1).reshape(-1, 2)
        del t
        self.context, which = np.unique(self.gram >> 8, return_inverse=True)
        total, left = np.zeros((len(self.context), 2)), np.ones((len(self.context), 2))
        np.add.at(total, which, self.n)
        evidence = np.minimum((self.n / np.maximum(half, 1e-9)).max(1, initial=0.0), 1e6) ** RISE
        #: The share of each n-gram itself in its context, and what they leave to the shorter one.
        self.own = (np.maximum(self.n - self.discount, 0) / np.maximum(total, 1)[which] * (evidence / (1 + evidence))[:, None]).astype(np.float32)
        np.subtract.at(left, which, self.own)
        self.back = np.where(total > 0, np.clip(left, 1e-9, 1), 1.0)
        self.order = order
        self.p = np.zeros((0, 2))


def orders(counted: DataFrame) -> list[tuple[int, DataFrame, DataFrame]]:
    """(order, its n-grams with the counts that the models use, the work table they are in) from the longest order down to a single
    symbol; the counts of each come from the next longer ones."""
    out, now = [], counted.where(of_length(ORDER))
    for k in range(ORDER, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        shorter = now.groupBy(suffix.alias("gram")).agg(F.count_if(F.col("n0") > 0).alias("n0"), F.count_if(F.col("n1") > 0).alias("n1"))
        now = stored(now if k == ORDER else shorter.unionByName(counted.where(of_length(k))), "order")
        out.append((k, now if k >= LOWEST else now.selectExpr("gram", "n0 + n1 as n0", "n0 + n1 as n1"), now))
    return out


def levels(counted: DataFrame) -> list[Level]:
    """The levels from the longest order down to a single symbol."""
    tables = orders(counted)
    out = [Level(t, k) for k, t, _ in tables]
    K.give_back()
    discard(*(x for *_, x in tables))
    return out


class Model:
    """Log ratios of toxic to ordinary probability for n-grams, and of what contexts leave to shorter ones, in two probing tables."""

    def __init__(self, built: list[Level]) -> None:
        for k in range(len(built) - 1, -1, -1):
            level, below = built[k], built[k + 1 : k + 2]
            at = np.searchsorted(level.context, level.gram >> 8)
            shorter = [x.p[np.searchsorted(x.gram, level.gram & ((1 << 8 * x.order) - 1))] for x in below]  # each suffix is there
            level.p = (level.own + level.back[at] * (shorter[0] if shorter else 1 / 256)).astype(np.float32)
        own = [x for x in built if x.order >= LOWEST]
        ratio = [np.subtract(*np.log(np.maximum(x.p, 1e-38)).T[::-1]) for x in own]
        back = [np.log(x.back[:, 1]) - np.log(x.back[:, 0]) for x in own]
        self.grams = probed(np.concatenate([x.gram for x in own]), np.concatenate(ratio))
        self.contexts = probed(np.concatenate([x.context for x in own]), np.concatenate(back))
        self.weights = np.zeros(2)
        self.sent: Broadcast | None = None

    def word_ratios(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary)."""
        key, word = grams(low, start, end)
        total, open_ = np.zeros(len(key)), np.arange(len(key))
        for k in range(ORDER, LOWEST - 1, -1):
            gram = key[open_] & U64((1 << 8 * k) - 1)
            full = gram >> U64(8 * (k - 1)) > 0  # shorter ones have their turn later
            value, there = look_up(self.grams, gram)
            there &= full
            left, known = look_up(self.contexts, gram >> U64(8))
            total[open_] += np.where(there, value, np.where(known & full, left, 0.0))
            open_ = open_[~there]
        return np.bincount(word, total, len(start))

    def differences(self, column: pa.Array) -> np.ndarray:
        """For each text the mean shrunk log ratio of its words (0 without words)."""
        out = np.zeros(len(column))
        for lo, hi, data, offs in K.text_chunks(column, CHUNK):
            s, e, which, first = vocabulary(data, offs)
            out[lo:hi] = mean_excess(self.word_ratios(K.lowered(data), s, e)[which] if len(s) else np.zeros(0), first)
        return out


def mean_excess(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the mean of what its words' ratios have beyond their median and SHRINK."""
    parts = [own[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    return np.array([np.maximum(x - np.median(x) - SHRINK, 0).mean() if len(x) else 0.0 for x in parts])


class Tables:
    """A model that stays in Spark: gram, value and context, value as in ``Model``, for all orders."""

    def __init__(self, counted: DataFrame) -> None:
        tables = orders(counted)
        grams_, contexts, below = [], [], None
        for k, t, _ in reversed(tables):
            discount, half = scale(t)
            share = F.greatest(*(F.col(f"n{c}") / max(float(half[c]), 1e-9) for c in (0, 1)))
            evidence = F.pow(F.least(share, F.lit(1e6)), F.lit(RISE))
            parts = [(F.greatest(F.col(f"n{c}") - float(discount[c]), F.lit(0.0)) * evidence / (1 + evidence)).alias(f"m{c}") for c in (0, 1)]
            part = t.select("gram", F.shiftrightunsigned("gram", 8).alias("context"), "n0", "n1", *parts)
            size = [F.greatest(F.sum(f"n{c}"), F.lit(1)) for c in (0, 1)]
            back = [F.when(F.sum(f"n{c}") > 0, F.least(F.greatest(1 - F.sum(f"m{c}") / size[c], F.lit(1e-9)), F.lit(1.0))).otherwise(1.0).alias(f"back{c}") for c in (0, 1)]
            around = stored(part.groupBy("context").agg(*(x.alias(f"size{c}") for c, x in enumerate(size)), *back), "around")
            each = part.join(around, "context")
            if below is not None:
                each = each.withColumn("shorter", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(below.toDF("shorter", "q0", "q1"), "shorter")
            p = [(F.col(f"m{c}") / F.col(f"size{c}") + F.col(f"back{c}") * (F.col(f"q{c}") if below is not None else 1 / 256)).alias(f"p{c}") for c in (0, 1)]
            below = stored(each.select("gram", *p), "level")
            if k >= LOWEST:
                grams_.append(below.select("gram", (F.log(F.col("p1") + 1e-300) - F.log(F.col("p0") + 1e-300)).alias("value")))
                contexts.append(around.select("context", (F.log("back1") - F.log("back0")).alias("left")))
        self.grams, self.contexts = (stored(reduce(DataFrame.unionByName, x), "model") for x in (grams_, contexts))
        discard(*(x for *_, x in tables))
        self.weights = np.zeros(2)

    def ratios(self, keys: DataFrame) -> DataFrame:
        """key, ratio of distinct longest n-grams (key): the longest of its ends that is in the model, after what longer contexts leave."""
        ends = [(k, F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1))) for k in range(LOWEST, ORDER + 1)]
        steps = [F.when(g >= 1 << 8 * (k - 1), F.struct(F.lit(k).alias("k"), g.alias("gram"), F.shiftrightunsigned(g, 8).alias("context"))) for k, g in ends]
        wanted = keys.select("key", F.explode(F.array_compact(F.array(*steps))).alias("s")).select("key", "s.*")
        there = wanted.join(self.grams, "gram", "left").join(self.contexts, "context", "left")
        each = there.groupBy("key").agg(F.max(F.when(F.col("value").isNotNull(), F.struct("k", "value"))).alias("top"), F.sort_array(F.collect_list(F.struct("k", "left"))).alias("steps"))
        longer = F.filter("steps", lambda x: (x["k"] > F.coalesce(F.col("top.k"), F.lit(0))) & x["left"].isNotNull())
        return each.select("key", F.aggregate(longer, F.coalesce("top.value", F.lit(0.0)), lambda a, x: a + x["left"]).cast("float").alias("ratio"))

    def described(self, docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """The columns ``keep`` of docs, and x: the difference of each text. Texts are dealt in batches, which get the ratios of their
        n-grams."""
        own = [k for k in keep if k != "text"]
        types = {f.name: f.dataType.simpleString() for f in docs.schema}
        schema = ", ".join(f"`{k}` {types[k]}" for k in own)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                column = text_column(b)
                for lo, hi, _, _ in K.text_chunks(column, DEALT):
                    z = [None if t is None else zlib.compress(t, 1) for t in column.slice(lo, hi - lo).cast(pa.large_binary()).to_pylist()]
                    number = np.full(hi - lo, uuid.uuid4().int >> 65, np.int64)
                    yield rows([*own, "z", "batch"], *(b.column(k).slice(lo, hi - lo) for k in own), pa.array(z, pa.binary()), number)

        def list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                number = b.column("batch").to_numpy()
                for n in np.unique(number):
                    known = np.zeros(0, U64)
                    for _, _, data, offs in K.text_chunks(text_column(b.filter(pa.array(number == n))), CHUNK):
                        s, e, *_ = vocabulary(data, offs)
                        known = np.union1d(known, grams(K.lowered(data), s, e)[0] if len(s) else known)
                    yield rows(["batch", "key"], np.full(len(known), n), known.view(np.int64))

        def describe(left: pa.Table, right: pa.Table) -> pa.Table:
            key = right.column("key").to_numpy()
            order = np.argsort(key)
            key, ratio = key[order], right.column("ratio").to_numpy()[order]
            texts, x = unpacked(left.column("z")), np.zeros(len(left))
            for lo, hi, data, offs in K.text_chunks(texts, CHUNK):
                s, e, which, first = vocabulary(data, offs)
                if len(s):
                    own, word = grams(K.lowered(data), s, e)
                    # short ones have no row: both classes share their counts
                    at = np.minimum(np.searchsorted(key, own.view(np.int64)), max(len(key) - 1, 0))
                    value = np.where(key[at] == own.view(np.int64), ratio[at], 0.0) if len(key) else np.zeros(len(own))
                    x[lo:hi] = mean_excess(np.bincount(word, value, len(s))[which], first)
            columns = [texts.cast(pa.string()) if k == "text" else left.column(k) for k in keep]
            return pa.table([*columns, pa.array(x)], names=[*keep, "x"])

        source = "z" if "z" in docs.columns else "text"
        dealt = stored(docs.select(*own, source).mapInArrow(K.tidy(deal), ", ".join(x for x in (schema, "z binary, batch long") if x)), "dealt")
        listed = stored(dealt.select("batch", "z").mapInArrow(K.tidy(list_keys), "batch long, key long"), "listed")
        found = listed.join(self.ratios(listed.select("key").distinct()), "key")
        out = ", ".join(f"`{k}` {types[k]}" for k in keep)
        return dealt.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(describe, f"{out}, x double")


def slots(keys: np.ndarray, size: int) -> np.ndarray:
    """The first place of each key in a probing table of less than 2^32 places."""
    return ((K.mix(keys) >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)


def probed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table with linear probing: keys (0: free) and values."""
    size = 16 + 3 * len(keys) // 2
    table_keys, table_values = np.zeros(size, U64), np.zeros(size, np.float32)
    keys = keys.astype(U64)
    at = slots(keys, size)
    left = np.arange(len(keys))
    while len(left):
        free = left[table_keys[at[left]] == 0]
        table_keys[at[free]] = keys[free]  # of several for one place the last gets it
        got = free[table_keys[at[free]] == keys[free]]
        table_values[at[got]] = values[got]
        left = np.setdiff1d(left, got, assume_unique=True)
        at[left] = (at[left] + 1) % size
    return table_keys, table_values


def look_up(probing: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of each wanted key, and whether it is there."""
    keys, values = probing
    at = slots(wanted, len(keys))
    there = keys[at] == wanted
    open_ = np.flatnonzero(~there & (keys[at] != 0))
    while len(open_):
        at[open_] = (at[open_] + 1) % len(keys)
        here = keys[at[open_]]
        there[open_] = here == wanted[open_]
        open_ = open_[(here != wanted[open_]) & (here != 0)]
    there &= wanted != 0
    return values[at], there


def fit(rows: DataFrame, rounds: int = 60) -> np.ndarray:
    """Offset and slope of a logistic curve over the column x for y (0 or 1), by Newton's method with a small ridge; the slope is not
    negative. The driver gets five sums a round."""
    of = rows.agg(F.count("y").alias("n"), F.sum("y").alias("toxic"), F.avg("x").alias("middle"), F.stddev_pop("x").alias("scale")).first()
    n, toxic = of["n"], of["toxic"] or 0.0
    if not 0 < toxic < n:
        share = (toxic + 0.5) / (n + 1) if toxic else 1e-6
        return np.array([np.log(share / (1 - share)), 0.0])
    middle, scale = of["middle"], max(of["scale"], 1e-9)
    w = np.zeros(2)
    x = (F.col("x") - middle) / scale
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), float(w[0]) + float(w[1]) * x))))
        each = rows.select(x.alias("x"), (p * (1 - p)).alias("v"), (F.col("y") - p).alias("e"))
        v, vx, vxx, e, ex = each.agg(F.sum("v"), F.sum(F.col("v") * F.col("x")), F.sum(F.col("v") * F.col("x") * F.col("x")), F.sum("e"), F.sum(F.col("e") * F.col("x"))).first()
        step = np.linalg.solve(np.array([[v, vx], [vx, vxx]]) + 1e-2 * np.eye(2), np.array([e, ex]) - 1e-2 * w)
        w += step * min(1.0, 2 / max(float(np.abs(step).max()), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    slope = max(w[1], 0.0) / scale
    return np.round([w[0] - slope * middle, slope], 9)  # sums differ in their last bits by the order of tasks


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The models of all labelled rows of docs. A fifth of the ids, by hash, is left out of the counts to fit the curve on."""
    labelled = with_label(docs, labels, "toxic")
    fifth = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    counted = stored(gram_counts(labelled.where(~fifth)), "grams")
    few = counted.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS
    model = Model(levels(counted)) if few else Tables(counted)
    K.give_back()  # the levels
    discard(counted)
    if few:
        model.sent = docs.sparkSession.sparkContext.broadcast(model)
    seen = described(labelled.where(fifth), model, ("doc_id", "toxic"))
    fitted = stored(seen.select(F.log(F.lit(LEAST) + F.col("x")).alias("x"), (F.col("toxic") != 0).cast("double").alias("y")), "fit")
    model.weights = fit(fitted)
    discard(fitted)
    return model


def described(docs: DataFrame, model: Model | Tables, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` of docs, and x: the difference of each text."""
    if isinstance(model, Tables):
        return model.described(docs, keep)
    sent = model.sent
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield rows([*keep, "x"], *(b.column(k) for k in keep), sent.value.differences(text_column(b)))

    source = "z" if "z" in docs.columns else "text"
    return docs.select(*dict.fromkeys([*keep, source])).mapInArrow(K.tidy(run), f"{schema}, x double")


def score(docs: DataFrame, model: Model | Tables, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of docs (none of them named score or x) and score."""
    offset, slope = map(float, model.weights)
    y = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), offset + slope * F.log(F.lit(LEAST) + F.col("x"))))
    return described(docs, model, keep).select(*keep, (1 / (1 + F.exp(-y))).alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
