"""Quality selection by importance resampling.

Two generative models over hashed word n-grams (one and two words, ``BUCKETS`` buckets) are counted: the target from labelled good
texts, the raw one from all texts. A document's importance weight is the product of its n-grams' target-to-raw ratios; the k
documents with the largest log weight plus Gumbel noise are a sample without replacement in proportion to the weights.

Defined results: null, empty and word-less texts have no n-grams, weight 0 (log) and a ratio of 0; the noise follows from the id and
the seed, so runs repeat; equal keys go by doc_id, null ids last; rows of one id have the same noise; without target rows all
weights are equal; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.shared import stored, table, text_column, with_label

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SHARE = 0.5
SEED = 17
#: Shares of a range whose rows are counted in one turn of the search for the cut.
PIECES = 1024


def slots(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram, and the text it belongs to (both for single words, then for pairs)."""
    code, _, _, first = K.words(data, offs, K.SPACES)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    shift = np.uint64(64 - BUCKET_BITS)
    pair = K.windows(code, 2)
    inside = doc[1:] == doc[:-1]
    return np.concatenate((code >> shift, pair[inside] >> shift)).astype(np.int64), np.concatenate((doc, doc[:-1][inside]))


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Counts over all texts: each task adds up its own, BUCKETS sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, data, offs in K.text_chunks(text_column(b)):
                total += np.bincount(slots(data, offs)[0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    out = np.zeros(BUCKETS)
    for r in docs.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r["slot"]] = r["n"]
    return out


def weighed(docs: DataFrame, target: np.ndarray, raw: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_weight (sum of the log ratios) and log_ratio (their mean)."""
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    if not target.sum():
        ratio[:] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for lo, hi, data, offs in K.text_chunks(b.column("text")):
                slot, doc = slots(data, offs)
                n[lo:hi] = np.bincount(doc, minlength=hi - lo)
                total[lo:hi] = np.bincount(doc, ratio[slot], hi - lo)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1))], names=["doc_id", "n_grams", "log_weight", "log_ratio"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_grams long, log_weight double, log_ratio double")


def gumbel(doc_id: Column, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def _narrowed(rows: DataFrame, value: str, k: int, falling: bool) -> tuple[DataFrame, object, int]:
    """The value of the k-th row in order of the column ``value``, the rows that share it, and the place of the k-th among them.

    Each turn counts the rows of PIECES equal shares of the range that is left and keeps the share with the k-th row, with the least
    and largest value found there as the next range. The range shrinks by PIECES a turn at least, so a few turns end at one value.
    """
    lo, hi, n = rows.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
    col = F.col(value)
    while lo != hi:
        width = hi - lo
        offset = (col - F.lit(lo)).cast("double") if isinstance(lo, float) or width < 1 << 52 else col.cast("double") - F.lit(float(lo))
        piece = F.least(F.greatest(F.floor(offset / F.lit(float(width)) * F.lit(float(PIECES))), F.lit(0)), F.lit(PIECES - 1))
        found = rows.groupBy(piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(found, key=lambda r: r["piece"], reverse=falling):
            if k <= r["n"]:
                break
            k -= r["n"]
        lo, hi = r["lo"], r["hi"]
        rows = rows.where(col.between(F.lit(lo), F.lit(hi)))
    return rows, lo, k


def cut_at(keys: DataFrame, k: int) -> tuple[float, int] | None:
    """The k-th row by falling key, then rising doc_id (null as the largest); None if there are fewer rows. Nothing is sorted or collected but counts."""
    rest = keys.select("key", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("i"))
    if not 0 < k <= rest.count():
        return None
    ties, key, k = _narrowed(rest, "key", k, falling=True)
    return key, _narrowed(ties, "i", k, falling=False)[1]


def resampled(docs: DataFrame, target: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """Each row of docs with its weight and whether it is among the floor(share * rows) selected. target: rows with a text."""
    weights = weighed(docs, bucket_counts(target), bucket_counts(docs.select("text")))
    keys = stored(weights.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "weights")
    cut = cut_at(keys, int(share * keys.count()))
    i = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    chosen = F.lit(False) if cut is None else (F.col("key") > cut[0]) | ((F.col("key") == cut[0]) & (i <= cut[1]))
    return keys.withColumn("selected", chosen)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = with_label(docs, table(spark, sf_dir, "labels"), "quality").where("quality = 1")
    return resampled(docs.select("doc_id", "text"), good)
