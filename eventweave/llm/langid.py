"""Language identification by rank-order profiles.

A language's profile is the order of its most frequent letter n-grams (1 to 3 characters, words padded by a blank) over all its
training texts. A document's most frequent n-grams are ranked too; the out-of-place distance to a profile adds, for each of them,
how far its rank is from the profile's rank, or the profile length if it is missing there. The nearest language is predicted.

Defined results: null texts and texts without a letter give ``und`` and score 0; equal counts rank by n-gram code, equal distances
go to the language that sorts first; without any training language every text gives ``und``; repeated rows give repeated results;
extra columns are ignored. Rows with a null lang are predicted but not learned from; a null doc_id counts as the text ''.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm.shared import held_out, table

PROFILE = 300
#: Characters of text counted in one vectorised step while learning.
STEP = 400_000
_LETTER = regex.compile(r"\p{L}")
_BLANK = regex.compile(r"[^\p{L}\p{M}]+")


def grams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-character n-grams of the lower-cased letters, blanks only as padding (one code holds 21 bits a character)."""
    flat = " " + _BLANK.sub(" ", text.lower()).strip() + " "
    if len(flat) < 3:
        return np.zeros(0, np.int64)
    c = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    one, two, three = c[c != 32], (c[:-1] << 21) | c[1:], (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
    return np.concatenate((one, two, three[c[1:-1] != 32]))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(codes)
    at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[at], np.diff(np.concatenate((at, [len(s)])))


def ranked(text: str, size: int) -> np.ndarray:
    """The document's most frequent n-grams, most frequent first, equal counts by code."""
    codes = grams(text) if _LETTER.search(text) else np.zeros(0, np.int64)
    if not len(codes):
        return codes
    code, n = counted(codes)
    if len(code) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        keep = n >= least
        code, n = code[keep], n[keep]
    return code[np.argsort(-n, kind="stable")][:size]


def learn(train: DataFrame, size: int = PROFILE) -> list[tuple[str, list[int]]]:
    """The profile of each lang. Counts cover all of ``train``; only ``size`` codes per language reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            texts: dict[str, list[str]] = {}
            room: dict[str, int] = {}

            def flush(lang: str) -> None:
                code, n = counted(np.concatenate([grams(t) for t in texts.pop(lang)]))
                if lang in total:
                    both, where = np.unique(np.concatenate((total[lang][0], code)), return_inverse=True)
                    n = np.bincount(where, np.concatenate((total[lang][1], n)), len(both)).astype(np.int64)
                    code = both
                total[lang] = code, n
                room.pop(lang)

            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                t = text.as_py()
                texts.setdefault(lang, []).append(t)
                room[lang] = room.get(lang, 0) + len(t)
                if room[lang] > STEP:
                    flush(lang)
            for lang in list(texts):
                flush(lang)
        for lang, (code, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["lang", "code", "n"])

    partial = train.where("lang is not null and text is not null").select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    summed = partial.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = summed.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("r") <= size)
    profiles: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["r"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return sorted(profiles.items())


def predict(docs: DataFrame, profiles: list[tuple[str, list[int]]], size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score (1 minus the share of the largest possible distance to the nearest profile)."""
    names = [k for k, _ in profiles]
    codes = np.unique(np.array(sorted({c for _, p in profiles for c in p}), np.int64))
    rank = np.full((len(names), len(codes) + 1), -1, np.int64)
    for i, (_, p) in enumerate(profiles):
        rank[i, np.searchsorted(codes, p)] = np.arange(len(p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = [], []
            for text in b.column("text"):
                own = ranked(text.as_py() or "", size)
                if not len(own) or not names:
                    lang.append("und")
                    score.append(0.0)
                    continue
                k = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                there = np.where(codes[k] == own, rank[:, k], -1)
                far = np.where(there >= 0, np.abs(there - np.arange(len(own))), size).sum(1) / (size * len(own))
                best = int(np.argmin(far))
                lang.append(names[best])
                score.append(float(np.clip(1.0 - far[best], 0.0, 1.0)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out()))
    return predict(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
