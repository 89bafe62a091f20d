"""The corpus pipeline: toxicity, near-duplicates, repeated strings, benchmark decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents`` (extra columns of docs are dropped). Rows with a null doc_id are scored, cut and
tokenized like others; the stages that drop documents by id (near-duplicates, decontamination) leave them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import bpe, decontaminate, minhash, suffix, toxicity
from eventweave.llm.shared import held_out, small_batches, stored, table, without_ids

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: The stages have no SQL equivalent (models, sketches, tokens); tests hold them against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold stay, unchanged. Learns from labelled rows outside the held-out third."""
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, COLUMNS).where(F.col("score") < toxicity.THRESHOLD).drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group stays (five-word shingles, similarity 0.8)."""
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    gone = minhash.near_duplicates(docs).where("doc_id is not null and not kept").select("doc_id").distinct()
    return without_ids(docs, stored(gone, "near"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; later copies of repeated 200-byte strings are cut from the texts, and n_chars follows."""
    small_batches(spark, "4m")  # several workers of a task hold texts and what is cut from them
    cut = suffix.cut_texts(docs.select(*COLUMNS), keep=("lang", "source"))
    return cut.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage stay, unchanged."""
    docs = docs.select(*COLUMNS)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, stored(found.where("hits > 0 and doc_id is not null").select("doc_id").distinct(), "contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, and digests of the ids and of the decoded text, of each document."""
    small_batches(spark)
    return bpe.digests(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("suffix_dedup", cut_repeats), ("decontaminate", drop_contaminated), ("bpe", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
