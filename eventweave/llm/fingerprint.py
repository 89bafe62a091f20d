"""Document fingerprints: threshold-scaled sketches, in DataFrame functions only.

A sketch keeps every shingle hash below a fixed share of the hash space, and at least the FLOOR smallest ones (all, where a text has
fewer). Both rules hold for unions: the sketch of two texts together comes from their sketches alone. Two sketches are compared below
the smaller of the limits up to which they are complete, so the share of one found in the other estimates containment without bias
however unequal the documents are. Shingles are runs of five words (white space between words, A-Z lower-cased); a shorter text is one
shingle.

Defined results: null and empty texts, and texts without words, have an empty fingerprint; two empty fingerprints are alike to
degree 1 (equal fingerprints always are), an empty and another one to 0, and so are two without a hash below the common limit.
Documents are ordered by doc_id (null ids last in falling order), equal ids by the hash of their text; with a single document the
next document is itself. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm.shared import table

SHINGLE = 5
#: Retained share of the hash space: 1 / SCALE.
SCALE = 16
#: Hashes that are retained in any case: texts of up to SCALE * FLOOR shingles are compared by about so many.
FLOOR = 64
LAST = (1 << 63) - 1
LIMIT = (1 << 63) // SCALE * 2 - (1 << 63)
#: Documents in one run of the falling order of ids (a window task).
RUN_ROWS = 2048
MAX_RUNS = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once: inside a lambda of its own it has a name."""
    return F.element_at(F.transform(F.array(value), then), 1)


def sketch(text: Column) -> Column:
    """Sorted retained hashes as array<long>."""
    word = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def shingles(code: Column) -> Column:
        whole = F.when(F.size(code) > 0, F.array(F.xxhash64(code))).otherwise(F.array().cast("array<bigint>"))
        runs = F.transform(F.sequence(F.lit(1), F.size(code) - SHINGLE + 1), lambda i: F.xxhash64(*(F.element_at(code, i + k) for k in range(SHINGLE))))
        return F.when(F.size(code) >= SHINGLE, runs).otherwise(whole)

    return _kept(_bound(F.transform(word, lambda w: F.xxhash64(w)), shingles))


def _kept(hashes: Column) -> Column:
    def low_or_least(h: Column) -> Column:
        low = F.array_distinct(F.filter(h, lambda x: x < LIMIT))
        return _bound(low, lambda x: F.when(F.size(x) >= FLOOR, F.sort_array(x)).otherwise(F.slice(F.sort_array(F.array_distinct(h)), 1, FLOOR)))

    return _bound(hashes, low_or_least)


def union(a: Column, b: Column) -> Column:
    """The sketch of both texts' shingles together."""
    return _kept(F.concat(a, b))


def _complete_to(a: Column) -> Column:
    """The largest value up to which the sketch holds all hashes of its text."""
    return F.when(F.size(a) < FLOOR, F.lit(LAST)).otherwise(F.greatest(F.array_max(a), F.lit(LIMIT - 1)))


def _compared(a: Column, b: Column, then: Callable[[Column, Column, Column], Column]) -> Column:
    """then(hashes of a, of b, of both below the common limit); what both hold lies below it. Each part is computed once a row."""

    def below(p: Column) -> Column:
        x, y = p["a"], p["b"]
        count = lambda s, to: F.size(F.filter(s, lambda h: h <= to)).cast("long")
        common = F.size(F.array_intersect(x, y)).cast("long")
        return _bound(F.least(_complete_to(x), _complete_to(y)), lambda to: F.array(count(x, to), count(y, to), common))

    counts = _bound(F.struct(a.alias("a"), b.alias("b")), below)
    return _bound(counts, lambda n: then(n[0], n[1], n[2]))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too (0 where a has none below the common limit)."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(_compared(a, b, lambda na, nb, both: F.when(both == 0, F.lit(0.0)).otherwise(both / na)))


def likeness(a: Column, b: Column) -> Column:
    """The mean of both containments: 1 for equal sketches, 0 without a common hash."""
    alike = _compared(a, b, lambda na, nb, both: F.when(both == 0, F.lit(0.0)).otherwise((both / na + both / nb) / 2))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(alike)


def encoded(sketched: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _run_of(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below the id (two levels, so that a row looks at few of them)."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    every, coarse = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[width - 1 :: width]))
    group = F.size(F.filter(coarse, lambda x: x <= doc_id))
    fine = F.size(F.filter(F.slice(every, group * width + 1, F.lit(width)), lambda x: x <= doc_id))
    return group * width + fine


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, kept (sketch), next_text, next_kept: the next document in falling order of ids, after the last the first.

    The order is cut into runs of about RUN_ROWS documents by quantiles of the id, and null ids by the hash of the text. The first document of each run also goes to the
    end of the run before it, so each run is a window of its own and texts are shuffled once.
    """
    spark = docs.sparkSession
    runs = min(MAX_RUNS, max(1, docs.select("doc_id").count() // RUN_ROWS))
    cuts = [k / runs for k in range(1, runs)]
    bounds = sorted({int(x) for x in docs.select("doc_id").where("doc_id is not null").approxQuantile("doc_id", cuts, 0.1 / runs)}) if cuts else []
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", F.xxhash64("text").alias("h"))
    unnamed = F.least(F.lit(runs - 1), F.floor((F.lit(float(1 << 63)) - F.col("h")) / float(1 << 64) * runs)).cast("int")
    rows = rows.withColumn("run", F.when(F.col("doc_id").isNull(), -1 - unnamed).otherwise(_run_of(F.col("doc_id"), bounds)))
    heads = rows.groupBy("run").agg(F.max(F.struct("doc_id", "h")).alias("m")).select("run", "m.doc_id", "m.h").collect()  # 2 * MAX_RUNS rows at most
    heads.sort(key=lambda r: -r["run"])
    moves = [(heads[k]["run"], heads[k]["doc_id"], heads[k]["h"], heads[k - 1]["run"]) for k in range(len(heads))]
    marked = spark.createDataFrame(moves, "r int, i long, g long, to int")
    first = rows.join(F.broadcast(marked), (F.col("run") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")))
    halo = first.select("doc_id", "text", "h", F.col("to").alias("run"), F.lit(1).alias("halo")).dropDuplicates(["run"])
    dealt = rows.withColumn("halo", F.lit(0)).unionByName(halo).repartition("run").withColumn("kept", sketch(F.col("text")))
    order = Window.partitionBy("run").orderBy("halo", F.desc_nulls_last("doc_id"), F.desc("h"))
    return dealt.select("doc_id", "text", "kept", "halo", F.lead("text").over(order).alias("next_text"), F.lead("kept").over(order).alias("next_kept")).where("halo = 0").drop("halo")


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = pairs.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))
    done = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "kept", "next_kept", sketch(F.col("edited")).alias("edited_kept"))
    return done.select(
        "doc_id", "n_chars", "edited_sha256", encoded(F.col("kept")).alias("fingerprint"), encoded(F.col("edited_kept")).alias("edited_fingerprint"), likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"), likeness(F.col("kept"), F.col("next_kept")).alias("near_next")
    )
