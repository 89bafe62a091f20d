"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions.vectors import finite, norm

MANIFEST = "day string, stream_id string, device string, media_type string, path string, relative_path string, media_id string, photo_id string, filename string, extension string, capture_time_local timestamp_ntz, capture_subsec string, photo_order_index int, start_local timestamp_ntz, end_local timestamp_ntz, start_epoch_ms bigint, end_epoch_ms bigint, duration_seconds double, timestamp_source string, width int, height int, fps double, actual_size_bytes bigint, metadata_status string, metadata_error string"
#: Columns that must have a value, by media type.
REQUIRED = {"photo": ("day", "stream_id", "relative_path", "photo_id", "start_epoch_ms"), "video": ("day", "stream_id", "relative_path", "start_local", "end_local")}
PHOTO_EXTENSIONS, VIDEO_EXTENSIONS = ("jpg", "jpeg", "arw", "cr3", "hif", "heic", "png"), ("mp4", "mov", "mts", "mxf")
TRANSCRIPT = "language string, segments array<struct<start:string,end:string,text:string,words:array<struct<word:string,score:double>>>>"


def read_manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The manifest from CSV, blank as null. Rows of an unknown media type or without a required value are an error when read."""
    df = spark.read.schema(MANIFEST).option("header", True).option("nullValue", "").csv(paths)
    missing = F.coalesce(*(F.when((F.col("media_type") == k) & F.col(c).isNull(), F.concat(F.lit(f"{c} is missing: "), F.coalesce("path", F.lit("?")))) for k, cols in REQUIRED.items() for c in cols))
    problem = F.coalesce(F.when(~F.coalesce(F.col("media_type").isin(*REQUIRED), F.lit(False)), F.concat(F.lit("unknown media type: "), F.coalesce("media_type", F.lit("null")))), missing)
    return df.withColumn("media_type", F.when(problem.isNotNull(), F.raise_error(problem).cast("string")).otherwise(F.col("media_type")))


def read_stream_tables(spark: SparkSession, paths: list[str], media_type: str | None = None, targets: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """CSV tables of streams (``p-*`` photos, ``v-*`` videos), padded to one set of columns (texts), with the file each row came from.

    One scan for each header that occurs, however many files there are. order: columns to sort by, missing values last. Blank cells are
    null; a file without a header line has no rows."""
    prefix = {"photo": "p-", "video": "v-"}.get(media_type or "", "")
    names = [(p, p.rsplit("/", 1)[-1].removesuffix(".csv")) for p in paths]
    chosen = [p for p, n in names if n.startswith(prefix) and (not targets or n in targets)]
    if not chosen:
        raise ValueError("no stream table is selected")
    out = None
    for header, own in sorted(_by_header(spark, chosen).items()):
        names_ = header.split(",")
        schema = ", ".join(f"`{n}` string" for n in names_)
        part = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(own).withColumn("source_file", F.input_file_name())
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if order:
        out = out.orderBy(*(F.asc_nulls_last(c) for c in order))
    return out


def _by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each header line. One job reads the first block's first line of every file; the driver gets a line a file."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("i"))
    first = lines.where("at = 0").groupBy("path").agg(F.min_by("value", "i").alias("header")).collect()
    out: dict[str, list[str]] = {}
    for r in first:
        out.setdefault(r["header"].strip("\ufeff\r").replace('"', ""), []).append(r["path"])
    return out


def discover_media(spark: SparkSession, root: str) -> DataFrame:
    """Media files under root/<stream>/...: stream, device, type by extension, path relative to root, size; ``_workspace`` is left out. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("actual_size_bytes"), F.col("modificationTime").alias("mtime"))
    clean = F.regexp_replace("path", r"^file:/+", "/")
    rel = F.expr("substring(p, length(r) + 2)")
    out = files.withColumn("p", clean).withColumn("r", F.lit("/" + root.split(":", 1)[-1].strip("/"))).withColumn("relative_path", rel)
    ext = F.lower(F.regexp_extract("relative_path", r"\.([^.]+)$", 1))
    kind = F.when(ext.isin(*PHOTO_EXTENSIONS), "photo").when(ext.isin(*VIDEO_EXTENSIONS), "video")
    stream = F.regexp_extract("relative_path", r"^([^/]+)/", 1)
    return out.select("relative_path", stream.alias("stream_id"), F.regexp_replace(stream, "^[pv]-", "").alias("device"), kind.alias("media_type"), "actual_size_bytes", "mtime").where("media_type is not null and not relative_path like '%_workspace%'")


def read_embeddings(vectors: DataFrame, key: str = "relative_path", vector: str = "embedding", width: int | None = None) -> DataFrame:
    """Vectors by key; empty, zero and non-finite ones, and those of another width than the given one, are an error."""
    ok = (F.size(vector) > 0) & finite(F.col(vector)) & (norm(F.col(vector)) > 0)
    if width is not None:
        ok &= F.size(vector) == width
    message = F.raise_error(F.concat(F.lit("bad vector: "), F.col(key).cast("string"))).cast(vectors.schema[vector].dataType)
    return vectors.withColumn(vector, F.when(F.coalesce(ok, F.lit(False)), F.col(vector)).otherwise(message))


def align_embeddings(vectors: DataFrame, index: DataFrame, key: str = "relative_path") -> DataFrame:
    """key, row_index, embedding: vectors (row_index, embedding) with the index (row_index, key) of their places. A place that only one of
    both has, that either has twice, a blank key, and places that don't run from 0 on without a gap, are an error that names the place."""
    rows = index.groupBy("row_index").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("_n"))
    found = vectors.groupBy("row_index").agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("_m"))
    whole = vectors.agg(F.max("row_index").alias("_last"), F.count_distinct("row_index").alias("_all")).first()
    both = rows.join(found, "row_index", "full_outer")
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    gap = (F.col("row_index") < 0) | F.lit(whole["_last"] is not None and whole["_last"] + 1 != whole["_all"])
    bad = F.when(F.col("row_index").isNull() | gap, "gap").when(F.col("_n").isNull(), "not in the index").when(F.col("_m").isNull(), "no vector")
    bad = bad.when((F.col("_n") > 1) | (F.col("_m") > 1), "doubled").when(blank, "blank key")
    error = F.raise_error(F.concat(F.lit("row "), F.coalesce(F.col("row_index").cast("string"), F.lit("?")), F.lit(": "), bad)).cast(index.schema[key].dataType)
    return read_embeddings(both.select(F.when(bad.isNotNull(), error).otherwise(F.col(key)).alias(key), "row_index", "embedding"), key)


def read_transcripts(spark: SparkSession, glob: str) -> DataFrame:
    """One row per segment (index from 1) of the JSON files <stream>/<clip>.json; blank texts and bad numbers are dropped, corrupt files skipped."""
    raw = spark.read.text(glob, wholetext=True).withColumn("p", F.input_file_name())
    doc = raw.select(F.regexp_extract("p", r"([^/]+)/[^/]+$", 1).alias("stream_id"), F.regexp_extract("p", r"([^/]+)\.[^./]+$", 1).alias("clip_stem"), F.from_json("value", TRANSCRIPT).alias("d"))
    rows = doc.select("stream_id", "clip_stem", F.col("d.language").alias("language"), F.posexplode("d.segments").alias("i", "s"))
    out = rows.select("stream_id", "clip_stem", "language", (F.col("i") + 1).alias("segment_index"), F.col("s.start").try_cast("double").alias("start_s"), F.col("s.end").try_cast("double").alias("end_s"), F.trim("s.text").alias("text"), F.col("s.words").alias("words"))
    return out.where("start_s is not null and end_s is not null and text <> ''")


def read_descriptor_json(spark: SparkSession, glob: str) -> DataFrame:
    """relative_path and the JSON text of ``data`` of each descriptor file."""
    return spark.read.text(glob, wholetext=True).select(F.get_json_object("value", "$.relative_path").alias("relative_path"), F.get_json_object("value", "$.schema_version").alias("schema_version"), F.get_json_object("value", "$.data").alias("data")).where("relative_path is not null")


REVIEW_INDEX = "day string, performances array<struct<set_id:string,display_name:string,segment_type:string,photos:array<struct<photo_id:string,filename:string,relative_path:string,start_epoch_ms:bigint,review:boolean>>>>"


def read_review_index(spark: SparkSession, path: str) -> DataFrame:
    """Flat photo rows of the nested review index, with the set's defaults (display name: its id; review: false)."""
    sets = spark.read.schema(REVIEW_INDEX).option("multiLine", True).json(path).select(F.col("day").alias("day_id"), F.explode("performances").alias("s"))
    rows = sets.select("day_id", F.col("s.set_id").alias("set_id"), F.coalesce("s.display_name", "s.set_id").alias("display_name"), F.col("s.segment_type").alias("segment_type"), F.posexplode("s.photos").alias("pos", "p"))
    return rows.select("day_id", "set_id", "display_name", "segment_type", "pos", "p.photo_id", "p.filename", "p.relative_path", "p.start_epoch_ms", F.coalesce("p.review", F.lit(False)).alias("review"))


def export_review_index(photos: DataFrame, path: str) -> None:
    """One JSON document per day with its sets and their photos in order; a day is bounded by what one event makes."""
    item = F.struct("pos", "photo_id", "filename", "relative_path", "start_epoch_ms", "review")
    sets = photos.groupBy("day_id", "set_id", "display_name", "segment_type").agg(F.array_sort(F.collect_list(item)).alias("photos"))
    days = sets.groupBy(F.col("day_id").alias("day")).agg(F.array_sort(F.collect_list(F.struct("set_id", "display_name", "segment_type", "photos"))).alias("performances"))
    days.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, overwrite: bool = False, partition: str | None = None, fmt: str = "parquet") -> None:
    """A whole table; an existing one is an error unless overwrite; with a partition column only its days are replaced."""
    if df.isEmpty():
        raise ValueError("nothing to write")
    out = df.write.format(fmt).mode("overwrite" if overwrite else "errorifexists")
    if fmt == "csv":
        out = out.option("header", True)
    if partition:
        out = out.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    out.save(path)


def append_results(df: DataFrame, path: str, columns: list[str]) -> None:
    """Appends rows with exactly these columns, by run."""
    if df.columns != columns:
        raise ValueError(f"columns are {df.columns}")
    df.write.mode("append").partitionBy("run_id").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def day_order(df: DataFrame) -> DataFrame:
    """Export order: photos, then videos, by time with missing times last."""
    return df.orderBy((F.col("media_type") != "photo").cast("int"), F.col("start_local").asc_nulls_last(), "relative_path")


def distinct_union(tables: list[DataFrame], key: str) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.dropDuplicates([key])
