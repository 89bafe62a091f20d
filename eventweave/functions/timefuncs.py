"""Time columns: parsing, picking, formatting, offsets. Local times are TIMESTAMP_NTZ and count as UTC for epoch values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
#: Fixed value: the text form of camera metadata times.
EXIF = r"^(\d{4}):(\d{2}):(\d{2}) (\d{2}:\d{2}:\d{2})(?:\.(\d+))?(Z|[+-]\d{2}:\d{2})?$"


def epoch_ms(ts: str) -> Column:
    """Milliseconds since 1970 of a zone-less time, cut, without use of the session's zone."""
    return F.expr(f"timestampdiff(MILLISECOND, {EPOCH}, {ts})")


def to_local_ts(text: Column) -> Column:
    """Either of two text forms (blank or 'T' between date and time, optional fraction); anything else is null."""
    clean = F.trim(text)
    ok = clean.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$")
    return F.when(ok, F.try_to_timestamp(F.regexp_replace(clean, "T", " ")).cast("timestamp_ntz"))


def fmt_local_ts(ts: Column) -> Column:
    """With milliseconds only where there is a fraction."""
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))


def parse_exif_ts(text: Column) -> Column:
    """struct(local, fraction, offset, epoch_ms); the fraction is cut to six digits; null where the form does not fit."""
    part = lambda i: F.regexp_extract(text, EXIF, i)
    local = F.try_to_timestamp(F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), part(4))).cast("timestamp_ntz")
    fraction = F.substring(part(5), 1, 6)
    ms = F.try_to_number(F.rpad(F.substring(part(5), 1, 3), 3, "0"), F.lit("999")).cast("long")
    seconds = F.unix_timestamp(local.cast("timestamp"))
    struct = F.struct(local.alias("local"), F.nullif(fraction, F.lit("")).alias("fraction"), F.nullif(part(6), F.lit("")).alias("offset"), (seconds * 1000 + F.coalesce(ms, F.lit(0))).alias("epoch_ms"))
    return F.when(text.rlike(EXIF) & local.isNotNull(), struct)


def pick_capture_time(df: DataFrame, fields: list[str], fallbacks: list[str]) -> DataFrame:
    """capture_time: the first field that parses, then the first fallback (already times); timestamp_source names it; metadata_status
    is ok for a field, partial for a fallback, error without any."""
    got = [F.struct(to_local_ts(F.col(f)).alias("t"), F.lit(f).alias("source"), F.lit("ok").alias("status")) for f in fields]
    got += [F.struct(F.col(f).cast("timestamp_ntz").alias("t"), F.lit(f).alias("source"), F.lit("partial").alias("status")) for f in fallbacks]
    first = F.element_at(F.filter(F.array(*got), lambda x: x["t"].isNotNull()), 1)
    picked = df.withColumn("_p", F.when(F.coalesce(*(x["t"] for x in got)).isNotNull(), first))
    return picked.select(*df.columns, F.col("_p.t").alias("capture_time"), F.coalesce("_p.source", F.lit("placeholder")).alias("timestamp_source"), F.coalesce("_p.status", F.lit("error")).alias("metadata_status"))


def video_times(df: DataFrame, fields: list[str], filename: str = "filename", mtime: str = "mtime", duration: str = "duration_seconds") -> DataFrame:
    """start_local from the first parseable field, else the file name (yyyyMMdd_HHmmss), else mtime; end_local = start + duration;
    error text names what is missing, joined by '; '."""
    stamp = F.regexp_extract(F.col(filename), r"(\d{8})_(\d{6})", 0)
    from_name = F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    start = F.coalesce(*(to_local_ts(F.col(f)) for f in fields), from_name, F.col(mtime).cast("timestamp_ntz"))
    length = F.col(duration).try_cast("double")
    missing = F.array_compact(F.array(F.when(start.isNull(), F.lit("no start")), F.when(length.isNull(), F.lit("no duration"))))
    out = df.withColumn("start_local", start).withColumn("_s", length)
    return out.withColumn("end_local", F.expr("timestampadd(MILLISECOND, cast(round(coalesce(_s, 0) * 1000) as bigint), start_local)")).withColumn("metadata_error", F.array_join(missing, "; ")).drop("_s")


def apply_clock_offset(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """start_synced and end_synced: times moved by the stream's correction_seconds (0 for an unknown stream)."""
    joined = df.join(corrections.select("stream_id", "correction_seconds"), "stream_id", "left").withColumn("correction_seconds", F.coalesce("correction_seconds", F.lit(0.0)))
    move = "timestampadd(MILLISECOND, cast(round(correction_seconds * 1000) as bigint), {})"
    return joined.withColumn("start_synced", F.expr(move.format("start_local"))).withColumn("end_synced", F.expr(move.format("end_local")))


def delta_columns(times: Column) -> tuple[Column, Column]:
    """Whole seconds of each frame from the first and from the previous one, halves to even (times: array of epoch ms)."""
    from_first = F.transform(times, lambda t: F.bround((t - F.element_at(times, 1)) / 1000).cast("long"))
    from_last = F.transform(times, lambda t, i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.bround((t - F.get(times, i - 1)) / 1000).cast("long")))
    return from_first, from_last


def parse_media_filename(name: Column) -> Column:
    """struct(day, time, sequence, width, height, fps) from names such as 20240131_120501_003_1920x1080_30fps.ext; parts may be missing."""
    part = lambda p, i=1: F.nullif(F.regexp_extract(name, p, i), F.lit(""))
    return F.struct(
        part(r"^(\d{8})_").alias("day"), part(r"^\d{8}_(\d{6})").alias("time"), part(r"^\d{8}_\d{6}_(\d{1,6})(?:[_.]|$)").try_cast("int").alias("sequence"), part(r"_(\d+)x\d+").try_cast("int").alias("width"), part(r"_\d+x(\d+)").try_cast("int").alias("height"),
        part(r"_(\d+(?:\.\d+)?)fps").try_cast("double").alias("fps"),
    )
