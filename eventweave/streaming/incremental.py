"""Incremental forms: skip what is done, files as streams, live announcements."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from eventweave.operators.transcripts import announcement_candidates, transcript_to_clip


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What no finished row has the keys of (descriptors by path and schema version, probes by config hash and candidate)."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def resumed(work: DataFrame, done: DataFrame, run_id: str, config_hash: str, keys: list[str]) -> DataFrame:
    """What the run has still to do. Results of the run under another configuration are an error, as it may only go on unchanged."""
    own = done.where(F.col("run_id") == run_id)
    other = own.where(~F.col("config_hash").eqNullSafe(config_hash)).agg(F.count(F.lit(1)).alias("n"), F.min("config_hash").alias("found"))
    said = F.concat(F.lit(f"run {run_id} has results of another configuration: "), F.coalesce("found", F.lit("none")))
    checked = other.select(F.when(F.col("n") > 0, F.raise_error(said).cast("int")).otherwise(F.lit(0)).alias("_c"))
    return pending(work, own, keys).where(checked.scalar() == 0)


def manifest_stream(spark: SparkSession, root: str, out: str, checkpoint: str, describe: Callable[[str, bytes], dict[str, str]] | None = None) -> StreamingQuery:
    """New media files go to the manifest table once each: every micro-batch writes a partition of its own (batch_id) and overwrites it
    when it is replayed; a restart goes on from the checkpoint.

    describe(path, content), if given, runs in the tasks and gives the metadata of a file (map column ``metadata``). A file on which it
    fails never blocks its batch: it goes to ``out``_quarantine with the error, and the others are written."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(root)
    columns = ["path", "length", "modificationTime"]

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found, errors = [], []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    found.append({k: str(v) for k, v in describe(path, content).items()})
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  whatever it is, the file is set aside with it
                    found.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pdf[columns].assign(metadata=found, error=errors)

    def merge(batch: DataFrame, batch_id: int) -> None:
        at = f"batch_id={batch_id}"
        if describe is None:
            batch.select(*columns).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{at}")
            return
        kept = "path string, length bigint, modificationTime timestamp, metadata map<string, string>, error string"
        # files are described once: both tables are cut from the written result
        whole = f"{out.rstrip('/')}_described/{at}"
        batch.mapInPandas(described, kept).write.mode("overwrite").parquet(whole)
        rows = spark.read.parquet(whole)
        rows.where("error is null").drop("error").write.mode("overwrite").parquet(f"{out.rstrip('/')}/{at}")
        rows.where("error is not null").drop("metadata").write.mode("overwrite").parquet(f"{out.rstrip('/')}_quarantine/{at}")

    return files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def announcement_stream(segments: DataFrame, clips: DataFrame) -> DataFrame:
    """Announcement candidates of a stream of segments against a static clip table (append mode, no state)."""
    return announcement_candidates(transcript_to_clip(segments, clips))


class Merger(StatefulProcessor):
    """Groups the candidates of one day as they come in order: the open group and the last row are the only state. A row with the group's
    number that starts at most ``gap_ms`` after its last start joins it; anything else closes it. So does the watermark, once it has
    passed the last time at which a row could join.

    Rows that do not come after the last one (late, or replayed) are not merged but counted; each closed group tells how many the day has
    had until then."""

    STATE = "group_index long, number long, start_ms long, last_ms long, end_ms long, n long, confidence double, stream string, id string, late long"
    COLUMNS = ("day_id", "group_index", "number", "start_ms", "end_ms", "candidate_count", "confidence", "late_rows")

    def __init__(self, gap_ms: int) -> None:
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", self.STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        got = dict(zip(self._names(), self.open.get(), strict=True)) if self.open.exists() else None
        if got is not None and got["n"]:
            self.handle.deleteTimer(self._closes(got))
        closed = []
        for r in pd.concat(list(rows)).sort_values(["start_ms", "number", "stream_id", "id"]).itertuples():
            if got is not None and (int(r.start_ms), int(r.number), str(r.stream_id), f"{r.id:>20}") <= (got["last_ms"], got["number"], got["stream"], got["id"]):
                got["late"] += 1
                continue
            last = {"last_ms": int(r.start_ms), "stream": str(r.stream_id), "id": f"{r.id:>20}"}
            if got is not None and got["n"] and r.number == got["number"] and r.start_ms - got["last_ms"] <= self.gap_ms:
                got |= last | {"end_ms": max(got["end_ms"], int(r.end_ms)), "n": got["n"] + 1, "confidence": max(got["confidence"], float(r.confidence))}
                continue
            if got is not None and got["n"]:
                closed.append(self._row(key, got))
            index, late = (got["group_index"], got["late"]) if got is not None else (0, 0)
            got = {"group_index": index + 1, "number": int(r.number), "start_ms": int(r.start_ms), "end_ms": int(r.end_ms), "n": 1, "confidence": float(r.confidence), "late": late} | last
        if got is not None:
            self.open.update(tuple(got[n] for n in self._names()))
            if got["n"]:
                self.handle.registerTimer(self._closes(got))
        yield pd.DataFrame(closed, columns=self.COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        got = dict(zip(self._names(), self.open.get(), strict=True)) if self.open.exists() else None
        closed = []
        if got is not None and got["n"] and self._closes(got) <= expiredTimerInfo.getExpiryTimeInMs():
            closed.append(self._row(key, got))
            self.open.update(tuple((got | {"n": 0})[n] for n in self._names()))  # the last row stays, so that replays are known
        yield pd.DataFrame(closed, columns=self.COLUMNS)

    def close(self) -> None:
        pass

    def _names(self) -> list[str]:
        return [c.split(" ")[0] for c in self.STATE.split(", ")]

    def _closes(self, got: dict) -> int:
        return got["last_ms"] + self.gap_ms + 1

    def _row(self, key, got: dict) -> tuple:
        return (key[0], *(got[c] for c in ("group_index", "number", "start_ms", "end_ms", "n", "confidence", "late")))


def live_groups(candidates: DataFrame, gap_s: float = 12, lateness_s: float = 60) -> DataFrame:
    """Closed groups of a stream of candidates, keyed by day: closed by a row that does not join, or when the watermark (the latest start
    seen less ``lateness_s``) has passed the gap after the last one. Rows behind the watermark are dropped by the engine, which counts
    them (numRowsDroppedByWatermark); rows out of order before it are counted in late_rows."""
    timed = candidates.withColumn("event_time", F.timestamp_millis("start_ms")).withWatermark("event_time", f"{lateness_s} seconds")
    schema = "day_id string, group_index long, number long, start_ms long, end_ms long, candidate_count long, confidence double, late_rows long"
    return timed.groupBy("day_id").transformWithStateInPandas(Merger(int(gap_s * 1000)), schema, "Append", "EventTime")
