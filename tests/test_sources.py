"""Readers, writers and incremental forms on small files."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from eventweave.operators import images, timeline
from eventweave.operators.transcripts import announcement_candidates, transcript_to_clip
from eventweave.sources import tables
from eventweave.streaming import incremental


def test_manifest(spark, tmp_path):
    names = [x.split()[0] for x in tables.MANIFEST.split(", ")]
    row = dict.fromkeys(names, "") | {"day": "d", "stream_id": "p-1", "media_type": "photo", "relative_path": "a.jpg", "photo_id": "a", "start_epoch_ms": "5"}
    for name, change in (("good", {}), ("bad", {"photo_id": ""}), ("odd", {"media_type": "song"})):
        (tmp_path / f"{name}.csv").write_text(",".join(names) + "\n" + ",".join((row | change)[n] for n in names) + "\n")
    assert tables.read_manifest(spark, [str(tmp_path / "good.csv")]).first()["start_epoch_ms"] == 5
    for name, said in (("bad", "photo_id is missing"), ("odd", "unknown media type")):
        with pytest.raises(Exception, match=said):
            tables.read_manifest(spark, [str(tmp_path / f"{name}.csv")]).collect()


def test_stream_tables(spark, tmp_path):
    (tmp_path / "p-1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "p-2.csv").write_text("a,c\n3,4\n")
    (tmp_path / "v-1.csv").write_text("a\n5\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("p-1", "p-2", "v-1")]
    out = tables.read_stream_tables(spark, paths, "photo")
    assert sorted((r["a"], r["b"], r["c"]) for r in out.collect()) == [("1", "2", None), ("3", None, "4")]
    with pytest.raises(ValueError, match="no stream"):
        tables.read_stream_tables(spark, paths, "photo", ["p-9"])


def test_discover_and_stream_files(spark, tmp_path):
    root = tmp_path / "root"
    for f in ("p-cam/a.JPG", "v-cam/b.mp4", "p-cam/_workspace/c.jpg", "p-cam/d.txt"):
        (root / f).parent.mkdir(parents=True, exist_ok=True)
        (root / f).write_bytes(b"xyz")
    got = {(r["relative_path"], r["stream_id"], r["device"], r["media_type"]) for r in tables.discover_media(spark, str(root)).collect()}
    assert got == {("p-cam/a.JPG", "p-cam", "cam", "photo"), ("v-cam/b.mp4", "v-cam", "cam", "video")}
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for more in (None, "p-cam/e.jpg"):
        if more:
            (root / more).write_bytes(b"1")
        incremental.manifest_stream(spark, str(root), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 4  # Spark leaves names with a leading underscore out


def test_transcripts(spark, tmp_path):
    d = tmp_path / "v-1"
    d.mkdir()
    seg = [{"start": 1.5, "end": 3, "text": " numer 7 "}, {"start": "x", "end": 2, "text": "bad"}, {"start": 4, "end": 5, "text": " "}]
    (d / "clip1.json").write_text(json.dumps({"language": "pl", "segments": seg}))
    (d / "clip2.json").write_text("{broken")
    rows = tables.read_transcripts(spark, str(tmp_path / "*" / "*.json"))
    assert [(r["stream_id"], r["clip_stem"], r["segment_index"], r["text"]) for r in rows.collect()] == [("v-1", "clip1", 1, "numer 7")]
    clips = spark.createDataFrame([("v-1", "x/clip1.MP4", 10_000)], "stream_id string, filename string, start_ms long")
    assert transcript_to_clip(rows, clips).first()["segment_start_ms"] == 11_500


def test_review_index_round_trip(spark, tmp_path):
    doc = {"day": "d", "performances": [{"set_id": "s", "photos": [{"photo_id": "a", "filename": "a.jpg", "relative_path": "p/a.jpg", "start_epoch_ms": 1}]}]}
    (tmp_path / "i.json").write_text(json.dumps(doc, indent=1))
    rows = tables.read_review_index(spark, str(tmp_path / "i.json"))
    assert rows.first()["display_name"] == "s" and rows.first()["review"] is False
    tables.export_review_index(rows, str(tmp_path / "out"))
    again = spark.read.schema(tables.REVIEW_INDEX).json(str(tmp_path / "out")).first()
    assert again["performances"][0]["photos"][0]["photo_id"] == "a"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "run_id string, x int")
    tables.write_table(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(df, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing"):
        tables.write_table(df.limit(0), str(tmp_path / "u"))
    for _ in range(2):
        tables.append_results(df, str(tmp_path / "r"), ["run_id", "x"])
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2
    with pytest.raises(Exception, match="bad vector"):
        tables.read_embeddings(spark.createDataFrame([("a", [0.0])], "relative_path string, embedding array<double>")).collect()
    assert incremental.pending(df, df.limit(0), ["run_id"]).count() == 1 and incremental.pending(df, df, ["run_id"]).count() == 0


def test_announcement_stream_equals_batch(spark, tmp_path):
    segments = spark.createDataFrame([("v-1", "c", 1.0, 2.0, "numer sto dwa"), ("v-1", "c", 3.0, 4.0, "nic")], "stream_id string, clip_stem string, start_s double, end_s double, text string")
    clips = spark.createDataFrame([("v-1", "c.mp4", 0)], "stream_id string, filename string, start_ms long")
    segments.write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(segments.schema).parquet(str(tmp_path / "in"))
    q = incremental.announcement_stream(live, clips).select("performance_number", "segment_start_ms").writeStream.format("memory").queryName("ann").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = announcement_candidates(transcript_to_clip(segments, clips)).select("performance_number", "segment_start_ms").collect()
    assert spark.table("ann").collect() == want


def test_live_groups_equal_batch(spark, tmp_path):
    rows = [("d", i, n, "v-1", t, t + 500, 0.5) for i, (n, t) in enumerate([(7, 1000), (7, 6000), (8, 9400), (7, 11000), (7, 31000), (9, 32000)])]
    schema = "day_id string, id long, number long, stream_id string, start_ms long, end_ms long, confidence double"
    df = spark.createDataFrame(rows, schema)
    for k, part in enumerate((df.where("start_ms < 9500"), df.where("start_ms >= 9500"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/p{k}"))
    live = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    q = incremental.live_groups(live).writeStream.format("memory").queryName("grp").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["group_index"], r["number"], r["candidate_count"]) for r in spark.table("grp").collect())
    want = sorted((r["group_index"], r["number"], r["candidate_count"]) for r in timeline.merge_candidates(df).collect())
    assert got == want[:-1]  # the last group is still open: nothing later has come


def test_live_groups_close_by_watermark(spark, tmp_path):
    """A later day moves the watermark, which closes the last group of the day before; late and replayed rows are counted, not merged."""
    schema = "day_id string, id long, number long, stream_id string, start_ms long, end_ms long, confidence double"
    first = [("d", i, 7, "v-1", 1000 * i, 1000 * i + 500, 0.5) for i in (1, 5, 9)]
    again = [first[2], ("d", 90, 8, "v-1", 4000, 4500, 0.9), ("d", 10, 7, "v-1", 12_000, 12_500, 0.7)]
    later = [("e", 11, 1, "v-1", 90_000, 90_500, 0.5)]
    last = [("e", 12, 1, "v-1", 200_000, 200_500, 0.5), ("d", 13, 7, "v-1", 13_000, 13_500, 0.5)]
    for k, part in enumerate((first, again, later, last)):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/p{k}"))
    for k in range(4):  # one file after the other
        live = spark.readStream.schema(schema).parquet(str(tmp_path / f"in/p[0-{k}]"))
        q = incremental.live_groups(live, 12, 20).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted((r["day_id"], r["group_index"], r["number"], r["start_ms"], r["end_ms"], r["candidate_count"], r["confidence"], r["late_rows"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("d", 1, 7, 1000, 12_500, 4, 0.7, 2), ("e", 1, 1, 90_000, 90_500, 1, 0.5, 0)]


def test_broken_file_is_set_aside(spark, tmp_path):
    root = tmp_path / "media"
    root.mkdir()
    for name, data in (("a.jpg", b"ok 1"), ("b.jpg", b"broken"), ("c.jpg", b"ok 2")):
        (root / name).write_bytes(data)

    def describe(path, content):
        if content == b"broken":
            raise ValueError("no header")
        return {"n": content.decode().split()[1]}

    for _ in range(2):
        incremental.manifest_stream(spark, str(root), str(tmp_path / "m"), str(tmp_path / "ck"), describe).awaitTermination()
    assert sorted(r["metadata"]["n"] for r in spark.read.parquet(str(tmp_path / "m")).collect()) == ["1", "2"]
    bad = spark.read.parquet(str(tmp_path / "m_quarantine")).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["error"]) for r in bad] == [("b.jpg", "ValueError: no header")]


def test_resumed_runs(spark):
    work = spark.createDataFrame([(i,) for i in range(5)], "candidate int")
    done = spark.createDataFrame([("r1", "h1", 0), ("r1", "h1", 3), ("r2", "h2", 1)], "run_id string, config_hash string, candidate int")
    assert sorted(r[0] for r in incremental.resumed(work, done, "r1", "h1", ["candidate"]).collect()) == [1, 2, 4]
    assert incremental.resumed(work, done, "r3", "h1", ["candidate"]).count() == 5
    with pytest.raises(Exception, match="another configuration: h1"):
        incremental.resumed(work, done, "r1", "h2", ["candidate"]).collect()


def test_stream_tables_by_header(spark, tmp_path):
    """Forty files with three headers are three scans; order has missing values last."""
    for i in range(40):
        header = ("a,t", "t,b", "a,b,t")[i % 3]
        names = header.split(",")
        (tmp_path / f"p-{i}.csv").write_text(header + "\n" + ",".join({"a": f"a{i}", "b": "", "t": "" if i == 5 else f"{i:03}"}[n] for n in names) + "\n")
    (tmp_path / "v-1.csv").write_text("a\nx\n")
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    df = tables.read_stream_tables(spark, paths, "photo", order=["t"])
    rows = df.collect()
    assert len(rows) == 40 and rows[-1]["t"] is None and [r["t"] for r in rows[:39]] == [f"{i:03}" for i in range(40) if i != 5]
    assert {r["a"] for r in rows} == {None} | {f"a{i}" for i in range(40) if i % 3 != 1} and all(r["source_file"].endswith(".csv") for r in rows)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3


def test_image_quality(spark, tmp_path):
    ppm = tmp_path / "a"
    ppm.mkdir()
    import struct
    import zlib as z

    def png(path, w, h, rgb):
        raw = b"".join(b"\0" + bytes(rgb) * w for _ in range(h))
        chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", z.crc32(t + d))
        path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", z.compress(raw)) + chunk(b"IEND", b""))

    png(ppm / "dark.png", 8, 6, (10, 10, 10))
    png(ppm / "light.png", 8, 6, (255, 255, 255))
    df = spark.read.format("image").load(str(ppm)).select(F.regexp_extract("image.origin", r"([^/]+)$", 1).alias("key"), "image")
    got = {r["key"]: (r["flag_dark"], r["flag_overexposed"], r["flag_blurry"]) for r in images.image_quality(df).collect()}
    assert got == {"dark.png": (1, 0, 1), "light.png": (0, 1, 1)}


def test_no_llm_import():
    here = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "eventweave")
    for d, _, names in os.walk(here):
        if "llm" not in d.split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    assert "eventweave.llm" not in open(os.path.join(d, n)).read(), n


def test_measures_of_images():
    import numpy as np

    gray = np.array([[0.0, 0.5, 1.0], [0.0, 0.5, 1.0], [0.02, 0.5, 0.98]])
    focus, blur, *_, bright, dark = images.measure(gray)
    wide = np.pad(gray, 1, mode="edge")
    lap = wide[:-2, 1:-1] + wide[2:, 1:-1] + wide[1:-1, :-2] + wide[1:-1, 2:] - 4 * gray
    assert abs(focus - lap.var()) < 1e-12 and abs(blur - np.abs(np.diff(gray, axis=0)).mean() / np.abs(np.diff(gray, axis=1)).mean()) < 1e-12
    assert (bright, dark) == (3 / 9, 3 / 9)


def test_replayed_batch_is_written_once(spark, tmp_path):
    root = tmp_path / "m" / "p-1"
    root.mkdir(parents=True)
    (root / "a.jpg").write_bytes(b"x")
    out, mark = str(tmp_path / "out"), tmp_path / "mark"
    for _ in range(2):
        incremental.manifest_stream(spark, str(tmp_path / "m"), out, str(mark)).awaitTermination()
        for f in (mark / "commits").glob("*0*"):  # the commit is lost, so the batch runs again
            f.unlink()
    assert spark.read.parquet(out).count() == 1
