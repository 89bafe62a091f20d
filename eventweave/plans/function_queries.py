"""Queries of the scalar functions, look-ups, reviews and rules over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.functions import jsonfuncs, textfuncs, timefuncs, vectors
from eventweave.operators import boundaries, dataset, metrics, order, results, review, transcripts, validate
from eventweave.plans import views as V
from eventweave.plans.registry import query
from eventweave.streaming import incremental

def this() -> Column:
    """The id of an event, from which the rows of these queries are made."""
    return F.col("event_id")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return V.read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query(
    """SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN lpad((event_id % 1000)::VARCHAR, 3, '0') END AS fraction, CASE WHEN event_id % 17 <> 0 AND event_id % 3 < 2 THEN ['Z', '+02:00'][event_id % 3 + 1] END AS zone,
  CASE WHEN event_id % 17 <> 0 THEN epoch_us(date_trunc('second', ts)) // 1000 + event_id % 1000 END AS epoch_ms FROM events"""
)
def exif_times(spark: SparkSession, sf: str) -> DataFrame:
    zone = F.when(this() % 3 == 0, "Z").when(this() % 3 == 1, "+02:00").otherwise("")
    text = F.when(this() % 17 == 0, "no time").otherwise(F.concat(F.date_format("ts", "yyyy:MM:dd HH:mm:ss"), F.lit("."), F.lpad((this() % 1000).cast("string"), 3, "0"), zone))
    parsed = events(spark, sf).withColumn("x", timefuncs.parse_exif_ts(text))
    return parsed.select("event_id", "x.fraction", F.col("x.offset").alias("zone"), "x.epoch_ms")


CAPTURE = """x AS (SELECT event_id, CASE WHEN event_id % 5 > 1 THEN ts WHEN event_id % 5 = 1 AND event_id % 2 = 0 THEN ts + INTERVAL 1 HOUR WHEN event_id % 7 > 0 THEN ts + INTERVAL 1 DAY END AS t,
  CASE WHEN event_id % 5 > 1 THEN 'taken' WHEN event_id % 5 = 1 AND event_id % 2 = 0 THEN 'made' WHEN event_id % 7 > 0 THEN 'mtime' ELSE 'placeholder' END AS timestamp_source FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events))"""


@query(f"WITH {CAPTURE} SELECT event_id, epoch_us(t) // 1000 AS capture_ms, timestamp_source, CASE timestamp_source WHEN 'mtime' THEN 'partial' WHEN 'placeholder' THEN 'error' ELSE 'ok' END AS metadata_status FROM x")
def capture_times(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda hours: F.date_format(F.expr(f"date_trunc('second', ts) + INTERVAL {hours} HOUR"), "yyyy-MM-dd HH:mm:ss")
    fields = {"taken": F.when(this() % 5 > 1, text(0)).otherwise("?"), "made": F.when((this() % 5 == 1) & (this() % 2 == 0), text(1)), "mtime": F.when(this() % 7 > 0, F.expr("date_trunc('second', ts) + INTERVAL 24 HOUR"))}
    out = timefuncs.pick_capture_time(events(spark, sf).withColumns(fields), ["taken", "made"], ["mtime"])
    return out.select("event_id", timefuncs.epoch_ms("capture_time").alias("capture_ms"), "timestamp_source", "metadata_status")


@query(
    """WITH x AS (SELECT event_id, value, date_trunc('second', ts) AS t FROM events), y AS (SELECT *, CASE WHEN event_id % 4 = 0 THEN t + INTERVAL 1 HOUR WHEN event_id % 4 = 1 THEN t WHEN event_id % 4 = 2 THEN t + INTERVAL 1 DAY END AS s,
  CASE WHEN event_id % 6 > 0 THEN floor(value) END AS d FROM x)
SELECT event_id, epoch_us(s) // 1000 AS start_ms, epoch_us(s) // 1000 + (coalesce(d, 0) * 1000)::BIGINT AS end_ms, concat_ws('; ', CASE WHEN s IS NULL THEN 'no start' END, CASE WHEN d IS NULL THEN 'no duration' END) AS metadata_error FROM y"""
)
def video_times(spark: SparkSession, sf: str) -> DataFrame:
    at = F.expr("date_trunc('second', ts)")
    made = {
        "created": F.when(this() % 4 == 0, F.date_format(at + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss")), "filename": F.when(this() % 4 == 1, F.concat(F.lit("v_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit(".mp4"))).otherwise("v.mp4"),
        "mtime": F.when(this() % 4 == 2, at + F.expr("INTERVAL 24 HOUR")), "duration_seconds": F.when(this() % 6 > 0, F.floor("value").cast("string")).otherwise("x"),
    }
    out = timefuncs.video_times(events(spark, sf).withColumns(made), ["created"])
    return out.select("event_id", timefuncs.epoch_ms("start_local").alias("start_ms"), timefuncs.epoch_ms("end_local").alias("end_ms"), "metadata_error")


@query(
    """WITH w AS (SELECT conv_id, turn, text, list_filter(str_split(text, ' '), lambda x: (length(x) % 10) / 10.0 >= 0.4 OR regexp_matches(x, '[0-9]') OR lower(x) IN ('the', 'is')) AS kept FROM conversations)
SELECT conv_id, turn, CASE WHEN coalesce(array_to_string(kept, ' '), '') = '' THEN text ELSE array_to_string(kept, ' ') END AS kept FROM w"""
)
def filtered_words(spark: SparkSession, sf: str) -> DataFrame:
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("word"), (F.length(w) % 10 / 10).alias("score")))
    return V.turns(spark, sf).select("conv_id", "turn", textfuncs.filter_words_by_score(words, F.col("text"), 0.4, ["the", "is"]).alias("kept"))


@query(
    """WITH w AS (SELECT conv_id, turn, str_split(lower(text), ' ') AS w FROM conversations), t AS (SELECT *, list_filter(['is', 'was'], lambda x: list_contains(w, x)) AS a, list_filter(['in', 'on'], lambda x: list_contains(w, x)) AS b FROM w)
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN len(a) > 0 THEN 'being' END, CASE WHEN len(b) > 0 THEN 'place' END], lambda x: x IS NOT NULL), ',') AS types, array_to_string(list_sort(list_concat(a, b)), ',') AS terms FROM t WHERE w IS NOT NULL"""
)
def trigger_terms(spark: SparkSession, sf: str) -> DataFrame:
    names, terms = textfuncs.trigger_types(F.lower("text"), {"being": ["is", "was"], "place": ["in", "on"]})
    return V.turns(spark, sf).where("text is not null").select("conv_id", "turn", F.array_join(names, ",").alias("types"), F.array_join(terms, ",").alias("terms"))


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 AND event_id % 1500 < 1000 THEN (event_id % 1500)::INT END AS number FROM events")
def explicit_numbers(spark: SparkSession, sf: str) -> DataFrame:
    n = (this() % 1500).cast("string")
    text = F.when(this() % 3 == 0, F.concat(F.lit("teraz Numer startowy "), n)).when(this() % 3 == 1, F.concat(F.lit("NR "), n, F.lit("."))).otherwise(F.concat(F.lit("number "), n))
    return events(spark, sf).select("event_id", textfuncs.explicit_number(text).alias("number"))


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """A detection for each event: an announcement for views and clicks, a number that is too large for every fourth, blank titles."""
    kind = F.when(F.col("event_type").isin("view", "click"), " Announcement ").when(F.col("event_type") == "signup", "award").otherwise("song")
    evidence = F.when(this() % 4 == 0, F.concat(F.lit("numer "), (this() % 700 + 1).cast("string"))).when(this() % 4 == 1, " ").otherwise("oklaski dla nich")
    fields = [kind.alias("event_type"), F.when(this() % 4 < 2, "5000").when(this() % 4 == 2, (this() % 900 + 1).cast("string")).alias("start_number"), F.lit("2").alias("category_ordinal"), F.lit(" ").alias("title"), evidence.alias("evidence"), F.lit(None).cast("string").alias("notes"), F.lit(0.5).alias("confidence")]
    return events(spark, sf).select("event_id", F.struct(*fields).alias("d"))


DETECTIONS = """k AS (SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'announcement' WHEN event_type = 'signup' THEN 'award' ELSE 'other' END AS event_type, event_id % 4 AS m FROM events),
d AS (SELECT *, CASE WHEN event_type <> 'announcement' THEN NULL WHEN m = 2 THEN (event_id % 900 + 1)::INT WHEN m = 0 THEN (event_id % 700 + 1)::INT END AS start_number, CASE m WHEN 0 THEN 'numer ' || (event_id % 700 + 1)::VARCHAR WHEN 1 THEN NULL ELSE 'oklaski dla nich' END AS evidence FROM k)"""


@query(f"WITH {DETECTIONS} SELECT event_id, event_type, start_number, evidence, NULL::VARCHAR AS title, ((evidence IS NULL AND start_number IS NULL) OR (event_type = 'announcement' AND start_number IS NULL AND evidence LIKE '%oklaski%')) IS TRUE AS junk FROM d")
def normalized_detections(spark: SparkSession, sf: str) -> DataFrame:
    out = detections(spark, sf).withColumn("x", jsonfuncs.normalize_detection(F.col("d")))
    return out.select("event_id", "x.event_type", "x.start_number", "x.evidence", "x.title", F.coalesce(jsonfuncs.is_junk(F.col("x"), ["oklaski"]), F.lit(False)).alias("junk"))


@query(
    """WITH m AS (SELECT event_id, event_id % 8 AS m, 'f' || event_id::VARCHAR AS f FROM events)
SELECT event_id, CASE m WHEN 0 THEN 'no_cut' WHEN 1 THEN 'cut_after_1' ELSE 'invalid_response' END AS decision, CASE WHEN m < 2 THEN 'ok' ELSE 'invalid_response' END AS response_status,
  CASE WHEN m < 2 THEN 'Group A segment type: dance | Group B segment type: ceremony | Frame notes: ' || f || 'a(group_a)=n; ' || f || 'b(group_b)=n | Primary evidence: e | Summary: s' WHEN m = 2 THEN 'Invalid decision value: maybe' WHEN m = 3 THEN 'Missing frame_notes value for ' || f || 'b'
    WHEN m = 4 THEN 'duplicate frame_id: ' || f || 'a' WHEN m = 5 THEN 'Invalid group for ' || f || 'b: expected group_b, got group_a' WHEN m = 6 THEN 'Missing or invalid group segment type value' ELSE 'JSON parse error' END AS reason FROM m"""
)
def window_responses(spark: SparkSession, sf: str) -> DataFrame:
    m, a, b = this() % 8, F.concat(F.lit("f"), this().cast("string"), F.lit("a")), F.concat(F.lit("f"), this().cast("string"), F.lit("b"))
    note = lambda f, g: F.struct(f.alias("frame_id"), g.alias("group"), F.lit("n").alias("note"))
    second = note(F.when(m == 4, a).otherwise(b), F.when(m == 5, "group_a").otherwise("group_b"))
    notes = F.when(m == 3, F.array(note(a, F.lit("group_a")))).otherwise(F.array(note(a, F.lit("group_a")), second))
    kinds = [F.lit("dance").alias("group_a_segment_type"), F.when(m == 6, "performance").otherwise("ceremony").alias("group_b_segment_type")]
    decision = F.when(m == 0, "same_segment").when(m == 2, "maybe").otherwise("different_segments")
    answer = F.to_json(F.struct(decision.alias("decision"), *kinds, notes.alias("frame_notes"), F.array(F.lit("e"), F.lit(" ")).alias("primary_evidence"), F.lit("s").alias("summary")))
    raw = F.when(m == 7, "no answer").otherwise(F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
    rows = events(spark, sf).select("event_id", raw.alias("raw_response"), F.array(a).alias("group_a_ids"), F.array(b).alias("group_b_ids"))
    return jsonfuncs.parse_window_response(rows).select("event_id", "decision", "response_status", "reason")


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN '{\"id\": ' || event_id::VARCHAR || '}' END AS payload FROM events")
def json_payloads(spark: SparkSession, sf: str) -> DataFrame:
    body = F.concat(F.lit('{"id": '), this().cast("string"), F.lit("}"))
    text = F.when(this() % 3 == 0, F.concat(F.lit("<think>{maybe}</think> so "), body, F.lit(" is it"))).when(this() % 3 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise("nothing")
    return events(spark, sf).select("event_id", jsonfuncs.extract_json_payload(text).alias("payload"))


@query(
    """WITH n AS (SELECT event_id, event_id % 14 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS n FROM events)
SELECT event_id, CASE WHEN event_id % 15 = 0 THEN 'duet_trio' WHEN event_id % 15 = 1 THEN NULL WHEN n = 0 THEN 'no_visible_people' WHEN n = 1 THEN 'solo' WHEN n <= 3 THEN 'duet_trio' WHEN n = 4 THEN 'quartet' WHEN n <= 10 THEN 'small_group' ELSE 'large_group' END AS people FROM n"""
)
def people_counts(spark: SparkSession, sf: str) -> DataFrame:
    number = F.concat((this() % 14).cast("string"), F.when(this() % 2 == 0, "+").otherwise(""))
    text = F.when(this() % 15 == 0, " Duet ").when(this() % 15 == 1, "a crowd").otherwise(number)
    return events(spark, sf).select("event_id", textfuncs.canonical_people_count(text).alias("people"))


@query(
    """SELECT event_id, unnest(['a_b_c', 'a_b_d', 'e', 'k_1']) AS field, unnest(['x' || event_id::VARCHAR, 'y|z', 'p,q', '1']) AS value FROM events"""
)
def flat_descriptors(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit('{"a": {"b": {"c": "x'), this().cast("string"), F.lit('", "d": ["y", "z"]}}, "e": "p,q", "k.1": 1}'))
    flat = V.read(spark, sf, "events").select("event_id", F.explode(jsonfuncs.flatten_descriptors(text)).alias("field", "values"))
    return flat.select("event_id", "field", F.array_join("values", "|").alias("value"))


@query("SELECT event_id, md5('{\"a\":' || (event_id % 5)::VARCHAR || ',\"b\":\"' || event_type || '\"}') AS config FROM events")
def config_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("event_id", textfuncs.config_hash({"b": F.col("event_type"), "a": this() % 5}).alias("config"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'source:/s/' || event_id::VARCHAR WHEN 1 THEN 'relative:r/' || event_id::VARCHAR WHEN 2 THEN 'stream:p-1/f' || event_id::VARCHAR ELSE 'file:f' || event_id::VARCHAR END AS identity FROM events")
def photo_identities(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda head: F.concat(F.lit(head), this().cast("string"))
    m = this() % 4
    out = textfuncs.photo_identity(F.when(m == 0, name("/s/")).otherwise(" "), F.when(m <= 1, name("r/")), F.when(m <= 2, "p-1"), name("f"))
    return events(spark, sf).select("event_id", out.alias("identity"))


@query(
    """WITH x AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'performance' WHEN 1 THEN 'ceremony' ELSE '' END AS a, CASE event_id % 4 WHEN 0 THEN 'Warmup' WHEN 1 THEN ' ' WHEN 2 THEN 'performance' ELSE 'odd' END AS b FROM events)
SELECT event_id, CASE WHEN trim(b) = '' THEN a ELSE b END AS effective, CASE WHEN a = b THEN a WHEN a = '' THEN b WHEN b = '' THEN a ELSE '' END AS merged, CASE lower(trim(b)) WHEN 'warmup' THEN 'W' WHEN 'performance' THEN 'P' ELSE '?' END AS code FROM x"""
)
def segment_types(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.when(this() % 3 == 0, "performance").when(this() % 3 == 1, "ceremony").otherwise(""), F.when(this() % 4 == 0, "Warmup").when(this() % 4 == 1, " ").when(this() % 4 == 2, "performance").otherwise("odd")
    return events(spark, sf).select("event_id", textfuncs.effective_type(a, b).alias("effective"), textfuncs.merged_type(a, b).alias("merged"), textfuncs.type_code(b).alias("code"))


@query(
    """WITH x AS (SELECT event_id, (event_id % 20) / 10000.0::DOUBLE AS f, (event_id % 50) / 50.0::DOUBLE AS b, (event_id % 30) / 1000.0::DOUBLE AS c FROM events)
SELECT event_id, (f < 0.0005)::INT AS flag_blurry, (b < 0.2)::INT AS flag_dark, (b >= 0.98 OR c >= 0.02)::INT AS flag_overexposed, (b / 2 < 0.08)::INT AS flag_low_contrast, round(1 / (1 + 1000 * f), 6) AS blur_score FROM x"""
)
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    f, b, c = this() % 20 / 10000, this() % 50 / 50, this() % 30 / 1000
    flags = textfuncs.quality_flags(f, b, b, c, b / 2)
    return events(spark, sf).select("event_id", *(F.round(x, 6).alias(n) if n == "blur_score" else x.alias(n) for n, x in flags.items()))


@query("SELECT event_id, CASE WHEN event_id % 6 < 2 THEN 'a/b' || event_id::VARCHAR || '.jpg' END AS path FROM events")
def rel_paths(spark: SparkSession, sf: str) -> DataFrame:
    good = F.concat(F.lit("a/b"), this().cast("string"), F.lit(".jpg"))
    m = this() % 6
    text = F.when(m < 2, good).when(m == 2, F.concat(F.lit("/"), good)).when(m == 3, F.concat(F.lit("../"), good)).when(m == 4, F.concat(good, F.lit(" "))).otherwise(F.replace(good, F.lit("/"), F.lit("\\")))
    return events(spark, sf).select("event_id", textfuncs.normalize_rel_path(text).alias("path"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'p-' ELSE 'v-' END || (event_id % 5)::VARCHAR AS stream_id FROM events WHERE event_id % 2 = 0 OR event_id % 5 = 3")
def selected_streams(spark: SparkSession, sf: str) -> DataFrame:
    stream = F.concat(F.when(this() % 2 == 0, "p-").otherwise("v-"), (this() % 5).cast("string"))
    return events(spark, sf).select("event_id", stream.alias("stream_id")).where(textfuncs.stream_filter(F.col("stream_id"), ["Photos", "v-3"]))


@query("WITH x AS (SELECT event_id, [0, event_id % 7 * 500, event_id % 7 * 500 + event_id % 11 * 250] AS t FROM events) SELECT event_id, round_even(t[2] / 1000.0, 0)::BIGINT AS d1, round_even(t[3] / 1000.0, 0)::BIGINT AS d2, round_even((t[3] - t[2]) / 1000.0, 0)::BIGINT AS p2 FROM x")
def delta_columns(spark: SparkSession, sf: str) -> DataFrame:
    a = this() % 7 * 500
    first, last = timefuncs.delta_columns(F.array(F.lit(0).cast("long"), a, a + this() % 11 * 250))
    return events(spark, sf).select("event_id", F.get(first, 1).alias("d1"), F.get(first, 2).alias("d2"), F.get(last, 2).alias("p2"))


@query(f"WITH {DETECTIONS} SELECT event_id, CASE WHEN event_id % 5 > 0 THEN i::INT END AS detection_index, CASE WHEN event_id % 5 > 0 THEN event_type END AS event_type FROM d, range(1, 3) r(i) WHERE i <= greatest(1, event_id % 3)")
def flat_detections(spark: SparkSession, sf: str) -> DataFrame:
    x = jsonfuncs.normalize_detection(F.col("d"))
    many = F.when(this() % 5 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.greatest(F.lit(1), (this() % 3).cast("int"))))
    rows = detections(spark, sf).withColumn("x", x).withColumn("many", many).withColumn("detections", F.transform("many", lambda i: F.col("x")))
    some = rows.where("event_id % 5 > 0").unionByName(rows.where("event_id % 5 = 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), (this() % 3).cast("int"))))).drop("k"))
    return jsonfuncs.flatten_detections(some.select("event_id", "detections")).select("event_id", "detection_index", "detection.event_type")


@query("SELECT event_id, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H%M%S') AS time, (event_id % 1000)::INT AS sequence, CASE WHEN event_id % 2 = 0 THEN 1920 END AS width, CASE WHEN event_id % 2 = 0 THEN 1080 END AS height, CASE WHEN event_id % 4 = 0 THEN 29.97::DOUBLE END AS fps FROM events")
def media_filenames(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.date_format("ts", "yyyyMMdd_HHmmss_"), F.lpad((this() % 1000).cast("string"), 4, "0"), F.when(this() % 2 == 0, "_1920x1080").otherwise(""), F.when(this() % 4 == 0, "_29.97fps").otherwise(""), F.lit(".mp4"))
    return events(spark, sf).select("event_id", timefuncs.parse_media_filename(name).alias("x")).select("event_id", "x.*")


@query("WITH x AS (SELECT event_id, (event_id % 100) / 100.0::DOUBLE AS p FROM events) SELECT event_id, round(CASE WHEN p >= 0.5 THEN p ELSE 1 - p END, 6) AS confidence FROM x")
def decision_confidences(spark: SparkSession, sf: str) -> DataFrame:
    p = this() % 100 / 100
    return events(spark, sf).select("event_id", F.round(textfuncs.decision_confidence(p >= 0.5, p), 6).alias("confidence"))


@query("WITH x AS (SELECT event_id, (event_id % 3 - 1)::DOUBLE AS n, (event_id % 2)::DOUBLE AS d FROM events) SELECT event_id, CASE WHEN d <> 0 THEN (n / d)::VARCHAR WHEN n = 0 THEN '0.0' WHEN n > 0 THEN 'Infinity' ELSE '-Infinity' END AS ratio FROM x")
def safe_divisions(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("event_id", vectors.safe_divide((this() % 3 - 1).cast("double"), (this() % 2).cast("double")).cast("string").alias("ratio"))


@query("WITH x AS (SELECT event_id, ['k' || (event_id % 3)::VARCHAR, 'k' || (event_id % 4)::VARCHAR, 'k' || (event_id % 5)::VARCHAR] AS v FROM events), u AS (SELECT event_id, v[3] AS last, unnest(v) AS k FROM x), n AS (SELECT event_id, k, any_value(last) AS last, count(*) AS n FROM u GROUP BY event_id, k) SELECT event_id, arg_min(k, (-n, (k <> last)::INT, k)) AS mode FROM n GROUP BY event_id")
def modes(spark: SparkSession, sf: str) -> DataFrame:
    k = [F.concat(F.lit("k"), (this() % m).cast("string")) for m in (3, 4, 5)]
    return events(spark, sf).select("event_id", textfuncs.mode_with_tiebreak(F.array(*k), k[2]).alias("mode"))


@query("WITH n AS (SELECT count(*) AS n FROM embeddings) SELECT vec_id, vec_id % 10 / 10.0::DOUBLE AS brightness, len(embedding)::INT AS width FROM embeddings")
def aligned_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    v = V.read(spark, sf, "embeddings").select("vec_id", "embedding")
    out = boundaries.align_artifacts(v.select("vec_id"), v.select("vec_id", (F.col("vec_id") % 10 / 10).alias("brightness")), v, "vec_id")
    return out.select("vec_id", "brightness", F.size("embedding").alias("width"))


@query("SELECT conv_id, turn, 1000 + conv_id % 1000 * 10 + turn * 1500 AS segment_start_ms, 1000 + conv_id % 1000 * 10 + turn * 1500 + 250 AS segment_end_ms FROM conversations WHERE conv_id % 3 > 0")
def transcript_times(spark: SparkSession, sf: str) -> DataFrame:
    t = V.turns(spark, sf).select("conv_id", "turn", F.lit("v-1").alias("stream_id"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("clip_stem"), (F.col("turn") * 1.5).cast("double").alias("start_s"), (F.col("turn") * 1.5 + 0.25).cast("double").alias("end_s"))
    clips = V.turns(spark, sf).where("conv_id % 3 > 0").select("conv_id").distinct().select(F.lit("v-1").alias("stream_id"), F.concat(F.lit("x/c"), F.col("conv_id").cast("string"), F.lit(".MP4")).alias("filename"), (F.lit(1000) + F.col("conv_id") % 1000 * 10).alias("start_ms"))
    return transcripts.transcript_to_clip(t, clips).select("conv_id", "turn", "segment_start_ms", "segment_end_ms")


def windows(spark: SparkSession, sf: str) -> DataFrame:
    """Four neighbouring events for every tenth one."""
    return events(spark, sf).where("event_id % 10 = 0").select(this().alias("w"), F.array(this(), this() + 1, this() + 2, this() + 3).alias("frame_ids"))


def pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where("event_id % 7 > 0").select(this().alias("left_photo_id"), (this() + 1).alias("right_photo_id"), "value")


PAIRS = "p AS (SELECT event_id AS w, i, event_id + i AS l FROM events, range(0, 3) r(i) WHERE event_id % 10 = 0), j AS (SELECT p.*, e.value FROM p LEFT JOIN events e ON e.event_id = p.l AND e.event_id % 7 > 0)"


@query(f"WITH {PAIRS} SELECT w, string_agg(coalesce(round(value, 2)::VARCHAR, '-'), ',' ORDER BY i) AS scores, count_if(value IS NULL) AS missing_pairs FROM j GROUP BY w")
def pair_lookup(spark: SparkSession, sf: str) -> DataFrame:
    out = dataset.pair_lookup(windows(spark, sf), pair_scores(spark, sf), "w", ["value"])
    return out.select("w", F.array_join(F.transform("pair_scores", lambda p: F.coalesce(F.round(p["value"], 2).cast("string"), F.lit("-"))), ",").alias("scores"), "missing_pairs")


@query(f"WITH {PAIRS}, c AS (SELECT w, count_if(value IS NULL) AS m FROM j GROUP BY w) SELECT (count(*) * 3 - sum(m))::BIGINT AS covered_pairs, count(*) * 3 AS total_pairs, count_if(m = 0) AS complete_candidates, count(*) AS total_candidates FROM c")
def heuristic_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.heuristic_coverage(dataset.pair_lookup(windows(spark, sf), pair_scores(spark, sf), "w", ["value"]), 3)


@query("WITH p AS (SELECT event_id AS w, i, event_id + i AS f FROM events, range(0, 4) r(i) WHERE event_id % 10 = 0) SELECT w, string_agg(coalesce(e.event_type, '-'), ',' ORDER BY i) AS types, count_if(e.event_id IS NULL) AS missing_frames FROM p LEFT JOIN events e ON e.event_id = p.f AND e.event_id % 9 > 0 GROUP BY w")
def frame_lookup(spark: SparkSession, sf: str) -> DataFrame:
    table = events(spark, sf).where("event_id % 9 > 0").select(this().alias("photo_id"), "event_type")
    out = dataset.frame_lookup(windows(spark, sf), table, "w", ["event_type"])
    return out.select("w", F.array_join(F.transform("frame_rows", lambda r: F.coalesce(r["event_type"], F.lit("-"))), ",").alias("types"), "missing_frames")


@query("SELECT event_type AS field, bool_or(event_id % 50 = 0) AS multivalue FROM events GROUP BY event_type")
def descriptor_registry(spark: SparkSession, sf: str) -> DataFrame:
    value = F.array(F.when(this() % 50 == 0, "a, b").otherwise("a"))
    return dataset.descriptor_registry(events(spark, sf).select(F.create_map("event_type", value).alias("values")))


@query("SELECT event_id, event_id % 3 AS part FROM events WHERE event_id % 3 < 3")
def merged_corpus(spark: SparkSession, sf: str) -> DataFrame:
    days = events(spark, sf).select("event_id", (this() % 3).alias("part"), F.lit(2).alias("radius"), F.lit("v1").alias("rule"))
    return dataset.merge_corpus(days, ["radius", "rule"]).select("event_id", "part")


@query("SELECT 'f' || (event_id % 500)::VARCHAR AS relative_path, min(event_id) AS first_order FROM events WHERE event_id % 4 < 3 GROUP BY ALL")
def resolved_selection(spark: SparkSession, sf: str) -> DataFrame:
    k = (this() % 500).cast("string")
    chosen = events(spark, sf).select(F.when(this() % 4 == 0, F.concat(F.lit("s"), k)).alias("source_path"), F.when(this() % 4 < 3, "p-1").otherwise("p-9").alias("stream_id"), F.concat(F.lit("n"), k).alias("filename"), this().alias("order"))
    photos = events(spark, sf).where("event_id < 1500").select((this() % 500).cast("string").alias("k")).distinct().select(*(F.concat(F.lit(h), F.col("k")).alias(c) for h, c in (("s", "source_path"), ("n", "filename"), ("f", "relative_path"))), F.lit("p-1").alias("stream_id"))
    return review.resolve_selection(chosen, photos)[0].select("relative_path", F.col("order").alias("first_order"))


@query("SELECT event_id, 't/' || event_id::VARCHAR AS thumb, event_type FROM events WHERE event_id % 2 = 0")
def variant_rows(spark: SparkSession, sf: str) -> DataFrame:
    variant = events(spark, sf).where("event_id % 2 = 0").select("event_id", F.concat(F.lit("t/"), this().cast("string")).alias("thumb"))
    return results.join_variant(variant, events(spark, sf).select("event_id", "event_type"), "event_id", "thumb").select("event_id", "thumb", "event_type")


@query("SELECT (event_id % 40)::VARCHAR AS cut_left, (event_id % 40 + 1)::VARCHAR AS cut_right, count(*) AS hits, string_agg(event_type, ',' ORDER BY event_type) AS left_types FROM events WHERE event_id % 5 > 0 GROUP BY ALL")
def cut_votes(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select(F.when(this() % 5 > 0, "ok").otherwise("invalid_response").alias("response_status"), (this() % 40).cast("string").alias("cut_left"), (this() % 40 + 1).cast("string").alias("cut_right"), F.lit("r").alias("reason"), F.col("event_type").alias("left_type"), F.col("event_type").alias("right_type"))
    return metrics.cut_votes(rows).select("cut_left", "cut_right", "hits", F.array_join("left_types", ",").alias("left_types"))


@query("SELECT user_id, count_if(event_type = 'view') AS n_view, count_if(event_type = 'click') AS n_click FROM events GROUP BY user_id")
def run_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.status_counts(events(spark, sf), "user_id", "event_type", ["view", "click"])


@query(
    """SELECT event_type AS model, count(*) AS cases, count_if(event_id % 2 = 0) AS event_correct, count_if(event_id % 3 = 0) AS number_correct, count(*) AS ordinal_correct, count_if(event_id % 6 = 0) AS strict_correct, count_if(event_id % 10 = 0) AS errors, round(100.0 * count_if(event_id % 6 = 0) / count(*), 6)::DOUBLE AS strict_percent FROM events GROUP BY ALL"""
)
def model_scoreboard(spark: SparkSession, sf: str) -> DataFrame:
    seen = F.array(F.struct(F.when(this() % 2 == 0, "announcement").otherwise("other").alias("event_type"), F.when(this() % 3 == 0, 5).otherwise(6).alias("start_number"), F.lit(1).alias("category_ordinal")))
    rows = events(spark, sf).select(F.col("event_type").alias("model"), seen.alias("detections"), F.lit("announcement").alias("expected_event"), F.lit(5).alias("expected_number"), F.lit(1).alias("expected_ordinal"), F.when(this() % 10 == 0, "e").alias("error"), F.col("value").alias("seconds"))
    out = metrics.model_scoreboard(rows)
    return out.select("model", "cases", "event_correct", "number_correct", "ordinal_correct", "strict_correct", "errors", F.round("strict_percent", 6).alias("strict_percent"))


@query("SELECT sum(user_id)::BIGINT AS generated, count_if(event_type = 'view') AS missing_artifact, count_if(event_type = 'click') AS missing_truth, count(*) AS true_after FROM events")
def corpus_attrition(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda k: (F.col("event_type") == k).cast("long")
    days = events(spark, sf).select(F.col("user_id").alias("generated"), one("view").alias("missing_artifact"), one("click").alias("missing_truth"), F.lit(0).alias("missing_window"), F.lit(1).alias("true_before"), F.lit(1).alias("true_after"))
    return results.corpus_attrition(days).select("generated", "missing_artifact", "missing_truth", "true_after")


@query(
    """WITH p AS (SELECT strftime(ts, '%Y%m%d') AS day_id, event_type AS set_id, 'f' || event_id::VARCHAR AS path, epoch_us(ts) // 1000 AS t, event_id % 3 > 0 AS e FROM events)
SELECT day_id, set_id, count_if(NOT e) AS missing_count, arg_min(path, (t, path)) FILTER (e) AS first_proxy, arg_max(path, (t, path)) FILTER (e) AS last_proxy FROM p GROUP BY ALL"""
)
def presence_flags(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("f"), F.col("photo_id").cast("string"))
    sets = V.photos(spark, sf).select("day_id", F.col("event_type").alias("set_id"), path.alias("path"), "start_epoch_ms")
    return review.presence_flags(sets, V.photos(spark, sf).where("photo_id % 3 > 0").select(path.alias("path")))


@query(
    """WITH e AS (SELECT strftime(ts, '%Y%m%d') AS day_id, user_id % 3 AS f, event_id % 2 = 0 AS viewed, user_id AS n, event_id, CASE WHEN event_id % 4 = 0 THEN 'warmup' WHEN event_id % 4 = 1 THEN 'ceremony' ELSE ' ' END AS o FROM events)
SELECT day_id, f::VARCHAR AS final_set_id, bool_or(viewed) AS viewed, max(n) AS view_count, min(event_id) AS first_viewed, max(event_id) AS last_viewed, arg_min(o, event_id) FILTER (trim(o) <> '') AS segment_type_override FROM e GROUP BY ALL"""
)
def merged_entries(spark: SparkSession, sf: str) -> DataFrame:
    e = V.photos(spark, sf).select("day_id", F.col("user_id").cast("string").alias("set_id"), "user_id", (F.col("photo_id") % 2 == 0).alias("viewed"), F.col("user_id").alias("view_count"), F.col("photo_id").alias("first_viewed"), F.col("photo_id").alias("last_viewed"), F.col("photo_id").alias("entry_order"), F.when(F.col("photo_id") % 4 == 0, "warmup").when(F.col("photo_id") % 4 == 1, "ceremony").otherwise(" ").alias("segment_type_override"))
    mapping = e.select("day_id", "set_id", (F.col("user_id") % 3).cast("string").alias("final_set_id")).distinct()
    return review.merge_review_entries(e.drop("user_id"), mapping)


@query("WITH u AS (SELECT 'p-' || (user_id % 4)::VARCHAR AS stream_id, unnest(['all', event_type]) AS trigger_type FROM events) SELECT stream_id, trigger_type, count(*) AS window_count FROM u GROUP BY ALL")
def window_summary(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.window_summary(V.photos(spark, sf).select("stream_id", F.array(F.lit("all"), F.col("event_type")).alias("trigger_types")))


@query("SELECT user_id, event_id % 3 AS part, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY ALL")
def deduped_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("user_id", (this() % 3).alias("part"), F.array("event_type").alias("types"))
    return transcripts.dedupe_windows(rows, ["user_id", "part"], ["types"]).select("user_id", "part", F.array_join("types", ",").alias("types"))


@query("SELECT event_id AS photo_id, (user_id % 7)::VARCHAR AS segment_id, event_type AS segment_type FROM events")
def reviewed_truth(spark: SparkSession, sf: str) -> DataFrame:
    return review.reviewed_truth(events(spark, sf).select(this().alias("photo_id"), (F.col("user_id") % 7).cast("string").alias("set_id"), F.col("event_type").alias("segment_type")))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS segment FROM events")
def attributed_detections(spark: SparkSession, sf: str) -> DataFrame:
    m = this() % 4
    texts = ["wstep", "druga czesc", "Oklaski, prosze!", "teraz numer 12 i"]
    segments = F.array(*(F.struct(F.lit(i).cast("long").alias("index"), F.lit(t).alias("text")) for i, t in enumerate(texts)))
    found = F.struct(F.lit("announcement").alias("event_type"), F.when(m == 1, 12).otherwise(7).alias("start_number"), F.when(m == 0, "oklaski prosze").when(m == 1, " ").otherwise("nothing of it").alias("evidence"))
    rows = events(spark, sf).select("event_id", segments.alias("segments"), found.alias("detection"), F.when(m == 2, 1).otherwise(9).alias("center_index"))
    return transcripts.attribute_detections(rows).select("event_id", "segment.index").withColumnRenamed("index", "segment")


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN event_id + event_id % 3 END AS cut_left, CASE WHEN event_id % 3 < 2 AND event_id + event_id % 3 + 1 <= (SELECT max(event_id) FROM events) THEN event_id + event_id % 3 + 1 END AS cut_right FROM events WHERE event_id % 10 = 0")
def normalized_cuts(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select(F.lit("d").alias("day_id"), this().alias("i"), this().alias("photo_id"))
    told = F.when(this() % 3 == 0, "cut_after_1").when(this() % 3 == 1, "cut_after_2").otherwise("no_cut")
    return review.normalize_cut_pairs(events(spark, sf).where("event_id % 10 = 0").select("event_id", F.lit("d").alias("day_id"), this().alias("start_row"), told.alias("decision")), rows).select("event_id", "cut_left", "cut_right")


@query("SELECT w AS cut_left, w + 1 AS cut_right, string_agg(e.event_id::VARCHAR, ',' ORDER BY e.event_id) AS frames FROM (SELECT event_id AS w FROM events WHERE event_id % 10 = 0) JOIN events e ON e.event_id BETWEEN w AND w + 3 GROUP BY w")
def hint_windows(spark: SparkSession, sf: str) -> DataFrame:
    probed = windows(spark, sf).select(F.col("w").alias("cut_left"), (F.col("w") + 1).alias("cut_right"), "frame_ids")
    out = review.hint_windows(probed.union(probed), V.photos(spark, sf).select("photo_id", "start_epoch_ms"))
    return out.select("cut_left", "cut_right", F.array_join(F.transform("frames", lambda f: f["photo_id"].cast("string")), ",").alias("frames"))


@query("SELECT event_id, event_type FROM events WHERE event_id % 3 > 0 OR event_type <> 'view'")
def pending_rows(spark: SparkSession, sf: str) -> DataFrame:
    done = events(spark, sf).where("event_id % 3 = 0").select("event_id", F.lit("view").alias("event_type"))
    return incremental.pending(events(spark, sf).select("event_id", "event_type"), done, ["event_id", "event_type"])


@query("SELECT r_regionkey::VARCHAR AS set_id FROM region WHERE r_name = 'ASIA'")
def found_set(spark: SparkSession, sf: str) -> DataFrame:
    return review.find_set(V.read(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("set_id"), F.col("r_name").alias("display_name")), "ASIA")


@query(
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY ts, event_id) - 1 AS i FROM events), x AS (SELECT event_id, strftime(ts, '%Y%m%d') AS d, i, epoch_us(ts) // 1000 - CASE WHEN event_id % 90 = 0 THEN 86400000 ELSE 0 END AS t FROM r)
SELECT 'time_order' AS rule, event_id::VARCHAR AS key FROM (SELECT *, lag(t) OVER (PARTITION BY d ORDER BY i) AS b FROM x) WHERE t < b"""
)
def time_order_breaks(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.photos(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("day_id").orderBy("start_epoch_ms", "photo_id")) - 1).withColumn("t", F.col("start_epoch_ms") - F.when(F.col("photo_id") % 90 == 0, 86_400_000).otherwise(0))
    return validate.time_order(rows, "day_id", "i", "t", "photo_id").select("rule", F.col("key").cast("string").alias("key"))


@query("WITH t AS (SELECT o_orderkey, count(*) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS n, count(*) AS m FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderkey) SELECT 'segment_coverage' AS rule, o_orderkey::VARCHAR AS key FROM t WHERE n <> m")
def coverage_breaks(spark: SparkSession, sf: str) -> DataFrame:
    lines = V.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("day")).groupBy("day").count()
    parts = lines.select("day", (F.col("count") + F.when(F.col("day") % 5 == 0, 1).otherwise(0)).alias("photo_count"))
    return validate.segment_coverage(parts, lines.select("day", F.col("count").alias("photos")), "day").select("rule", F.col("key").cast("string").alias("key"))


@query("SELECT 'attrition_sums' AS rule, event_id::VARCHAR AS key FROM events WHERE event_id % 11 = 0")
def attrition_breaks(spark: SparkSession, sf: str) -> DataFrame:
    report = events(spark, sf).select("event_id", F.lit(4).alias("generated"), F.lit(1).alias("missing_artifact"), F.lit(1).alias("missing_truth"), F.lit(1).alias("missing_window"), F.when(this() % 11 == 0, 2).otherwise(1).alias("retained"))
    return validate.attrition_sums(report, "event_id").select("rule", F.col("key").cast("string").alias("key"))


@query("SELECT 'single_split' AS rule, doc_id::VARCHAR AS key FROM documents WHERE doc_id % 13 = 0 UNION ALL SELECT 'required_classes', s FROM (VALUES ('validation'), ('test')) t(s) WHERE NOT EXISTS (SELECT 1 FROM documents WHERE lang = 'xx')")
def split_breaks(spark: SparkSession, sf: str) -> DataFrame:
    d = V.read(spark, sf, "documents").select("doc_id", "lang")
    rows = d.withColumn("split_name", F.when(F.col("doc_id") % 3 == 0, "validation").when(F.col("doc_id") % 3 == 1, "test").otherwise("train"))
    twice = rows.where("doc_id % 13 = 0").withColumn("split_name", F.when(F.col("split_name") == "train", "test").otherwise("train"))
    return validate.split_manifest(rows.union(twice), "doc_id", ["xx"], "lang").select("rule", F.col("key").cast("string").alias("key"))


@query("SELECT 'one_contract' AS rule, 'corpus' AS key WHERE (SELECT count(DISTINCT event_type) FROM events) > 1")
def contract_breaks(spark: SparkSession, sf: str) -> DataFrame:
    return validate.one_contract(events(spark, sf), ["event_type"]).select("rule", F.col("key").cast("string").alias("key"))


@query("SELECT 'required:people' AS rule, event_id::VARCHAR AS key FROM events WHERE event_id % 5 = 0 UNION ALL SELECT 'enum:view', event_id::VARCHAR FROM events WHERE event_id % 7 = 0")
def descriptor_breaks(spark: SparkSession, sf: str) -> DataFrame:
    value = F.create_map(F.when(this() % 5 == 0, "persons").otherwise("people"), F.array(F.lit("solo")), F.lit("view"), F.array(F.when(this() % 7 == 0, "odd").otherwise("solo")))
    rows = events(spark, sf).select("event_id", value.alias("values"))
    return validate.descriptor_record(rows, "event_id", ["people"], {"view": ["solo", "group"]}).select("rule", F.col("key").cast("string").alias("key"))


@query("SELECT event_id, 'a_b_c_d_e_f' AS field, event_type AS value FROM events UNION ALL SELECT event_id, 'a_b_c_d_e_g_h', props FROM events WHERE props IS NOT NULL UNION ALL SELECT event_id, 'a_n', user_id::VARCHAR FROM events")
def deep_descriptors(spark: SparkSession, sf: str) -> DataFrame:
    """Six levels; props is a text with JSON inside and stays one."""
    inner = F.struct(F.col("event_type").alias("f"), F.col("props").alias("g h"))
    for name in "edcb":
        inner = F.struct(inner.alias(name))
    text = F.to_json(F.struct(F.struct(F.col("user_id").alias("n"), inner.getField("b").alias("b")).alias("a")))
    flat = V.read(spark, sf, "events").select("event_id", F.explode(jsonfuncs.flatten_descriptors(text)).alias("field", "values"))
    return flat.select("event_id", "field", F.array_join("values", "|").alias("value"))


@query(
    """SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL ELSE '{"window_id":"w' || event_id || '","detections":[{"event_type":"' || event_type || '","n":' || user_id || '}]}' END AS payload FROM events"""
)
def window_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Answers with a fence, thoughts, a broken object and objects of other windows around the one that is asked for; some lack it."""
    own = F.concat(F.lit('{"window_id": "w'), F.col("event_id"), F.lit('", "detections": [{"event_type": "'), "event_type", F.lit('", "n": '), F.col("user_id"), F.lit("}]}"))
    other = F.concat(F.lit('{"window_id": "w'), F.col("event_id") + 1, F.lit('", "detections": []}'))
    asked = F.when(F.col("event_id") % 5 == 4, F.lit("")).otherwise(own)
    text = F.concat(F.lit("<think>{no}</think> so {x: "), other, F.lit("\n```json\n"), asked, F.lit("\n```\nand "), other, F.lit(' {"a": {"b": 1}} }'))
    return events(spark, sf).select("event_id", jsonfuncs.detections_payload(text, F.concat(F.lit("w"), F.col("event_id"))).alias("payload"))


@query(
    """WITH s AS (SELECT o_orderkey AS day, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i FROM lineitem JOIN orders ON o_orderkey = l_orderkey), n AS (SELECT day, count(*) AS n FROM s GROUP BY 1)
SELECT 'contiguous' AS rule, day || '|' || i AS key FROM s WHERE i % 3 = 0 UNION ALL SELECT 'photo_count', day || '|' || i FROM s WHERE i % 3 = 0 UNION ALL SELECT 'covered', day || '|' || n FROM n WHERE day % 7 = 0"""
)
def contiguity_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of an order as its segments, each third one begun a place too late, and orders with a photo that no segment has."""
    by = Window.partitionBy("day").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines = V.read(spark, sf, "lineitem").join(V.read(spark, sf, "orders").select(F.col("o_orderkey").alias("day")), F.col("day") == F.col("l_orderkey"))
    size = F.col("l_quantity").cast("long") + 1
    rows = lines.withColumns({"segment_index": F.row_number().over(by), "photo_count": size, "end_index": F.sum(size).over(by.rowsBetween(Window.unboundedPreceding, 0)) - 1})
    late = F.when(F.col("segment_index") % 3 == 0, 1).otherwise(0)
    segments = rows.select("day", "segment_index", (F.col("end_index") - F.col("photo_count") + 1 + late).alias("start_index"), "end_index", "photo_count")
    totals = rows.groupBy("day").agg((F.sum("photo_count") + F.when(F.col("day") % 7 == 0, 1).otherwise(0)).alias("photos"))
    return validate.segment_contiguity(segments, totals, "day").select("rule", "key")


@query(
    f"""WITH {V.PAIRS}, b AS (SELECT *, CASE WHEN left_photo_id % 70 = 0 THEN -1 ELSE right_photo_id END AS r, time_gap_seconds + CASE WHEN left_photo_id % 90 = 0 THEN 1 ELSE 0 END AS g FROM pairs),
l AS (SELECT *, lag(r) OVER (PARTITION BY day_id ORDER BY left_start_epoch_ms, left_photo_id) AS p FROM b)
SELECT 'pair_chain' AS rule, left_photo_id::VARCHAR AS key FROM l WHERE p <> left_photo_id UNION ALL SELECT 'pair_gap', left_photo_id::VARCHAR FROM b WHERE abs(g - time_gap_seconds) > 1e-6"""
)
def pair_breaks(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.pairs(spark, sf).withColumn("right_photo_id", F.when(F.col("left_photo_id") % 70 == 0, -1).otherwise(F.col("right_photo_id")))
    rows = rows.withColumn("time_gap_seconds", F.col("time_gap_seconds") + F.when(F.col("left_photo_id") % 90 == 0, 1).otherwise(0))
    found = validate.pair_chain(rows, "day_id", "left_start_epoch_ms", "left_photo_id", "right_photo_id", "left_start_epoch_ms", "right_start_epoch_ms", "time_gap_seconds")
    return found.select("rule", "key")
