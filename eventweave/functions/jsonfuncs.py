"""JSON columns: model answers, detections, descriptors."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.functions.textfuncs import explicit_number, normalize_text

RESPONSE = "decision string, group_a_segment_type string, group_b_segment_type string, frame_notes array<struct<frame_id:string, `group`:string, note:string>>, primary_evidence array<string>, summary string"
CONTRACT = "grouped_v1"
DETECTION = "event_type string, start_number string, category_ordinal string, title string, evidence string, notes string, confidence double"
EVENT_TYPES = ["announcement", "award", "break", "other"]
#: The segment types of answers.
SEGMENT_TYPES = ["dance", "ceremony", "audience", "rehearsal", "other"]


def extract_json_payload(text: Column) -> Column:
    """The JSON object inside prose, code fences and think blocks: from the first opening to the last closing brace; null without one."""
    clean = F.regexp_replace(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""), r"```[a-z]*", "")
    found = F.regexp_extract(clean, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def _objects(text: str) -> Iterator[object]:
    """The JSON objects in a text, from left to right, each with the ones inside it as one."""
    read = json.JSONDecoder().raw_decode
    at = text.find("{")
    while at >= 0:
        try:
            value, end = read(text, at)
            yield value
        except ValueError:
            end = at + 1
        at = text.find("{", end)


def _is_window(value: object, wanted: str | None) -> bool:
    named = isinstance(value, dict) and isinstance(value.get("window_id"), str) and isinstance(value.get("detections"), list)
    return named and (not wanted or value["window_id"] == wanted)


def detections_payload(text: Column, window_id: Column | None = None, batch: bool = False) -> Column:
    """The last object of an answer that is one: a window_id (that of the column window_id, where it has a value) with a list of
    detections; or, for a batch, a list ``results`` of such. Code fences and think blocks are taken off first. As compact JSON; null
    without one."""

    @F.pandas_udf("string")
    def last(texts: pd.Series, ids: pd.Series) -> pd.Series:
        rows = []
        for t, wanted in zip(texts, ids, strict=True):
            found = None
            for value in _objects(t or ""):
                results = value.get("results") if batch and isinstance(value, dict) else None
                if _is_window(value, wanted) if not batch else isinstance(results, list) and all(_is_window(r, None) for r in results):
                    found = value
            rows.append(None if found is None else json.dumps(found, ensure_ascii=False, separators=(",", ":")))
        return pd.Series(rows, dtype=object)

    clean = F.regexp_replace(F.regexp_replace(text, r"(?i)```(json\s*)?", ""), r"(?is)<think>.*?</think>\s*|</think>\s*", "")
    return last(clean, F.lit(None).cast("string") if window_id is None else window_id)


def parse_window_response(df: DataFrame, raw: str = "raw_response", group_a: str = "group_a_ids", group_b: str = "group_b_ids", strict: bool = True) -> DataFrame:
    """Adds decision, semantic_decision, semantic_group_a_segment_type, semantic_group_b_segment_type, response_contract_id, reason and
    response_status of an answer about the frames of two groups (arrays of ids).

    The first rule that is broken, in this order, gives the reason of an invalid response: a JSON object; a decision of same_segment or
    different_segments; known types of both groups (only when strict, else unknown ones are blank); notes that name every frame of the
    groups once with its group and a text; evidence; a summary. A good answer is no_cut, or cut_after_k with the size of group A."""
    trimmed = lambda c: F.coalesce(F.trim(c), F.lit(""))
    payload = extract_json_payload(F.col(raw))
    out = df.withColumn("_ok", F.try_parse_json(payload).isNotNull()).withColumn("_r", F.from_json(payload, RESPONSE))
    decision, kinds = trimmed(F.col("_r.decision")), [trimmed(F.col(f"_r.group_{g}_segment_type")) for g in "ab"]
    known = [k.isin(SEGMENT_TYPES) for k in kinds]
    notes, frames = F.col("_r.frame_notes"), F.concat(F.col(group_a), F.col(group_b))
    names = F.transform(notes, lambda n: trimmed(n["frame_id"]))

    def broken(n: Column, i: Column) -> Column:
        """The rule that note i breaks."""
        frame, group = trimmed(n["frame_id"]), trimmed(n["group"])
        due = F.when(F.array_contains(F.col(group_a), frame) & ~F.array_contains(F.col(group_b), frame), "group_a").otherwise("group_b")
        return (
            F.when(n.isNull(), "Invalid frame_notes item")
            .when(frame == "", "Missing frame_id value in frame_notes")
            .when(~F.array_contains(frames, frame), F.concat(F.lit("Invalid frame_id value: "), frame))
            .when(F.array_contains(F.slice(names, F.lit(1), i), frame), F.concat(F.lit("duplicate frame_id: "), frame))
            .when(group != due, F.concat(F.lit("Invalid group for "), frame, F.lit(": expected "), due, F.lit(", got "), group))
            .when(trimmed(n["note"]) == "", F.concat(F.lit("Missing frame_notes value for "), frame))
        )

    first_broken = F.get(F.filter(F.transform(notes, broken), lambda x: x.isNotNull()), 0)
    missing = F.get(F.filter(frames, lambda f: ~F.array_contains(names, f)), 0)
    evidence = F.filter(F.transform(F.col("_r.primary_evidence"), trimmed), lambda x: x != "")
    summary = trimmed(F.col("_r.summary"))
    wrong = (
        F.when(~F.col("_ok") | F.col("_r").isNull(), "JSON parse error")
        .when(~decision.isin("same_segment", "different_segments"), F.concat(F.lit("Invalid decision value: "), decision))
        .when(F.lit(strict) & ~(known[0] & known[1]), "Missing or invalid group segment type value")
        .when(notes.isNull(), "Missing frame_notes array")
        .when(first_broken.isNotNull(), first_broken)
        .when(missing.isNotNull(), F.concat(F.lit("Missing frame_notes value for "), missing))
        .when(F.col("_r.primary_evidence").isNull(), "Missing primary_evidence list")
        .when(F.size(evidence) == 0, "Missing primary_evidence values")
        .when(summary == "", "Missing summary value")
    )
    kept = [F.when(ok, k).otherwise("") for ok, k in zip(known, kinds, strict=True)]
    shown = [F.when(ok, k).otherwise("?") for ok, k in zip(known, kinds, strict=True)]
    noted = F.array_join(F.transform(notes, lambda n: F.concat(trimmed(n["frame_id"]), F.lit("("), trimmed(n["group"]), F.lit(")="), trimmed(n["note"]))), "; ")
    told = F.concat(F.lit("Group A segment type: "), shown[0], F.lit(" | Group B segment type: "), shown[1], F.lit(" | Frame notes: "), noted, F.lit(" | Primary evidence: "), F.array_join(evidence, "; "), F.lit(" | Summary: "), summary)
    out = out.withColumn("_w", wrong)
    ok = F.col("_w").isNull()
    cut = F.when(decision == "same_segment", F.lit("no_cut")).otherwise(F.concat(F.lit("cut_after_"), F.size(group_a).cast("string")))
    return out.withColumns({
        "reason": F.coalesce("_w", told), "response_status": F.when(ok, "ok").otherwise("invalid_response"), "semantic_decision": F.when(ok, decision),
        "semantic_group_a_segment_type": F.when(ok, kept[0]), "semantic_group_b_segment_type": F.when(ok, kept[1]), "response_contract_id": F.when(ok, F.lit(CONTRACT)), "decision": F.when(ok, cut).otherwise("invalid_response"),
    }).drop("_r", "_ok", "_w")


def normalize_detection(d: Column) -> Column:
    """Unknown event types become other; only announcements keep a number (at most 999, else the one in the evidence); blank is null."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    kind = F.lower(F.trim(d["event_type"]))
    event = F.when(kind.isin(EVENT_TYPES), kind).otherwise("other")
    n = d["start_number"].try_cast("int")
    number = F.coalesce(F.when(n.between(1, 999), n), explicit_number(d["evidence"]))
    return F.struct(
        event.alias("event_type"), F.when(event == "announcement", number).alias("start_number"), d["category_ordinal"].try_cast("int").alias("category_ordinal"), some(d["title"]).alias("title"), some(d["evidence"]).alias("evidence"), some(d["notes"]).alias("notes"),
        d["confidence"].alias("confidence"),
    )


def is_junk(d: Column, patterns: list[str]) -> Column:
    """Nothing but a type, or an announcement without a number whose evidence fits a junk pattern."""
    empty = d["evidence"].isNull() & d["title"].isNull() & d["start_number"].isNull()
    text = normalize_text(F.coalesce(d["evidence"], F.lit("")))
    fits = F.lit(False)
    for p in patterns:
        fits = fits | text.rlike(p)
    return empty | ((d["event_type"] == "announcement") & d["start_number"].isNull() & fits)


def flatten_detections(df: DataFrame, detections: str = "detections") -> DataFrame:
    """A row for each detection with its 1-based index; a window without any gives one row with index null."""
    out = df.select(*[c for c in df.columns if c != detections], F.posexplode_outer(detections).alias("_i", "detection"))
    return out.withColumn("detection_index", F.col("_i") + 1).drop("_i")


def _flat(value: object, name: str, out: dict[str, list[str]]) -> None:
    """Adds the fields below an object, of any depth, under joined names."""
    plain = lambda v: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))
    if isinstance(value, dict):
        for key in sorted(value):
            part = key.strip().replace(".", "_").replace(" ", "_")
            if part:
                _flat(value[key], f"{name}_{part}" if name else part, out)
    elif value is not None and name:
        out[name] = [plain(v) for v in value if v is not None] if isinstance(value, list) else [plain(value)]


def flatten_descriptors(text: Column) -> Column:
    """map of field to its values: nested objects of any depth become a_b_c; '.' and blank in names become '_'; a scalar is one value, a
    null none. Of fields that get one name the last in order of the original names stays. Null for what is not a JSON object."""

    @F.pandas_udf("map<string, array<string>>")
    def flat(texts: pd.Series) -> pd.Series:
        rows = []
        for t in texts:
            try:
                value = json.loads(t) if t is not None else None
            except ValueError:
                value = None
            fields: dict[str, list[str]] = {}
            _flat(value if isinstance(value, dict) else None, "", fields)
            rows.append(fields if isinstance(value, dict) else None)
        return pd.Series(rows, dtype=object)

    return flat(text)
