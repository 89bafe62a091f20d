"""Text columns: normalizing, spoken numbers, triggers, descriptors, ids. Vocabularies are parameters."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters that decompose to a letter a to z with marks, and that letter (stroked letters don't decompose and stay apart).
ACCENTED = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if "a" <= (d := unicodedata.normalize("NFD", c))[0] <= "z" and all(map(unicodedata.combining, d[1:])))
PLAIN = "".join(unicodedata.normalize("NFD", c)[0] for c in ACCENTED)
def _inflected(stems: dict[str, int], endings: tuple[str, ...]) -> dict[str, int]:
    return {stem + end: n for stem, n in stems.items() for end in endings}


#: Polish number words after normalizing, cardinals and the stems of ordinals (masculine, feminine and neuter endings).
UNITS = {
    "zero": 0, "jeden": 1, "jedna": 1, "jedno": 1, "dwa": 2, "dwie": 2, "trzy": 3, "cztery": 4, "piec": 5, "szesc": 6, "siedem": 7, "osiem": 8, "dziewiec": 9,
    "pierwszaj": 1, "drugi": 2, "druga": 2, "drugie": 2, "trzeci": 3, "trzecia": 3, "trzecie": 3,
} | _inflected({"pierwsz": 1, "czwart": 4, "piat": 5, "szost": 6, "siodm": 7, "osm": 8, "dziewiat": 9}, ("y", "a", "e"))
TEENS = {
    "dziesiec": 10, "jedenascie": 11, "dwanascie": 12, "trzynascie": 13, "czternascie": 14, "pietnascie": 15, "szesnascie": 16, "siedemnascie": 17, "osiemnascie": 18, "dziewietnascie": 19,
} | _inflected({"dziesiat": 10, "jedenast": 11, "dwunast": 12, "trzynast": 13, "czternast": 14, "pietnast": 15, "szesnast": 16, "siedemnast": 17, "osiemnast": 18, "dziewietnast": 19}, ("y", "a", "e"))
TENS = {
    "dwadziescia": 20, "trzydziesci": 30, "czterdziesci": 40, "piecdziesiat": 50, "szescdziesiat": 60, "siedemdziesiat": 70, "osiemdziesiat": 80, "dziewiecdziesiat": 90,
} | _inflected({"dwudziest": 20, "trzydziest": 30, "czterdziest": 40, "piecdziesiat": 50, "szescdziesiat": 60, "siedemdziesiat": 70, "osiemdziesiat": 80, "dziewiecdziesiat": 90}, ("y", "a", "e"))
HUNDREDS = {
    "sto": 100, "dwiescie": 200, "trzysta": 300, "czterysta": 400, "piecset": 500, "szescset": 600, "siedemset": 700, "osiemset": 800, "dziewiecset": 900,
} | _inflected({"setn": 100, "dwusetn": 200, "trzechsetn": 300, "czterechsetn": 400, "piecsetn": 500, "szescsetn": 600, "siedemsetn": 700, "osiemsetn": 800, "dziewiecsetn": 900}, ("y", "a", "e"))
AND_WORDS = ("i", "oraz")
NUMBER_TOKENS = 6


def normalize_text(text: Column) -> Column:
    """Lower case, accents stripped, the number sign as the word 'nr', tokens [a-z0-9]+ joined by one blank."""
    low = F.regexp_replace(F.lower(text), "№", " nr ")
    low = F.regexp_replace(F.translate(low, ACCENTED, PLAIN), r"\p{M}", "")
    return F.array_join(F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0)), " ")


def _value(token: Column, words: dict[str, int]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in words.items() for x in pair)), token)


def number_pattern(units: dict[str, int], teens: dict[str, int], tens: dict[str, int], hundreds: dict[str, int], joins: tuple[str, ...] = AND_WORDS) -> str:
    """Of tokens that each follow a blank: hundreds and joining words (1), then a teen (2), or tens and joining words (3) and a unit (4)."""
    one = lambda words: "(" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")(?= |$)"
    link = f"(?: (?:{'|'.join(joins)})(?= |$))*"
    return f"^(?: {one(hundreds)}{link})?(?: {one(teens)}|(?: {one(tens)}{link})?(?: {one(units)})?)"


def parse_spoken_number(tokens: Column, units: dict[str, int] = UNITS, teens: dict[str, int] = TEENS, tens: dict[str, int] = TENS, hundreds: dict[str, int] = HUNDREDS) -> Column:
    """struct(value, used, method) of the number that the first NUMBER_TOKENS tokens begin with: digits, or hundreds and a teen, or
    hundreds, tens and a unit, with joining words after hundreds and tens; null without one."""
    first = F.get(tokens, 0)
    digits = F.when(first.rlike(r"^\d{1,9}$"), first.try_cast("int"))
    text = F.concat(F.lit(" "), F.array_join(F.slice(tokens, 1, NUMBER_TOKENS), " "))
    pattern = number_pattern(units, teens, tens, hundreds)
    parts = [F.coalesce(_value(F.regexp_extract(text, pattern, i + 1), words), F.lit(0)) for i, words in enumerate((hundreds, teens, tens, units))]
    whole = F.regexp_extract(text, pattern, 0)
    return F.when(digits.isNotNull(), F.struct(digits.alias("value"), F.lit(1).alias("used"), F.lit("digits").alias("method"))).when(
        whole != "", F.struct((parts[0] + parts[1] + parts[2] + parts[3]).alias("value"), (F.length(whole) - F.length(F.replace(whole, F.lit(" ")))).alias("used"), F.lit("words").alias("method"))
    )


def filter_words_by_score(words: Column, text: Column, min_score: float, keep: list[str]) -> Column:
    """Text of the words with a score of at least min_score; digits and the terms in ``keep`` stay anyway; without any, the raw text."""
    kept = F.filter(words, lambda w: (w["score"] >= min_score) | w["word"].rlike(r"\d") | F.lower(w["word"]).isin(keep))
    joined = F.array_join(F.transform(kept, lambda w: w["word"]), " ")
    return F.when(F.coalesce(joined, F.lit("")) == "", text).otherwise(joined)


def trigger_types(text: Column, triggers: dict[str, list[str]]) -> tuple[Column, Column]:
    """The names of the trigger classes with a term among the text's tokens, and these terms (both sorted)."""
    tokens = F.split(text, " ")
    terms = {k: F.array_intersect(tokens, F.array(*map(F.lit, v))) for k, v in sorted(triggers.items())}
    names = F.array_compact(F.array(*(F.when(F.size(v) > 0, F.lit(k)) for k, v in terms.items())))
    return names, F.array_sort(F.array_distinct(F.concat(*terms.values())))


def explicit_number(text: Column) -> Column:
    """The number after 'numer' or 'nr' (with 'startowy' between, or not), or null."""
    return F.nullif(F.regexp_extract(text, r"(?i)\b(?:numer|nr)\.?\s+(?:startowy\s+)?(\d{1,3})\b", 1), F.lit("")).try_cast("int")


def descriptor_tokens(value: Column, limit: int = 5) -> Column:
    """Lower-cased parts between , ; | /, trimmed, distinct, sorted, the first ``limit``."""
    parts = F.filter(F.transform(F.split(F.lower(value), r"[,;|/]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(F.array_sort(F.array_distinct(parts)), 1, limit)


def candidate_id(*parts: Column) -> Column:
    """First 16 hex digits of SHA-1 over the compact JSON array of the parts (ASCII)."""
    return F.substring(F.sha1(F.to_json(F.array(*(p.cast("string") for p in parts)))), 1, 16)


def config_hash(params: dict[str, Column]) -> Column:
    return F.md5(F.to_json(F.struct(*(params[k].alias(k) for k in sorted(params)))))


def photo_identity(source: Column, relative: Column, stream: Column, filename: Column) -> Column:
    """Source path, else relative path, else stream and file, else file, each with its prefix."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(F.concat(F.lit("source:"), some(source)), F.concat(F.lit("relative:"), some(relative)), F.concat(F.lit("stream:"), some(stream), F.lit("/"), some(filename)), F.concat(F.lit("file:"), some(filename)))


def effective_type(base: Column, override: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(override), F.lit("")), base)


def merged_type(a: Column, b: Column) -> Column:
    """The common type, or the only one that is not blank, else blank."""
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when(x == y, x).when(x == "", y).when(y == "", x).otherwise("")


#: One-letter codes of segment types, and what answers call the types of the reviewed sets.
TYPE_CODES = {"performance": "P", "ceremony": "C", "warmup": "W", "dance": "D", "audience": "A", "rehearsal": "R", "other": "O"}


def type_code(kind: Column) -> Column:
    return F.coalesce(*(F.when(F.lower(F.trim(kind)) == k, F.lit(v)) for k, v in TYPE_CODES.items()), F.lit("?"))


#: Classes of the number of people, and words for them.
PEOPLE_CLASSES = ("no_visible_people", "solo", "duet_trio", "quartet", "small_group", "large_group")
PEOPLE = {
    "none": "no_visible_people", "no_people": "no_visible_people", "no visible people": "no_visible_people", "soloist": "solo", "single": "solo",
    "pair": "duet_trio", "duet": "duet_trio", "two": "duet_trio", "trio": "duet_trio", "triplet": "duet_trio", "tritrio": "duet_trio", "tri_trio": "duet_trio", "tri-trio": "duet_trio", "three": "duet_trio",
    "four": "quartet", "4plus": "small_group",
}


def canonical_people_count(value: Column) -> Column:
    """One of PEOPLE_CLASSES, from a class, a word or a number (N+ counts as N + 1); null for anything else."""
    v = F.lower(F.trim(value))
    n = F.regexp_extract(v, r"^(\d{1,9})\+?$", 1).try_cast("long") + F.when(v.endswith("+"), 1).otherwise(0)
    of_number = F.when(n == 0, "no_visible_people").when(n == 1, "solo").when(n <= 3, "duet_trio").when(n == 4, "quartet").when(n <= 10, "small_group").when(n > 10, "large_group")
    return F.coalesce(F.when(v.isin(*PEOPLE_CLASSES), v), *(F.when(v == k, F.lit(c)) for k, c in PEOPLE.items()), of_number)


def normalize_rel_path(path: Column) -> Column:
    """The path if it is relative and posix, without . or .. parts, backslashes and outer blanks; else null."""
    bad = path.startswith("/") | path.contains("\\") | (F.trim(path) != path) | path.rlike(r"(^|/)\.{1,2}(/|$)") | path.contains("//") | (path == "")
    return F.when(~bad, path)


def stream_filter(stream: Column, tokens: list[str]) -> Column:
    """photo(s)/image(s)/video(s) select streams by prefix, other tokens are stream ids; no token selects all."""
    if not tokens:
        return F.lit(True)
    tests = [stream.startswith("p-") if t.lower().rstrip("s") in ("photo", "image") else stream.startswith("v-") if t.lower().rstrip("s") == "video" else stream == t for t in tokens]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def quality_flags(focus: Column, brightness: Column, p95: Column, clip: Column, contrast: Column) -> dict[str, Column]:
    return {"flag_blurry": (focus < 0.0005).cast("int"), "flag_dark": (brightness < 0.20).cast("int"), "flag_overexposed": ((p95 >= 0.98) | (clip >= 0.02)).cast("int"), "flag_low_contrast": (contrast < 0.08).cast("int"), "blur_score": 1 / (1 + 1000 * focus)}


def decision_confidence(positive: Column, p: Column) -> Column:
    return F.when(positive, p).otherwise(1 - p)


def mode_with_tiebreak(values: Column, preferred: Column) -> Column:
    """The most frequent of a short array; of several the preferred one if it is among them, else the smallest."""
    scored = F.transform(F.array_distinct(values), lambda x: F.struct((-F.size(F.filter(values, lambda y: y == x))).alias("n"), F.coalesce(x != preferred, F.lit(True)).alias("p"), x.alias("x")))
    return F.get(F.array_sort(scored), 0)["x"]
