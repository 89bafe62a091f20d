"""Text operators against brute force, round trips and held-out rows, on small and awkward tables."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import bpe, chains, decontaminate, fingerprint, kernels, langid, minhash, quality, shared, suffix, toxicity, urlfilter
from eventweave.llm.components import components
from eventweave.llm.queries import ORACLE_SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, n int, key string, score double"


def docs(spark, rows):
    """Rows of (doc_id, text), with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, "k", 0.5) for i, t in rows], DOCS)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w" + str(r.randrange(vocabulary)) for _ in range(n))


def awkward():
    base = prose(1, 300)
    return [(1, base), (2, base), (3, base[:700] + " changed " + base[700:]), (4, None), (5, ""), (6, "  \n\t"), (7, "one"), (8, "one"), (9, "two words"), (10, prose(2, 6000)), (11, "x" * 3000), (12, "ab " * 900), (None, base), (13, "é日本 <|endoftext|> 👍🏽\n\n  'll"), (14, prose(3, 30) + base[100:900]), (7, "one")]


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(texts, k):
    sets = {i: shingles(t, k) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark):
    texts = [r for r in awkward() if r[0] is not None]
    family = prose(9, 120).split()
    r = random.Random(4)
    for i in range(60):
        w = family[:]
        for _ in range(r.randrange(1, 6)):
            w[r.randrange(len(w))] = "edit" + str(r.randrange(10**6))
        texts.append((100 + i, " ".join(w)))
    texts += [(200 + i, "licensed under these terms and no others at all " + prose(50 + i, 60)) for i in range(40)]
    want = brute_components(dict(texts).items(), 4)
    got = minhash.near_duplicates(docs(spark, [*texts, (None, family[0])]), size=4).collect()
    assert len(got) == len(texts) + 1
    for x in got:
        if x["doc_id"] is None:
            assert x["component_id"] is None and not x["kept"]
        else:
            assert (x["n_shingles"], x["component_id"], x["kept"]) == (*want[x["doc_id"]], want[x["doc_id"]][1] == x["doc_id"])


@pytest.mark.parametrize("block", [1024, 50])
def test_near_duplicates_on_one_template(spark, monkeypatch, block):
    """Texts just under the threshold to each other, some pairs of which are over it, all in the same large lists."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    base, texts = prose(61, 160, 10**6), []
    for i in range(300):
        tail = [f"own{i}x{k}" for k in range(20)]
        if i < 80:
            tail[:2] = [f"both{i // 2}x{k}" for k in range(2)]
        texts.append((i, " ".join([base, *tail])))
    want = brute_components(texts, 4)
    assert sum(c != i for i, (_, c) in want.items()) == 40
    got = minhash.near_duplicates(docs(spark, texts), size=4).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == want


def swapped_forms(turns):
    """Two words of a and b, each the other with both letters swapped; sums of powers of an odd base modulo 2^64 are equal on them."""
    bits = [0]
    for _ in range(turns):
        bits += [1 - x for x in bits]
    return tuple("".join("ab"[x ^ swap] for x in bits) for swap in (0, 1))


def test_near_duplicates_of_swapped_forms(spark):
    """Long words that differ stay apart, alone and inside of texts; equal ones meet."""
    p, q = swapped_forms(12)
    rows = [(1, p), (2, q), (3, p), (4, " ".join([p, "x", q])), (5, " ".join([q, "x", p])), (6, q + " x " + p)]
    got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(docs(spark, rows), size=4).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 4).items()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 5}


def test_word_hashes():
    """One hash for each word of any length, wherever it stands, and another one for another seed."""
    p, q = swapped_forms(12)
    r = random.Random(8)
    many = list({"".join(r.choice("ab") for _ in range(n)) for n in (*range(1, 40), 255, 256, 257, 300) for _ in range(20)} | {p, q, p[:256], q[:256]})
    raw = np.frombuffer(" ".join(many + ["zz", *many]).encode(), np.uint8)
    codes = [kernels.words(raw, np.array([0, len(raw)]), kernels.SPACES, seed)[0].tolist() for seed in (0, 1)]
    n = len(many)
    for c in codes:
        assert c[:n] == c[n + 1 :] and len(set(c[:n])) == n
    assert not set(codes[0]) & set(codes[1])


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {x: x for p in links for x in p}
    for _ in range(400):
        for a, b in links:
            m = min(root[a], root[b])
            root[a] = root[b] = m
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k in got} and all(a == b or (a in got and b in got) for a, b in links)


def brute_cut(texts, length, keep_first):
    raw = [(i, (t or "").encode()) for i, t in texts]
    seen, first = {}, {}
    for n, (i, b) in enumerate(raw):
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            seen[s] = seen.get(s, 0) + 1
            place = (i if i is not None else 1 << 63, k, n)
            first[s] = min(first.get(s, place), place)
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            if seen[s] > 1 and not (keep_first and first[s][:2] == ((i if i is not None else 1 << 63), k)):
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep_first", [False, True])
def test_suffix_dedup(spark, keep_first):
    texts = awkward()
    got = suffix.cut_texts(docs(spark, texts), keep_first=keep_first).collect()
    assert sorted(((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got), key=str) == brute_cut(texts, 200, keep_first)


def hot_lines():
    """One line of 150 bytes in many texts, each with other text around it, some of which have the same words beside the line."""
    line = "shared line of a hundred and fifty bytes " + "q" * 109
    r = random.Random(5)
    beside = [prose(900 + k, 12) for k in range(4)]
    return [(i, f"{prose(1000 + i, 20)} {r.choice(beside)} {line} {r.choice(beside)} {prose(2000 + i, 20)}") for i in range(60)]


@pytest.mark.parametrize("keep_first", [False, True])
def test_suffix_dedup_of_hot_anchors(spark, monkeypatch, keep_first):
    monkeypatch.setattr(suffix, "HOT", 8)
    texts = [*hot_lines(), *awkward()]
    got = suffix.cut_texts(docs(spark, texts), keep_first=keep_first).collect()
    want = brute_cut(texts, 200, keep_first)
    assert sorted(((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got), key=str) == want
    assert sum(x[2] > 0 for x in want) > 20


def test_earlier_matches_brute():
    r = random.Random(6)
    for _ in range(40):
        n = r.randrange(1, 40)
        place, begins = np.array(r.sample(range(100), n)), np.array([k == 0 or r.random() < 0.2 for k in range(n)])
        run = np.cumsum(begins)
        want = [any(run[j] == run[i] and place[j] < place[i] for j in range(n)) for i in range(n)]
        assert suffix.earlier_matches(place, begins).tolist() == want
        before = suffix.previous_smaller(place, begins)
        assert before.tolist() == [max([j for j in range(i) if run[j] == run[i] and place[j] < place[i]], default=-1) for i in range(n)]


def test_whole_characters():
    raw = "aéb日c".encode()
    assert suffix.whole_characters(raw, [(2, 5)]) == "aé日c" and suffix.whole_characters(raw, [(1, 3)]) == "ab日c" and suffix.whole_characters(raw, [(0, len(raw))]) == ""


def brute_hits(texts, items, width=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for i, t in texts:
        w, hit, found = word(t), set(), set()
        for item, s in items:
            p = word(s)
            n = min(width, len(p))
            for j in range(len(p) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == p[j : j + n]:
                        hit |= set(range(at, at + n))
                        found |= {str(item)} - {"None"}
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_bytes", [1 << 20, 300])
def test_decontamination(spark, max_bytes):
    items = [(1, prose(21, 40)), (2, "Two, WORDS"), (10, None), (3, ""), (4, "one"), (5, prose(1, 300)[50:200]), (5, prose(22, 12)), (6, "ONE"), (None, prose(1, 300)[50:200]), (None, prose(23, 11))]
    texts = [*awkward(), (20, "a " + prose(21, 40).replace(" ", ", ").upper() + " b"), (21, prose(21, 40)[5:]), (22, prose(22, 12) + " " + prose(22, 12)), (23, prose(23, 11))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs(spark, texts), bench, max_bytes=max_bytes).collect()
    assert sorted(((x["doc_id"], x["n_words"], x["hits"], list(x["items"])) for x in got), key=str) == brute_hits(texts, items)


def test_patterns_compare_bytes(monkeypatch):
    """With one hash for all windows every pattern of a length is in one bucket: only the bytes tell them apart."""
    items = [(k, prose(30 + k, 14)) for k in range(6)]
    monkeypatch.setattr(kernels, "windows", lambda codes, size: np.zeros(max(0, len(codes) - size + 1), np.uint64))
    bench = decontaminate.build(items, 10)
    data = np.frombuffer(" ".join(t for _, t in items).encode(), np.uint8)
    code, s, e, first = kernels.words(data, np.array([0, len(data)]), kernels.PUNCTUATION)
    at, pattern = bench.patterns[0].find(code, first, decontaminate.Spans(data, s, e), bench.words)
    row, item = bench.patterns[0].items_of(pattern)
    assert sorted(zip(at[row].tolist(), item.tolist(), strict=True)) == [(14 * k + j, k) for k in range(6) for j in range(5)]


def test_fingerprints(spark):
    texts = [(i, t) for i, t in awkward()]
    got = fingerprint.with_next(docs(spark, texts)).collect()
    assert len(got) == len(texts)
    order = sorted(((i, t or "") for i, t in texts), key=lambda r: -r[0] if r[0] is not None else 1)
    after = {(a[0], a[1]): b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    for x in got:
        if x["doc_id"] not in (7,):  # repeated rows stand next to each other
            assert x["next_text"] == after[x["doc_id"], x["text"]]
    kept = {x["text"]: list(x["kept"]) for x in got}
    assert kept[""] == [] and len(kept["one"]) == 1 and all(v == sorted(set(v)) for v in kept.values())
    one = spark.createDataFrame([(prose(1, 300), prose(1, 300) + " " + prose(5, 300))], "a string, b string")
    a, b = fingerprint.sketch(F.col("a")), fingerprint.sketch(F.col("b"))
    x = one.select(fingerprint.containment(a, b).alias("c"), fingerprint.likeness(a, a).alias("same"), (fingerprint.union(a, b) == b).alias("u"), fingerprint.likeness(a, F.array().cast("array<bigint>")).alias("none")).first()
    assert x["c"] == 1.0 and x["same"] == 1.0 and x["u"] and x["none"] == 0.0


def test_fingerprint_likeness_brute(spark):
    """Exact for texts of at most FLOOR shingles; within the error of FLOOR hashes beyond, for equal and very unequal lengths."""
    pairs = []
    for k in range(40):
        n = 20 + 40 * k
        words = prose(k, n).split()
        other = prose(900 + k, n).split()
        pairs.append((k, " ".join(words), " ".join(words[: n // 2] + other[: n - n // 2])))
        pairs.append((100 + k, " ".join(words), " ".join(words + prose(300 + k, 4 * n).split())))

    def exact(a, b):
        a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
        return (len(a & b) / len(a) + len(a & b) / len(b)) / 2, max(len(a), len(b)) < fingerprint.FLOOR

    df = spark.createDataFrame(pairs, "id int, a string, b string").select("id", fingerprint.sketch(F.col("a")).alias("a"), fingerprint.sketch(F.col("b")).alias("b"))
    got = {x["id"]: x["v"] for x in df.select("id", fingerprint.likeness(F.col("a"), F.col("b")).alias("v")).collect()}
    errors = []
    for i, a, b in pairs:
        want, short = exact(a, b)
        errors.append(abs(got[i] - want))
        assert not short or errors[-1] < 1e-9
    assert max(errors) < 0.3 and sum(errors) / len(errors) < 0.07


def test_fingerprint_runs_without_ids(spark, monkeypatch):
    """Rows without an id come last, dealt by the hash of their text."""
    monkeypatch.setattr(fingerprint, "RUN_ROWS", 20)
    rows = [(None, f"text {i}") for i in range(150)] + [(i, f"named {i}") for i in range(50)]
    table = docs(spark, rows)
    hashes = {x["text"]: x["h"] for x in table.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -hashes[r[1]]))
    got = {x["text"]: x["next_text"] for x in fingerprint.with_next(table).collect()}
    assert got == {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}


def test_fingerprint_runs_of_ids(spark):
    rows = [(i * 3, f"text {i}") for i in range(500)]
    old = fingerprint.RUN_ROWS
    fingerprint.RUN_ROWS = 40
    try:
        got = {x["doc_id"]: x["next_text"] for x in fingerprint.with_next(docs(spark, rows)).collect()}
    finally:
        fingerprint.RUN_ROWS = old
    assert got == {i * 3: f"text {(i - 1) % 500}" for i in range(500)}


def test_repeats_are_cut_in_small_batches(spark):
    """The pipeline's workers for repeated strings get batches of 4 MB, and rank few suffixes at a time."""
    import corpus_pipeline

    text = "".join(chr(97 + k * k % 23) for k in range(300))
    got = {r["doc_id"]: r["n_chars"] for r in corpus_pipeline.cut_repeats(spark, docs(spark, [(1, text), (2, text)]).selectExpr("doc_id", "text", "'en' lang", "'a' source", "0L n_chars"), "").collect()}
    assert got[1] + got[2] < 600 and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m" and suffix.RANK_AT_ONCE <= 100_000


def test_chains(spark):
    shared = prose(31, 90, 10**6)
    fuzzy = shared.split()
    for k in (20, 47, 70):
        fuzzy[k] = "other"
    texts = [(1, prose(41, 100, 10**6) + " " + shared), (2, " ".join(fuzzy) + " " + prose(42, 200, 10**6)), (3, prose(43, 150, 10**6)), (4, None), (5, ""), (6, "a b c"), (8, shared[:60]), (None, shared)]
    got = rows_of(chains.fuzzy_repeats(docs(spark, texts)))
    assert len(got) == len(texts)
    assert got[2]["n_passages"] == 1 and 80 <= got[2]["n_repeated"] <= 92 and list(got[2]["first_docs"]) == [1]
    assert all(got[i]["n_repeated"] == 0 for i in (1, 3, 4, 5, 6, 8, None)) and got[4]["n_words"] == 0


def test_chain_of_one_seed(spark):
    """An exact run all of whose seeds but one occur in earlier documents too."""
    shared = prose(51, 60, 10**6)
    pair = [(100, " ".join([prose(52, 50, 10**6), shared, prose(53, 50, 10**6)])), (101, " ".join([prose(54, 50, 10**6), shared, prose(55, 50, 10**6)]))]
    words = pair[1][1].split()
    inside = sorted(x["at"] for x in chains.seeds(docs(spark, pair)).collect() if x["doc"] == 101 and 50 <= x["at"] <= 110 - chains.KMER)
    assert len(inside) > 2
    for left in (inside[0], inside[-1]):
        earlier = [(k, " ".join(words[at : at + chains.KMER])) for k, at in enumerate(inside) if at != left]
        got = rows_of(chains.fuzzy_repeats(docs(spark, [*earlier, *pair])))
        assert (got[101]["n_repeated"], got[101]["n_passages"], list(got[101]["first_docs"])) == (60, 1, [100])
        assert all(got[i]["n_passages"] == 0 for i in got if i != 101)


def test_best_chains_brute():
    """The best chain scores what the best of all rising chains scores."""
    r = random.Random(3)
    for _ in range(60):
        x = np.array(sorted(r.randrange(150) for _ in range(14)))
        y = np.array([r.randrange(150) for _ in x])
        best = [0.0] * len(x)
        for i in range(len(x)):
            before = [best[j] - chains.GAP * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
            best[i] = chains.KMER + max([0.0, *before])
        found = chains.best_chains(x, y)
        assert sorted(i for c in found for i in c) == list(range(len(x)))
        for c in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:], strict=False))
        top = found[0]
        assert math.isclose(chains.KMER * len(top) - chains.GAP * (x[top[-1]] - x[top[0]] + y[top[-1]] - y[top[0]]), max(best))
    assert chains.common([1, 2, 3, 4], [2, 9, 4]) == 2


def test_passage_quoted_before(spark):
    """Four documents quote a quarter each of a passage that two later ones hold whole."""
    p = prose(1, 100, 10**6).split()
    rows = [(i, " ".join([prose(10 + i, 60, 10**6), *p[25 * i : 25 * i + 25], prose(20 + i, 60, 10**6)])) for i in range(4)]
    rows += [(i, " ".join([prose(30 + i, 60, 10**6), *p, prose(40 + i, 60, 10**6)])) for i in (5, 6)]
    got = rows_of(chains.fuzzy_repeats(docs(spark, rows)))
    assert (got[6]["n_repeated"], list(got[6]["first_docs"])) == (100, [5]) and all(got[i]["n_repeated"] == 0 for i in range(4))


@pytest.mark.parametrize("every", [9, 11, 15])
@pytest.mark.parametrize("rare", [0, chains.RARE])
def test_edited_passage_quoted_before(spark, monkeypatch, every, rare):
    """Four documents quote 25 words each of a passage, a later one holds it whole, and one holds it edited; with rare and frequent seeds."""
    monkeypatch.setattr(chains, "RARE", rare)
    p = prose(1, 100, 10**6).split()
    rows = [(i, " ".join([prose(10 + i, 60, 10**6), *p[25 * i : 25 * i + 25], prose(20 + i, 60, 10**6)])) for i in range(4)]
    edited = [f"edit{k}" if k % every == 0 else w for k, w in enumerate(p)]
    rows += [(10, " ".join([prose(30, 60, 10**6), *p, prose(40, 60, 10**6)])), (20, " ".join([prose(31, 60, 10**6), *edited, prose(41, 60, 10**6)]))]
    got = rows_of(chains.fuzzy_repeats(docs(spark, rows)))
    assert got[20]["n_repeated"] >= 90 and list(got[20]["first_docs"]) == [10] and all(got[i]["n_repeated"] == 0 for i in (0, 1, 2, 3))


def test_passage_with_many_copies(spark, monkeypatch):
    """Copies of the text that an edited passage is from are matched through the first of them: more copies make no more matches."""
    monkeypatch.setattr(chains, "RARE", 0)
    p = prose(1, 100, 10**6).split()
    quotes = [(i, " ".join([prose(10 + i, 60, 10**6), *p[25 * i : 25 * i + 25], prose(20 + i, 60, 10**6)])) for i in range(4)]
    whole, edited = " ".join([prose(30, 60, 10**6), *p, prose(40, 60, 10**6)]), " ".join([prose(31, 60, 10**6), *(f"edit{k}" if k % 11 == 0 else w for k, w in enumerate(p)), prose(41, 60, 10**6)])
    made = []
    for copies in (1, 8):
        d = docs(spark, [*quotes, *((10 + k, whole) for k in range(copies)), (20, edited)])
        alone = chains.with_first(chains.seeds(d), ["key"])
        known = chains.located(d, chains.matches(alone), chains.MIN_WORDS, chains.IDENTITY)
        made.append(chains.later_matches(alone, known).where("doc = 20").count())
        got = rows_of(chains.fuzzy_repeats(d))
        assert got[20]["n_repeated"] >= 90 and list(got[20]["first_docs"]) == [10]
    assert made[0] == made[1] > 0


def test_ends_of_runs_are_matched_once(spark, monkeypatch):
    """Documents that share a run of one word only: two matches for each pair of them, found by the words beside the ends, and no passage.
    A run that is longer than another, or broken in one text, still belongs to the passage around it."""
    monkeypatch.setattr(chains, "RARE", 0)
    rows = [(i, f"{prose(300 + i, 60, 10**6)} {'the ' * 25}{prose(400 + i, 60, 10**6)}") for i in range(12)]
    d = docs(spark, rows)
    alone = chains.with_first(chains.seeds(d), ["key"])
    known = chains.located(d, chains.matches(alone), chains.MIN_WORDS, chains.IDENTITY)
    assert known.count() == 0 and chains.later_matches(alone, known).count() <= 2 * 66
    a, b = prose(500, 30, 10**6), prose(501, 30, 10**6)
    rows += [(20, f"{a} {'the ' * 22}{b}"), (21, f"{prose(502, 50, 10**6)} {a} {'the ' * 26}{b}"), (22, f"{a} {'the ' * 11}x {'the ' * 10}{b} {prose(503, 50, 10**6)}")]
    got = rows_of(chains.fuzzy_repeats(docs(spark, rows)))
    assert [got[i]["n_repeated"] for i in range(12)] == [0] * 12 and got[21]["n_repeated"] == 86 and got[22]["n_repeated"] == 82


def test_common_words_brute():
    r = random.Random(4)
    for _ in range(200):
        a, b = ([r.randrange(4) for _ in range(r.randrange(90))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for u in a:
            row = [0, *_risen(row, u, b)]
        assert chains.common(a, b) == row[-1]


def _risen(row, u, b):
    left = 0
    for j, v in enumerate(b, 1):
        left = row[j - 1] + 1 if u == v else max(row[j], left)
        yield left


def test_recall_of_fuzzy_passages(spark):
    """Of edited passages (identity 0.9 and more by full alignment) at least 0.9 are found, with 0.8 of their words."""
    r, rows, want = random.Random(5), [], []
    for k in range(120):
        size, rate = (60, 80, 120)[k % 3], (0.0, 0.05, 0.1)[k // 3 % 3]
        p = prose(1000 + k, size, 10**6).split()
        q = p[:]
        for j in r.sample(range(size), int(rate * size)):
            q[j] = f"edit{r.randrange(10**6)}"
        assert chains.common([hash(w) for w in p], [hash(w) for w in q]) >= 0.9 * size
        rows += [(2 * k, " ".join([prose(5000 + k, 40, 10**6), *p, prose(6000 + k, 40, 10**6)])), (2 * k + 1, " ".join([prose(7000 + k, 40, 10**6), *q, prose(8000 + k, 40, 10**6)]))]
        want.append((2 * k + 1, size))
    got = rows_of(chains.fuzzy_repeats(docs(spark, rows)))
    assert np.mean([got[i]["n_repeated"] >= 0.8 * size for i, size in want]) >= 0.9


def test_passages_in_awkward_tables(spark):
    """Repeated rows are one document, copies are found whole, a very long text is read whole, ties go to the smallest doc_id."""
    long = prose(71, 30000, 10**6)
    rows = [(1, prose(72, 80, 10**6)), (1, prose(72, 80, 10**6)), (2, prose(72, 80, 10**6)), (3, long), (4, prose(73, 50, 10**6) + " " + " ".join(long.split()[-60:]))]
    got = chains.fuzzy_repeats(docs(spark, rows)).collect()
    assert sorted((x["doc_id"], x["n_repeated"], tuple(x["first_docs"])) for x in got) == [(1, 0, ()), (1, 0, ()), (2, 80, (1,)), (3, 0, ()), (4, 60, (3,))]


def test_bpe_equals_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    r = random.Random(7)
    texts = [*awkward(), *((1000 + i, "".join(r.choice("abcdehlost' \n-=_!?19éßñ日👍  \x1d\t") for _ in range(200))) for i in range(150))]
    got = {(x["doc_id"], x["ids_sha256"], x["n_tokens"], x["decoded_sha256"]) for x in bpe.digests(docs(spark, texts)).collect()}
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert (i, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), len(ids), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()) in got
    back = bpe.decode(bpe.encode(docs(spark, texts)))
    assert sorted((x["doc_id"], x["text"]) for x in back.where("doc_id > 8").collect()) == sorted((i, t or "") for i, t in texts if i and i > 8)


def test_bpe_memory_turns(monkeypatch):
    texts = [t for _, t in awkward() if t] + [prose(i, 40, 80) for i in range(6)]
    want = [bpe.Bpe(bpe.vocabulary_path()).encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    small = bpe.Bpe(bpe.vocabulary_path())
    assert [small.encode(t) for t in texts * 2] == want * 2 and small.known.old


def labelled(spark, n=600):
    r = random.Random(11)
    rows, marks = [], []
    for i in range(n):
        words = prose(i, 40, 200).split()
        bad = r.random() < 0.3
        if bad:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["vile", "nasty", "rotten"]))
        rows.append((i, " ".join(words)))
        marks.append((i, r.randint(0, 1), int(bad)))
    return docs(spark, [*rows, (n, None), (n + 1, ""), (None, "vile")]), spark.createDataFrame([*marks, (n, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), dict((i, t) for i, _, t in marks)


def test_toxicity(spark):
    d, marks, truth = labelled(spark)
    model = toxicity.train(d.where(~toxicity.held_out()), marks)
    got = toxicity.score(d, model).collect()
    assert len(got) == 603 and all(0 <= x["score"] <= 1 for x in got)
    test = [(x["score"], truth[x["doc_id"]]) for x in got if x["doc_id"] in truth and zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1]
    assert np.mean([(s >= toxicity.THRESHOLD) == bool(t) for s, t in test]) > 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {x["doc_id"]: x for x in toxicity.op6_toxicity(spark, sf).collect()}
    marks = [(got[x["doc_id"]], x["toxic"]) for x in spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect() if x["doc_id"] in got]
    test = [(x["predicted"], t) for x, t in marks if x["held_out"]]
    both = sum(p and t for p, t in test)
    assert len(test) > 100 and both >= 0.9 * sum(t for _, t in test) and both >= 0.9 * sum(p for p, _ in test)


def brute_grams(word, n):
    z = " " + word + " "
    return [z[max(0, i - n + 1) : i + 1] for i in range(1, len(z))]


def test_kneser_ney_brute(spark):
    """Counts of every order, and the probabilities that the levels give, against plain Python on few words."""
    r = random.Random(8)
    words = ["".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(120)]
    rows = [(i, w, i % 3 == 0) for i, w in enumerate(words)]
    counted = toxicity.gram_counts(spark.createDataFrame([(i, w, int(t)) for i, w, t in rows], "doc_id long, text string, toxic int"))
    raw = {}
    for _, w, t in rows:
        for g in brute_grams(w, toxicity.ORDER):
            raw.setdefault(g, [0, 0])[t] += 1
    name = lambda k: int(k).to_bytes(8, "big").lstrip(b"\0").decode()
    assert {name(x["gram"]): [x["n0"], x["n1"]] for x in counted.collect()} == raw
    counts = {toxicity.ORDER: {g: n for g, n in raw.items() if len(g) == toxicity.ORDER}}
    for k in range(toxicity.ORDER - 1, 0, -1):
        counts[k] = {g: n[:] for g, n in raw.items() if len(g) == k}
        for g, n in counts[k + 1].items():
            for c in (0, 1):
                counts[k].setdefault(g[1:], [0, 0])[c] += n[c] > 0
    built = toxicity.levels(counted.persist())
    for level in built:
        want = counts[level.order] if level.order >= toxicity.LOWEST else {g: [sum(n)] * 2 for g, n in counts[level.order].items()}
        assert {name(g): list(map(int, n)) for g, n in zip(level.gram, level.n, strict=True)} == want
    model = toxicity.Model(built)

    def p(g, c):
        if not g:
            return 1 / 256
        level = next(x for x in built if x.order == len(g))
        table = counts[len(g)] if len(g) >= toxicity.LOWEST else {h: [sum(n)] * 2 for h, n in counts[len(g)].items()}
        around = {h: n[c] for h, n in table.items() if h[:-1] == g[:-1]}
        total, d = sum(around.values()), level.discount[c]
        if not around:
            return p(g[1:], c)
        own = max(around.get(g, 0) - d, 0) / max(total, 1)
        left = 1 - sum(max(n - d, 0) for n in around.values()) / max(total, 1)
        return own + (min(max(left, 1e-9), 1) if total else 1) * p(g[1:], c)

    for w in ["abc", "cab", "aaaaaaa", "zz", words[0]]:
        want = sum(math.log(p(g, 1)) - math.log(p(g, 0)) for g in brute_grams(w, toxicity.ORDER))
        low = np.frombuffer(w.encode(), np.uint8)
        assert abs(model.word_ratios(low, np.array([0]), np.array([len(w)]))[0] - want) < 1e-3


def test_toxicity_keeps_rare_grams(spark):
    """An n-gram that stands once among a hundred thousand is in its level, though with little weight."""
    once, often = (int.from_bytes(w, "big") for w in (b"rarely ", b"common "))
    counted = spark.createDataFrame([(once, 1, 1), (often, 100_000, 100_000)], "gram long, n0 long, n1 long")
    top = toxicity.levels(counted)[0]
    assert top.gram.tolist() == sorted((once, often)) and top.order == toxicity.ORDER
    rare = top.gram.tolist().index(once)
    assert (top.own[rare] >= 0).all() and top.n[rare].tolist() == [1, 1]
    assert abs(toxicity.scale(counted)[1] - 10.5).max() < 1e-9


@pytest.mark.parametrize("z", [False, True])
def test_toxicity_by_joins(spark, monkeypatch, z):
    """A model that stays in Spark gives the differences of the one that is sent, also where texts come squeezed and labels are many."""
    d, marks, _ = labelled(spark)
    d = d.unionByName(docs(spark, [(7, "ümlaut vile " * 3), (7, "vile"), (7, "vile")]))
    many = d.unionByName(docs(spark, [(-1, "calm sea " * 700_000)])) if z else d
    if z:
        monkeypatch.setattr(shared, "BROADCAST_LABELS", 0)
        monkeypatch.setattr(toxicity, "DEALT", 1000)
    got = []
    for limit in (toxicity.BROADCAST_GRAMS, 0):
        monkeypatch.setattr(toxicity, "BROADCAST_GRAMS", limit)
        model = toxicity.train(many.where(~toxicity.held_out()), marks)
        assert isinstance(model, toxicity.Model if limit else toxicity.Tables)
        got.append(sorted((str(x["doc_id"]), x["text"] or "", x["x"]) for x in toxicity.described(many, model, ("doc_id", "text")).collect()))
    assert [x[:2] for x in got[0]] == [x[:2] for x in got[1]]
    assert max(abs(a[2] - b[2]) for a, b in zip(*got, strict=True)) < 1e-5 and sum(x[2] > 0 for x in got[1]) > 20


@pytest.mark.parametrize("rows", [[], [(1, "vile " * 300_000), (2, "calm"), (2, "calm"), (None, None)]])
def test_toxicity_in_awkward_tables(spark, rows):
    d = docs(spark, rows)
    marks = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").selectExpr("*", "'y' as text")
    got = toxicity.score(d, toxicity.train(d, marks)).collect()
    assert sorted(str(x["doc_id"]) for x in got) == sorted(str(i) for i, _ in rows) and all(0 <= x["score"] <= 1 for x in got)
    assert len({x["score"] for x in got if x["doc_id"] == 2}) <= 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_pipeline_drops_toxic_rows_by_joins(spark, monkeypatch):
    """The pipeline's first stage keeps the same rows, unchanged, where its model is joined instead of sent."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    rows = shared.table(spark, sf, "documents")
    kept = []
    for limit in (toxicity.BROADCAST_GRAMS, 0):
        monkeypatch.setattr(toxicity, "BROADCAST_GRAMS", limit)
        kept.append(sorted(map(str, corpus_pipeline.drop_toxic(spark, rows, sf).collect())))
    assert kept[0] == kept[1] and set(kept[0]) <= set(map(str, rows.select(*corpus_pipeline.COLUMNS).collect()))


def test_toxicity_curve_of_all_rows(spark):
    """The curve is that of all rows, also beyond 20,000; the last of them speak another way than the first."""
    r = random.Random(11)
    rows = [(x := r.gauss(0, 2), float(r.random() < 1 / (1 + math.exp(-(x - 1 if k < 20_000 else 0.3 * x + 1))))) for k in range(30_000)]
    got = toxicity.fit(spark.createDataFrame(rows, "x double, y double").repartition(4))
    x, y = (np.array(c) for c in zip(*rows, strict=True))
    middle, scale = x.mean(), x.std()
    z, w = np.stack((np.ones(len(x)), (x - middle) / scale), 1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2), z.T @ (y - p) - 1e-2 * w)
    assert np.allclose(got, [w[0] - w[1] / scale * middle, w[1] / scale], atol=1e-7)


def test_toxicity_without_labels(spark):
    d, marks, _ = labelled(spark, 30)
    model = toxicity.train(d, marks.where("doc_id < 0"))
    assert {x["score"] < 0.01 for x in toxicity.score(d, model).collect()} == {True}


def test_language(spark):
    a, b = ["lorem", "dolor", "amet", "sit", "elit"], ["über", "straße", "haus", "und", "nicht"]
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(a if i % 2 else b) for _ in range(30)), "la" if i % 2 else "de") for i in range(60)]
    d = spark.createDataFrame([*rows, (100, None, "de"), (101, "123 ...", "la"), (102, "", None), (103, "́", None)], "doc_id long, text string, lang string")
    got = rows_of(langid.predict(d, langid.learn(d.where(~langid.held_out()))))
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows) and {got[i]["lang_pred"] for i in (100, 101, 102, 103)} == {"und"} and got[100]["score"] == 0.0
    assert {x["lang_pred"] for x in langid.predict(d, []).collect()} == {"und"}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    real = spark.read.parquet(f"{sf}/documents.parquet").where("lang is not null and text is not null").select("doc_id", "lang")
    got = langid.op8_language(spark, sf).join(real, "doc_id").where("held_out and lang_pred <> 'und'").select((F.col("lang") == F.col("lang_pred")).alias("right")).collect()
    assert len(got) > 200 and np.mean([x["right"] for x in got]) >= 0.98


def test_language_in_awkward_tables(spark):
    long = "straße und haus " * 100_000
    rows = [(1, long, "de"), (1, long, "de"), (2, "lorem dolor amet", "la"), (3, "straße und haus", "de"), (4, "lorem dolor amet", "zz")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "9.0 as score", "1 as code")
    got = langid.predict(d, langid.learn(d)).collect()
    assert [x["lang_pred"] for x in got if x["doc_id"] in (1, 3)] == ["de"] * 3
    assert {x["lang_pred"] for x in got if x["doc_id"] in (2, 4)} == {"la"}  # equal profiles: the first by name
    assert len(got) == 5 and all(0 <= x["score"] <= 1 for x in got)
    assert langid.predict(d.where("doc_id < 0"), langid.learn(d.where("doc_id < 0"))).count() == 0


def test_quality_of_long_and_repeated_rows(spark):
    d = docs(spark, [(1, "fine words " * 200_000), (2, "other words"), (2, "other words"), (None, None)])
    out = quality.resampled(d, d.where("doc_id = 1").select("doc_id", "text"), 0.5).collect()
    assert len(out) == 4 and sum(x["selected"] for x in out) == 2 and not any(math.isnan(x["key"]) for x in out)
    assert len({x["key"] for x in out if x["doc_id"] == 2}) == 1


def test_quality(spark):
    d, marks, _ = labelled(spark, 400)
    target = d.join(marks, "doc_id").where("quality = 1").select("doc_id", "text")
    out = quality.resampled(d, target, 0.25).collect()
    assert sum(x["selected"] for x in out) == int(0.25 * len(out))
    low = min(x["key"] for x in out if x["selected"])
    assert all(x["selected"] or x["key"] <= low for x in out)
    empty = [x for x in out if x["n_grams"] == 0]
    assert len(empty) == 2 and all(x["log_weight"] == 0 for x in empty) and not any(math.isnan(x["key"]) for x in out)
    none = quality.resampled(d, target.where("doc_id < 0"), 0.25)
    assert none.where("log_weight <> 0").count() == 0


def test_cut_narrows(spark):
    """Spread keys, keys with many ties, a single key, and ids that are null, negative or far apart."""
    last = (1 << 63) - 1
    spread = [((i * 7919) % 5000 / 10.0, i) for i in range(5000)]
    tied = [(float(i % 3), i * i) for i in range(900)] + [(1e300, 5), (-1e300, 6), (1.0, None), (1.0, None)]
    single = [(2.5, i) for i in (None, -last, last - 1, last - 3, 0, 7, 7, -4)]
    for rows, places in ((spread, (1, 1234, 5000)), (tied, (1, 2, 300, 302, 500, 603, 604, 904)), (single, range(1, 9))):
        keys = spark.createDataFrame(rows, "key double, doc_id long").coalesce(2).cache()
        want = sorted(((k, last if i is None else i) for k, i in rows), key=lambda r: (-r[0], r[1]))
        assert [quality.cut_at(keys, k) for k in places] == [want[k - 1] for k in places]
    assert quality.cut_at(keys, 0) is None and quality.cut_at(keys, 9) is None


def test_quality_weights_brute(spark):
    """Weights from n-gram buckets against plain counting with the same buckets, and repeated rows with the same key."""
    rows = [(i, prose(i % 7, 5 + i, 30)) for i in range(40)] + [(3, prose(3, 8, 30)), (90, None), (91, "")]
    good = [r for r in rows if r[0] % 4 == 0]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.resampled(d, spark.createDataFrame(good, "doc_id long, text string")).collect()

    def grams(t):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        words = kernels.words(raw, np.array([0, len(raw)]), kernels.SPACES)[0]
        pairs = [kernels.windows(words[k : k + 2], 2)[0] for k in range(len(words) - 1)]
        return [int(g) >> (64 - quality.BUCKET_BITS) for g in [*words, *pairs]]

    def counts(part):
        total = [1] * quality.BUCKETS
        for _, t in part:
            for g in grams(t):
                total[g] += 1
        return total, sum(total)

    (top, n_top), (base, n_base) = counts(good), counts(rows)
    weight = lambda t: sum(math.log(top[g] / n_top) - math.log(base[g] / n_base) for g in grams(t))
    assert sorted((x["doc_id"], round(x["log_weight"], 6)) for x in out) == sorted((i, round(weight(t), 6) + 0.0) for i, t in rows)
    assert sum(x["selected"] for x in out) in (len(rows) // 2, len(rows) // 2 + 1)
    assert len({x["key"] for x in out if x["doc_id"] == 3}) == len({x["log_weight"] for x in out if x["doc_id"] == 3})


URLS = [(1, "http://a.example.org/es/1"), (2, "https://X.Example.ORG/en/12?q#f"), (3, "http://example.org/de/"), (4, "http://m.b.com/fr/x"), (5, "http://b.com/de/x"), (6, "http://c.net/x/"), (7, "https://www.c.net/x?y"), (8, None), (9, "no scheme"), (10, "://"), (11, "http://c.net/z"), (12, "http://notcom/fr/"), (13, "http://a.org"), (13, "http://a.org"), (14, "http://c.net/x?id=1"), (15, "http://c.net/x?id=2#f"), (16, "http://m.c.net/x?id=2"), (17, "http://c.net/l?" + "z" * 5000), (18, "https://c.net/l?" + "z" * 5000)]
#: Pages whose text is junk; the others at their addresses are blocked with them.
JUNK = {6: "<p>a ### b", 15: "so***", 8: "$$$", 9: "%%%", 17: "###", 13: "***"}


def url_pages(spark):
    rows = [(i, u, JUNK.get(i, None if i == 1 else "fine 50% * #"), "h", "c") for i, u in URLS]
    return spark.createDataFrame(rows, "page_id long, url string, html string, hit string, canonical string")


def test_url_filter(spark):
    pages = url_pages(spark)
    got = {x["page_id"]: (x["host"], x["path"], x["rule"], x["verdict"]) for x in urlfilter.judge(pages, urlfilter.junk_addresses(pages)).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[2] == ("x.example.org", "/en/12", "example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block") and got[6] == ("c.net", "/x/", None, "block") and got[7][3] == got[11][3] == got[14][3] == "allow"
    assert got[15][3] == got[16][3] == got[17][3] == got[18][3] == "block"
    assert got[8] == got[9] == ("", "", None, "allow") and got[10] == ("", "", None, "allow") and got[12][2] is None and got[13] == ("a.org", "", None, "block")
    assert urlfilter.judge(pages.limit(0), urlfilter.junk_addresses(pages.limit(0))).count() == 0
    assert {x["verdict"] for x in urlfilter.judge(pages, urlfilter.junk_addresses(pages.limit(0))).where("rule is null").collect()} == {"allow"}


def test_url_filter_sql(spark):
    import duckdb

    con = duckdb.connect()
    pages = url_pages(spark)
    con.sql("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", [tuple(x)[:3] for x in pages.collect()])
    got = urlfilter.judge(pages, urlfilter.junk_addresses(pages)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.sql(ORACLE_SQL["op10_url_filter"]).fetchall(), key=str)


@pytest.mark.parametrize("op", ["near", "suffix", "decontaminate", "bpe", "chains", "language", "quality", "fingerprint"])
def test_empty_tables(spark, op):
    d = docs(spark, [(1, "x")]).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    run = {
        "near": lambda: minhash.near_duplicates(d), "suffix": lambda: suffix.cut_texts(d), "decontaminate": lambda: decontaminate.decontaminate(d, bench), "bpe": lambda: bpe.digests(d), "chains": lambda: chains.fuzzy_repeats(d), "language": lambda: langid.predict(d, langid.learn(d)),
        "quality": lambda: quality.resampled(d, d.select("doc_id", "text")), "fingerprint": lambda: fingerprint.with_next(d),
    }
    assert run[op]().count() == 0


def test_kernel_words():
    text = "Ab  cD\té x"
    raw = np.frombuffer(text.encode(), np.uint8)
    code, s, e, first = kernels.words(raw, np.array([0, len(raw)]), kernels.SPACES)
    assert [text.encode()[a:b].decode() for a, b in zip(s, e, strict=True)] == ["Ab", "cD", "é", "x"] and list(first) == [0, 4]
    other = np.frombuffer(b"zz ab", np.uint8)
    assert kernels.words(other, np.array([0, 5]), kernels.SPACES)[0][1] == code[0]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        before, d = d, c.stored(stage(spark, d.withColumn("score", F.lit("x")), sf), "t")
        assert d.columns == list(c.COLUMNS) and 0 < d.count() <= before.count(), name
    assert c.STAGES[-1][1](spark, d, sf).count() == d.count()
