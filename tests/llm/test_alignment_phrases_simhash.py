"""Token alignment, phrases and SimHash against brute force and SQL, on small and awkward tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from eventweave.llm import alignment, kernels, phrases, simhash
from eventweave.llm.bpe import _byte_symbols

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, code long, batch long, fp long, word string"


def docs(spark, rows):
    """Rows of (doc_id, text, lang), with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1, 2, 3, 4, "w") for i, t, lang in rows], DOCS).repartition(3)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w" + str(r.randrange(vocabulary)) for _ in range(n))


AWKWARD = [None, "", "  \n\t", "one", "one", "two words", "<|endoftext|> <s></s> <0x41> 'll", "\u2581 piece", "a\u0000b", "x" * 5000, "ab " * 900, "é日本 👍🏽\n\n  tabs\tand  blanks ", "=" * 3000, "Straße und Öl", "\ufeffbom", "1234567890" * 50, prose(5, 20000)]


def brute_alignment(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    tok.no_padding()
    tok.no_truncation()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sym = _byte_symbols()
    a_bytes = {v: bytes(sym[c] for c in k) for k, v in tok.get_vocab().items() if k != "<|endoftext|>"}
    b_bytes = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("\u2581", " ").encode()
    found = []
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        raw = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != raw or b"".join(map(b_bytes, b)) != raw:
            found.append(None)
            continue
        ends = [set(np.cumsum([len(f(i)) for i in ids]).tolist()) for f, ids in ((a_bytes.__getitem__, a), (b_bytes, b))]
        groups, at, left = [], 0, [list(a), list(b)]
        sides, size = [[], []], [0, 0]
        for cut in sorted(ends[0] & ends[1]):
            group = []
            for k, f in enumerate((a_bytes.__getitem__, b_bytes)):
                own = []
                while size[k] < cut:
                    own.append(left[k].pop(0))
                    size[k] += len(f(own[-1]))
                group.append(own)
            groups.append(group)
        found.append((a, b, groups, Counter((x, y) for u, v in groups for x in u for y in v)))
    held = Counter(pair for f in found if f for pair in f[3])
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for f in found:
        if not f:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        said = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        out.append((len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in links.items()), hashlib.sha256(said.encode()).hexdigest()))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_brute(spark, monkeypatch):
    rows = [(i, t, "en") for i, t in enumerate([*AWKWARD, *(prose(k, 40 + k) for k in range(20)), prose(3, 43)])]
    want = brute_alignment([t for _, t, _ in rows])
    assert want[0][-1] == want[1][-1] == "" and sum(w[0] > 0 for w in want) > 20
    for batch, step, listed in ((1 << 24, 1 << 19, 1 << 12), (2000, 500, 2)):
        for name, value in (("BATCH_BYTES", batch), ("STEP_BYTES", step), ("LISTED", listed)):
            monkeypatch.setattr(alignment, name, value)
        out = alignment.align(docs(spark, rows), digest=True).withColumnRenamed("groups", "groups_sha256").collect()
        assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in out} == {i: w for (i, _, _), w in zip(rows, want, strict=True)}


def test_alignment_repeated_and_null_ids(spark):
    out = alignment.align(docs(spark, [(None, "a b", "en"), (7, "a b", "en"), (7, "a b", None)])).collect()
    assert sorted((r["doc_id"] or 0, r["count_sum"] // r["n_links"], r["n_best"] - r["n_links"]) for r in out) == [(0, 3, 0), (7, 3, 0), (7, 3, 0)]
    assert out[0]["groups"].count(";") == out[0]["n_groups"] - 1
    assert alignment.align(docs(spark, [])).collect() == []


def test_groups_without_cut():
    """Intervals whose sides end together at both borders only are one group, however long."""
    ends_a, ends_b = np.array([*range(2, 400, 2), 401, 403]), np.array([*range(1, 400, 2), 401, 403])
    out = alignment.groups(ends_a, ends_b, np.array([0, len(ends_a)]), np.array([0, len(ends_b)]))
    assert out.T.tolist() == [[0, len(ends_a) - 1, 0, len(ends_b) - 1], [len(ends_a) - 1, len(ends_a), len(ends_b) - 1, len(ends_b)]]


def phrase_rows():
    r = random.Random(8)
    names = ["New York City", "new york", "of the", "in spite of the", "a b a b a b", "Öl und Gas", "x\ty z"]
    rows = []
    for i in range(400):
        words = [r.choice(names) if r.random() < 0.4 else "w" + str(r.randrange(30)) for _ in range(60)]
        sep = r.choice([" ", "  ", "\t", ", ", ". ", "\n"])
        rows.append((i, sep.join(words), r.choice(["en", "en", "de", None])))
    return [*rows, (900, None, "en"), (901, "", "fr"), (902, ".,;", None), (903, "a b " * 4000, "en"), (903, "a b " * 4000, "en"), (None, "of the " * 150, "en"), (904, "solo", "it")]


def as_sql(rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    return sorted(con.execute(phrases.ORACLE_SQL).fetchall())


def test_phrases_sql(spark, monkeypatch):
    rows = phrase_rows()
    want = as_sql(rows)
    assert len(want) > 30 and {w[0] for w in want} == {"en", "de", "und"}
    for batch, gathered, bits, part in ((8 << 20, 1 << 21, 1 << 28, 1 << 17), (4000, 50, 1 << 10, 150)):
        for name, value in (("BATCH_BYTES", batch), ("GATHERED", gathered), ("FILTER_BITS", bits), ("PART_WORDS", part)):
            monkeypatch.setattr(phrases, name, value)
        assert sorted(tuple(r) for r in phrases.collocations(docs(spark, rows)).collect()) == want


def test_phrases_few_and_none(spark):
    assert phrases.collocations(docs(spark, [])).collect() == []
    assert phrases.collocations(docs(spark, [(1, None, None), (2, "a b c", "en")])).collect() == []
    top = phrases.collocations(docs(spark, [(1, "p q. r s. " * 100, "en")]), top=1).collect()
    assert [(r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in top] == [(1, "p q", 100, 100, 100, 400, 4000)]


def test_lists_of_frequent_words(spark, monkeypatch):
    """A counting task gives each batch one list of its frequent words, not a row a word, and the lists are never broadcast."""
    rows = [(k, " ".join(f"w{j}" for j in range(300)), "en") for k in range(40)]
    for gathered in (phrases.GATHERED, 50):
        monkeypatch.setattr(phrases, "GATHERED", gathered)
        both = phrases.numbered(docs(spark, rows).repartition(4)).persist()
        known = phrases.frequent(both, 10).persist()
        lists = known.where("batch is not null").collect()
        assert sum(len(x["own"]) // 4 for x in lists) == sum(len(x["to"]) // 4 for x in lists) == both.where("word is not null").count() == 4 * 300
        if gathered > 50:
            assert len(lists) == len({(x["task"], x["batch"]) for x in lists}) < 4 * 300
        sizes = known.where("word is not null").groupBy("task").count().orderBy("task").collect()
        starts = {x["task"]: sum(y["count"] for y in sizes if y["task"] < x["task"]) for x in sizes}
        sequences = phrases.renumbered(both, known, starts)
        plan = sequences._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        spelled = {x["id"]: bytes(x["word"]).decode() for x in phrases.spelled_out(known, starts).collect()}
        got = [" ".join(spelled.get(int(i), "|") for i in np.frombuffer(x["seq"], np.uint32)) for x in sequences.collect()]
        assert sorted(" | ".join(got).replace("| |", "|").strip("| ").split(" | ")) == sorted(r[1] for r in rows)


def test_stripes_travel_in_bundles(spark, monkeypatch):
    """A task gives out a row a bundle at most, however many prefixes it has, and the merged counters are those of the sequence."""
    r = random.Random(5)
    ids = [(r.randrange(1, 200) << phrases.PART_BITS) | r.randrange(2) for _ in range(200)]
    seqs = [np.array([r.choice([*ids, phrases.GAP]) for _ in range(3000)], np.uint32) for _ in range(4)]
    given = spark.createDataFrame([("en", q.tobytes()) for q in seqs], "lang string, seq binary").repartition(2).persist()
    for size, gathered in ((1, phrases.GATHERED), (2, 700)):
        monkeypatch.setattr(phrases, "GATHERED", gathered)
        rows = phrases.stripes(given, size, None, 16)
        if size == 1:
            assert rows.count() <= 2 * 16
        want = Counter()
        for q in seqs:
            full = [*q.tolist(), phrases.GAP]
            want.update(tuple(full[i : i + size + 1]) for i in range(len(full) - size) if phrases.GAP not in full[i : i + size])
        got, sums = {}, Counter()
        for x in phrases.merged(rows, size, 3).collect():
            for w, t in zip(x["next"], x["times"], strict=True):
                sums[tuple(x["prefix"])] += t
                if w != phrases.GAP:
                    assert (*x["prefix"], w) not in got
                    got[(*x["prefix"], w)] = t
        assert got == {k: t for k, t in want.items() if t >= 3 and k[-1] != phrases.GAP}
        whole = Counter()
        for k, t in want.items():
            whole[k[:-1]] += t
        assert sums == whole


def test_words_whose_hashes_collide():
    """Words of Thue-Morse form have equal polynomial hashes; they are told apart by their bytes."""
    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    low = np.frombuffer(f"{word} {other} {word} c".encode(), np.uint8)
    n = len(word)
    start, end = np.array([0, n + 1, 2 * n + 2, 3 * n + 3]), np.array([n, 2 * n + 1, 3 * n + 2, 3 * n + 4])
    number, words = phrases.distinct(low, start, end)
    assert number[0] == number[2] != number[1] and [words[k] for k in number] == [word.encode(), other.encode(), word.encode(), b"c"]
    assert kernels.span_hash(kernels.prefix_hash(low), start, end)[0] == kernels.span_hash(kernels.prefix_hash(low), start, end)[1]


def brute_fingerprint(text, size):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    """prints: (node, fingerprint); the smallest node reachable over links of at most radius bits, and over equal nodes."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if (a ^ b).bit_count() <= radius and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i, _ in prints}


def test_simhash_brute(spark):
    base = prose(1, 300)
    texts = [*AWKWARD, base, base + " tail", base.replace("w1 ", "w2 ", 1), "A B C D", "a b  c\td", prose(2, 50), prose(2, 50) + " x"]
    rows = [(i + 10, t, "en") for i, t in enumerate(texts)] + [(10, base, "en"), (None, base, "en"), (3, None, "en")]
    out = simhash.near_duplicates(docs(spark, rows), size=4).collect()
    prints = [(i, brute_fingerprint(t, 4)) for i, t, _ in rows]
    want = brute_components([p for p in prints if p[0] is not None], 4)
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"] or -1) for r in out)
    assert got == sorted((i or -1, f"{f:016x}", want.get(i, -1)) for i, f in prints)
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


@pytest.mark.parametrize(("block", "radius"), [(16_384, 4), (8, 4), (8, 3), (3, 2)])
def test_simhash_links_of_dense_and_spread_prints(spark, block, radius):
    """Fingerprints in balls around a few centres, with all distances about the radius, in blocks of several sizes."""
    r = random.Random(radius)
    prints = {}
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(60):
            prints.setdefault(centre ^ sum(1 << b for b in r.sample(range(64), r.randrange(8))), len(prints))
    for x in (0, 1, 0b111, 2**64 - 1, 2**64 - 2):
        prints.setdefault(x, len(prints))
    rows = [(int(np.uint64(x).view(np.int64)), n) for x, n in prints.items()]
    links = simhash.links(spark.createDataFrame(rows, "fp long, node long").repartition(3), radius, block).collect()
    of = {n: x for x, n in prints.items()}
    assert all((of[a] ^ of[b]).bit_count() <= radius for a, b in links)
    want = brute_components([(n, x) for x, n in prints.items()], radius)
    root = {n: n for n in of}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {n: find(n) for n in of} == want
