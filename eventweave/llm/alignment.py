"""Alignment of the tokens of two tokenizers over the same bytes, by divide and conquer at shared cuts.

1. Each text is encoded by a byte-level BPE vocabulary (A, with a space before the text) and by a sentence-piece model (B). Both
   become lists of byte ends over the same bytes.
2. An interval of tokens is cut at a byte where tokens of both end. The cut is looked for near its middle: ends of A by growing distance
   from the middle one, each found among the ends of B by bisection. Both halves are cut in the same way; an interval without a cut is a
   leaf, a group. All open intervals of a slice of texts take a step together, so a step is a few array operations.
3. Tokens of A and B in one group are linked. A batch of texts gives one row for each linked pair of ids, with the number of its texts
   that hold the pair; those rows are summed over the corpus, and what was summed goes back to the batches that asked for it. So nothing
   grows in a task or on the driver, and a pair that all texts hold is one row a batch.

Defined results: null and empty texts, and texts whose joined token bytes differ from those of a space and the text, have no tokens:
zeros and an empty groups column; each row of docs counts as a text of its own, also where a doc_id is repeated or null; ties of the
highest count all count as best; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm import kernels as K
from eventweave.llm.bpe import VOCABULARY, _byte_symbols, vocabulary_path
from eventweave.llm.shared import stored, table

PIECES = "piece_bpe_32k.model"
#: Bytes of text whose linked pairs are counted together, and of text that is aligned in one step. A longer text is one of its own.
BATCH_BYTES = 16 << 20
STEP_BYTES = 1 << 19
#: Links of a group up to which they are listed one by one; beyond, the distinct ids of both sides are paired.
LISTED = 1 << 12
ALIGNED = "batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, times binary, code long, texts long"


class Tokens:
    """Both encoders and the bytes of their tokens; a task's own."""

    def __init__(self, vocabulary: str, pieces: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = _byte_symbols()
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(symbol[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.size_a, self.size_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for t, i in ranks.items():
            self.bytes_a[i] = t
        piece = self.b.id_to_piece
        self.bytes_b = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.size_b)]
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        names = [str(i).encode() for i in range(max(self.size_a, self.size_b))]
        #: Decimal ids and what follows them: A inside and at the end of its side of a group, B inside and at the end of a group.
        self.names = np.array([n + after for size, after in ((self.size_a, b","), (self.size_a, b"|"), (self.size_b, b","), (self.size_b, b";")) for n in names[:size]], object)

    def encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B of each text, or None where their bytes are not those of a space and the text."""
        out: list[tuple[list[int], list[int]] | None] = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a = self.a.encode_ordinary(" " + text) if text else []
            raw = b" " + text.encode()
            same = bool(a) and b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw
            out.append((a, b) if same else None)
        return out


def groups(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> np.ndarray:
    """Leaf intervals (first token of A, token after the last, and the same of B), in order, of texts whose tokens begin at first_*."""
    lo, hi, blo, bhi = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    reach = np.zeros(len(lo), np.int64)
    leaves = []
    while len(lo):
        whole = (hi - lo < 2) | (bhi - blo < 2)
        if whole.any():
            leaves.append(np.stack((lo, hi, blo, bhi))[:, whole])
            lo, hi, blo, bhi, reach = (x[~whole] for x in (lo, hi, blo, bhi, reach))
            if not len(lo):
                break
        middle = (lo + hi - 2) // 2
        low, high = np.maximum(lo, middle - reach), np.minimum(hi - 2, middle + reach)
        many = high - low + 1
        own = np.repeat(np.arange(len(lo)), many)
        probe = low[own] + np.arange(len(own)) - (np.cumsum(many) - many)[own]
        at = np.searchsorted(ends_b, ends_a[probe])
        hit = np.flatnonzero(ends_b[at] == ends_a[probe])  # the last end of A is one of B, so there is a place for each
        own, probe, at = own[hit], probe[hit], at[hit]
        order = np.lexsort((np.abs(probe - middle[own]), own))
        order = order[np.concatenate(([True], own[order][1:] != own[order][:-1]))] if len(order) else order
        own, probe, at = own[order], probe[order] + 1, at[order] + 1
        cut = np.zeros(len(lo), bool)
        cut[own] = True
        none = ~cut & (low == lo) & (high == hi - 2)
        leaves.append(np.stack((lo, hi, blo, bhi))[:, none])
        wait = ~cut & ~none
        zero = np.zeros(2 * len(own), np.int64)
        lo, hi, blo, bhi, reach = (
            np.concatenate((lo[own], probe, lo[wait])),
            np.concatenate((probe, hi[own], hi[wait])),
            np.concatenate((blo[own], at, blo[wait])),
            np.concatenate((at, bhi[own], bhi[wait])),
            np.concatenate((zero, 4 * reach[wait] + 2)),
        )
    out = np.concatenate(leaves, 1) if leaves else np.zeros((4, 0), np.int64)
    return out[:, np.argsort(out[0])]


def linked(a: np.ndarray, b: np.ndarray, leaf: np.ndarray, text_of: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text << 40 | pair code), sorted, and how often each is linked."""
    lo, hi, blo, bhi = leaf
    n = (hi - lo) * (bhi - blo)
    small = np.flatnonzero(n <= LISTED)
    g = np.repeat(small, n[small])
    k = np.arange(len(g)) - np.repeat(np.cumsum(n[small]) - n[small], n[small])
    wide = (bhi - blo)[g]
    i, j = lo[g] + k // wide, blo[g] + k % wide
    keys = [(text_of[i] << 40) | (a[i] * size_b + b[j])]
    times = [np.ones(len(g), np.int64)]
    for g in np.flatnonzero(n > LISTED):
        x, nx = np.unique(a[lo[g] : hi[g]], return_counts=True)
        y, ny = np.unique(b[blo[g] : bhi[g]], return_counts=True)
        keys.append(((text_of[lo[g]] << 40) | (x[:, None] * size_b + y)).ravel())
        times.append((nx[:, None] * ny).ravel())
    if len(keys) == 1:
        return np.unique(keys[0], return_counts=True)
    key, t = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, t = key[order], t[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(t, first) if len(first) else t


def described(tokens: Tokens, found: list[tuple[list[int], list[int]] | None]) -> list[tuple | None]:
    """n_a, n_b, n_groups, n_links, the groups as text, distinct pair codes and how often each is linked, of each text that has tokens."""
    there = [k for k, f in enumerate(found) if f]
    out: list[tuple | None] = [None] * len(found)
    if not there:
        return out
    a, b = (np.array([i for k in there for i in found[k][side]], np.int64) for side in (0, 1))
    first_a, first_b = (np.concatenate(([0], np.cumsum([len(found[k][side]) for k in there]))) for side in (0, 1))
    leaf = groups(np.cumsum(tokens.length_a[a]), np.cumsum(tokens.length_b[b]), first_a, first_b)
    lo, hi, blo, bhi = leaf
    text_of = np.repeat(np.arange(len(there)), np.diff(first_a))
    name = np.zeros(len(a) + len(b), np.int64)
    name[np.arange(len(a)) + np.repeat(blo, hi - lo)] = a
    name[hi - 1 + blo] += tokens.size_a
    name[np.arange(len(b)) + np.repeat(hi, bhi - blo)] = b + 2 * tokens.size_a
    name[hi + bhi - 1] += tokens.size_b
    parts = tokens.names[name].tolist()
    key, times = linked(a, b, leaf, text_of, tokens.size_b)
    cut = np.searchsorted(key, np.arange(len(there) + 1) << 40)
    code = key & ((1 << 40) - 1)
    of_text = np.searchsorted(lo, first_a)
    links = np.concatenate(([0], np.cumsum((hi - lo) * (bhi - blo))))
    for k, t in enumerate(there):
        text = b"".join(parts[first_a[k] + first_b[k] : first_a[k + 1] + first_b[k + 1]])[:-1]
        g = slice(of_text[k], of_text[k + 1])
        here = slice(cut[k], cut[k + 1])
        n_links = int(links[of_text[k + 1]] - links[of_text[k]])
        out[t] = (int(first_a[k + 1] - first_a[k]), int(first_b[k + 1] - first_b[k]), g.stop - g.start, n_links, text, code[here], times[here])
    return out


def aligned(docs: DataFrame, vocabulary: str, pieces: str, digest: bool) -> DataFrame:
    """Two kinds of rows: one for each row of docs (code null); and batch, code, texts: how many texts of a batch hold a linked pair.

    groups is the text ``a1,a2|b1;a3|b2,b3`` of decimal ids, or its digest. codes and times: differences of the sorted distinct pair
    codes of a text, and how often each is linked, as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(vocabulary, pieces)
        if tokens.size_a * tokens.size_b >= 1 << 32:
            raise ValueError("a pair code must fit 32 bits")
        batch = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        room = 0
        none = pa.nulls

        def summed() -> Iterator[pa.RecordBatch]:
            nonlocal held, room, batch
            if held:
                code, texts = np.unique(np.concatenate(held), return_counts=True)
                for lo in range(0, len(code), 1 << 16):
                    c, t = code[lo : lo + (1 << 16)], texts[lo : lo + (1 << 16)]
                    k = len(c)
                    columns = [pa.array(np.full(k, batch, np.int64)), *(none(k, pa.int64()) for _ in range(5)), none(k, pa.string()), none(k, pa.binary()), none(k, pa.binary()), pa.array(c.astype(np.int64)), pa.array(t)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
            held, room = [], 0
            batch += 1

        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            sizes = [len(t) * 2 if t else 0 for t in texts.to_pylist()]
            lo = 0
            while lo < len(sizes):
                hi, total = lo + 1, sizes[lo]
                while hi < len(sizes) and total + sizes[hi] <= STEP_BYTES:
                    total += sizes[hi]
                    hi += 1
                if room and room + total > BATCH_BYTES:
                    yield from summed()
                found = described(tokens, tokens.encoded([t or "" for t in texts[lo:hi].to_pylist()]))
                k = hi - lo
                number = [pa.array([f[c] if f else 0 for f in found], pa.int64()) for c in range(4)]
                said = pa.array([(hashlib.sha256(f[4]).hexdigest() if digest else f[4].decode()) if f else "" for f in found], pa.string())
                codes = pa.array([np.diff(f[5], prepend=0).astype(np.uint32).tobytes() if f else None for f in found], pa.binary())
                times = pa.array([f[6].astype(np.uint32).tobytes() if f else None for f in found], pa.binary())
                held += [f[5].astype(np.uint32) for f in found if f]
                room += total
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, batch, np.int64)), ids[lo:hi], *number, said, codes, times, none(k, pa.int64()), none(k, pa.int64())], names=names)
                lo = hi
        yield from summed()

    names = [c.split(" ")[0] for c in ALIGNED.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(K.tidy(run), ALIGNED)


def counted(pairs: DataFrame, size_b: int) -> DataFrame:
    """code, count (texts of the corpus that hold the pair linked), best (no other pair of its A id has a higher count)."""
    counts = pairs.groupBy("code").agg(F.sum("texts").alias("count")).withColumn("a", F.expr(f"code div {size_b}"))
    return counts.select("code", "count", (F.col("count") == F.max("count").over(Window.partitionBy("a"))).alias("best"))


def align(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for each row of docs."""
    vocabulary, pieces = vocabulary or vocabulary_path(VOCABULARY), pieces or vocabulary_path(PIECES)
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    both = stored(aligned(docs, vocabulary, pieces, digest), "aligned")
    pairs = both.where("code is not null").select("batch", "code", "texts")
    asked = pairs.select("batch", "code").join(counted(pairs, size_b), "code").select(F.col("batch").alias("of"), "code", "count", "best")
    texts = both.where("code is null").select("batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "times")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def add(texts: pa.Table, asked: pa.Table) -> pa.Table:
        """The texts of one batch and the counts of their pairs."""
        code = asked.column("code").to_numpy()
        order = np.argsort(code)
        code, count, best = code[order], asked.column("count").to_numpy()[order], asked.column("best").to_numpy()[order].astype(np.int64)
        n_best, total = [], []
        for c, t in zip(texts.column("codes"), texts.column("times"), strict=True):
            if not c.is_valid:
                n_best.append(0)
                total.append(0)
                continue
            at = np.searchsorted(code, np.cumsum(np.frombuffer(c.as_buffer(), np.uint32).astype(np.int64)))
            times = np.frombuffer(t.as_buffer(), np.uint32).astype(np.int64)
            n_best.append(int(times @ best[at]))
            total.append(int(times @ count[at]))
        made = texts.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return made.select(out)

    schema = ", ".join(f"{c} {'string' if c == 'groups' else 'long'}" for c in out)
    return texts.groupBy("batch").cogroup(asked.groupBy("of")).applyInArrow(add, schema)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align(table(spark, sf_dir, "documents"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")
