"""Byte-level BPE by backtracking, and decoding by an offset table.

Encoding of one pre-token walks the longest vocabulary match at each byte (an Aho-Corasick automaton gives, for the end of each
match, the longest token that is a suffix there; the trie part of it gives the longest prefix match). A token may follow another
only if the pair is compatible: merging the joined bytes by rank gives exactly these two tokens back. Where no compatible
continuation exists the encoder steps back to the next shorter prefix token. The result equals merging by rank, in linear time.

Defined results: a null or empty text has no tokens (ids text is empty, its decoded text too); ties do not occur, since merges
have distinct ranks; repeated rows give repeated results; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from eventweave.llm import kernels as K
from eventweave.llm.shared import table

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the public pre-tokenizing pattern of this vocabulary (white space as Unicode defines it).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Pre-tokens whose ids a task keeps, and pairs whose compatibility it keeps, in a young and an old table of this size each. About 200
#: bytes an entry; the tables end with their task.
CACHE_ENTRIES = 200_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_symbols() -> dict[str, int]:
    """Printable symbol of each byte in byte-level vocabularies: visible Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memory(dict):
    """Values of a function, computed on demand. A full table becomes the old one, from which what is asked for again comes back, so
    that frequent entries stay and at most two tables are held."""

    def __init__(self, value: Callable) -> None:
        super().__init__()
        self.value = value
        self.old: dict = {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.value(key)
        self[key] = got
        return got

    def turn(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()


class Bpe:
    """The vocabulary, its automaton and its tables. Built once in each Python worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        sym = _byte_symbols()
        as_bytes = lambda s: bytes(sym[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.ids = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.split: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(pairs):
            x, y = as_bytes(a), as_bytes(b)
            pair = (self.ids[x], self.ids[y])
            self.rank[pair], self.joined[pair] = r, self.ids[x + y]
            self.split.setdefault(self.ids[x + y], pair)
        trie = ahocorasick.Automaton()
        for t, i in self.ids.items():
            trie.add_word(t.decode("latin-1"), i)
        trie.make_automaton()
        self.trie = trie
        size = max(max(self.ids.values()), *self.special.values(), 0) + 1
        tokens = [b""] * size
        for t, i in self.ids.items():
            tokens[i] = t
        for t, i in self.special.items():
            tokens[i] = t.encode()
        self.tokens = tokens
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = [len(t) for t in tokens]
        self.shorter = self._shorter()
        self.pattern = regex.compile(PATTERN)
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fits = _Memory(lambda pair: self._fits(*pair))
        self.known = _Memory(lambda piece: ",".join(map(str, self.merged(piece.encode()))))

    def _shorter(self) -> list[int]:
        """For each token the longest other token that it starts with, or -1."""
        out = [-1] * len(self.tokens)
        for t, i in self.ids.items():
            for n in range(len(t) - 1, 0, -1):
                if (j := self.ids.get(t[:n])) is not None:
                    out[i] = j
                    break
        return out

    def _fits(self, left: int, right: int) -> bool:
        """Pair compatibility: no merge over the border of the two tokens comes before the merges that built them."""
        limit = 1 << 60
        while True:
            r = self.rank.get((left, right))
            if r is not None and r < limit:
                return False
            of_left, of_right = self.split.get(left), self.split.get(right)
            last_left = self.rank[of_left] if of_left else -1
            last_right = self.rank[of_right] if of_right else -1
            if last_left < 0 and last_right < 0:
                return True
            # Undo the later of both last merges and look at what stood at the border before it. Of equal merges the left one runs first.
            if last_left > last_right:
                limit, left = last_left, of_left[1]
            else:
                limit, right = last_right + 1, of_right[0]

    def merged(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        n, sizes, shorter, fits = len(data), self.sizes, self.shorter, self.fits
        longest = [-1] * (n + 1)
        for end, i in self.trie.iter(data.decode("latin-1")):
            longest[end - sizes[i] + 1] = i  # ends rise, so the last one for a start is the longest
        out: list[int] = []
        dead: set[int] = set()
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + sizes[token]
                if end not in dead:
                    if before < 0:
                        break
                    if fits[before, token]:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                before, at = token, end
                token = longest[at]
            elif out:
                dead.add(at)
                last = out.pop()
                at -= sizes[last]
                before = out[-1] if out else -1
                token = shorter[last]
            else:
                raise ValueError(f"no exact split of {data!r}")
        return out

    def encode(self, text: str) -> str:
        """The ids in decimal, joined by commas."""
        self.known.turn()
        self.fits.turn()
        if self.special_at is not None and any(s in text for s in self.special):
            out = []
            for part in self.special_at.split(text):
                if part in self.special:
                    out.append(str(self.special[part]))
                elif part:
                    out += map(self.known.__getitem__, self.pattern.findall(part))
            return ",".join(out)
        return ",".join(map(self.known.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from one blob by the offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        shift = np.repeat(start - np.cumsum(size) + size, size)
        return self.blob[shift + np.arange(len(shift))].tobytes()


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Columns doc_id, ids (array<int>) of every whole text. Keeps nothing between texts but the pre-token memory of a task."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)  # a task's own, so that a worker keeps nothing for the stages after it
        for b in batches:
            ids = [np.fromstring(s, np.int32, sep=",") if (s := bpe.encode(t or "")) else np.zeros(0, np.int32) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Columns doc_id, text from doc_id, ids (null ids: empty text)."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)  # a task's own, so that a worker keeps nothing for the stages after it
        for b in batches:
            texts = [bpe.decode(np.asarray(i or [], np.int64)).decode("utf-8", "replace") for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode, then decode what was encoded, and give the digests of both. No shuffle: texts stay in the task that read them."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)  # a task's own, so that a worker keeps nothing for the stages after it
        for b in batches:
            n, sha, back = [], [], []
            for t in b.column("text"):
                ids = bpe.encode(t.as_py() or "")
                n.append(ids.count(",") + 1 if ids else 0)
                sha.append(hashlib.sha256(ids.encode()).hexdigest())
                raw = bpe.decode(np.fromstring(ids, np.int64, sep=",") if ids else np.zeros(0, np.int64))
                back.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(K.tidy(run), SCHEMA)


def op7_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
