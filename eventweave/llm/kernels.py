"""Vectorised text kernels that run inside Spark tasks on Arrow string buffers.

Every function works on a bounded slice of one Arrow batch (``text_chunks``), never on a table.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that one vectorised step handles; a longer text is a step of its own.
CHUNK_BYTES = 1 << 19
#: Longer words are hashed one by one, not in steps over all words.
LONG_WORD = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_POW = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def give_back() -> None:
    """Returns the memory that this worker has freed to the system: workers live on beside those of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over the batches of a partition, with its memory given back at the end."""

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return whole


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POW[kind]
    if len(have) < n:
        step = U64(_BASE if kind == "up" else pow(_BASE, -1, 1 << 64))
        size = max(n, 2 * len(have))
        full = np.full(size, step, U64)
        full[0] = 1
        have = _POW[kind] = np.cumprod(full)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: a bijection that spreads every input bit."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def separators(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 flags: which bytes (after A-Z are lower-cased) end a word."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Words are runs of anything but ASCII white space.
SPACES = separators([(0x20, 0x20), (0x09, 0x0D)])
#: Words are runs of ASCII letters, digits and all bytes of non-ASCII characters.
PUNCTUATION = separators([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) over slices of about max_bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with len(data)+1 entries: h[j] - h[i], times the inverse power of i, identifies data[i:j]."""
    n = len(data)
    h = np.zeros(n + 1, U64)
    np.cumsum(_BYTE_CODE[data] * _powers("up", n), out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((h[end] - h[start]) * _powers("down", len(h))[start])


def word_hash(low: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word low[start:end]: blocks of eight bytes, mixed one after the other with the length. Unlike the sums of
    ``prefix_hash`` it has no words that collide by their form. Words over ``LONG_WORD`` bytes are hashed one by one."""
    padded = np.concatenate((low, np.zeros(8, np.uint8)))
    block = np.ndarray((len(low) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each byte on
    size = end - start
    out = mix(size.astype(U64) + U64(seed) * U64(_BASE) + U64(1))
    open_ = np.flatnonzero(size <= LONG_WORD)
    done = 0
    while len(open_):
        left = size[open_] - done
        own = block[start[open_] + done] & (U64(2**64 - 1) >> (U64(8) * (8 - np.minimum(left, 8)).astype(U64)))
        out[open_] = mix((out[open_] ^ own) * U64(_BASE))
        done += 8
        open_ = open_[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(low[start[i] : end[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def words(data: np.ndarray, offs: np.ndarray, stops: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of each lower-cased word, and for each text the index of its first word (one more at the end)."""
    low = _LOWER[data]
    n = len(low)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, np.zeros(len(offs), np.int64)
    inside = ~stops[low]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return word_hash(low, s, e, seed), s, e, np.searchsorted(s, offs)


def windows(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` codes, by its first position (runs over text borders too: the caller masks them)."""
    if len(codes) < size:
        return np.zeros(0, U64)
    n = len(codes) - size + 1
    out = codes[size - 1 :].copy()
    for k in range(size - 2, -1, -1):
        out = mix(codes[k : k + n] + out * U64(0x9E3779B97F4A7C15))
    return out


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int, stops: np.ndarray = SPACES, seed: int = 0) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles; a shorter text is one shingle, one without words has none."""
    code, _, _, first = words(data, offs, stops, seed)
    grams = windows(code, size)
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= size:
            g = np.sort(grams[a : b - size + 1])
            yield g[np.concatenate(([True], g[1:] != g[:-1]))]
        elif n:
            yield windows(code[a:b], int(n))
        else:
            yield np.zeros(0, U64)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]
