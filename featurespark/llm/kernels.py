"""Vectorised text kernels shared by the operators: words, hashes, windows and sampled anchors.

A *chunk* is a run of documents as one byte buffer with an offset for each document.  Everything
here is numpy over a whole chunk; no loop runs per word or per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

U64 = np.uint64
#: Bytes of text handled at a time; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 19
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Chunk(NamedTuple):
    """Rows ``lo:hi`` of a batch: document ``i`` is ``buf[offsets[i]:offsets[i + 1]]``."""

    lo: int
    hi: int
    buf: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.buf[self.offsets[i] : self.offsets[i + 1]].tobytes()


class Words(NamedTuple):
    """Words of a chunk by start and end byte, the document of each, and each document's first word."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut an Arrow string column into chunks of about ``limit`` bytes; nulls count as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA0761D6478BD642F)
    x ^= x >> U64(32)
    return x


@lru_cache(maxsize=4)
def _byte_codes(salt: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(_BASES[salt]) + U64(salt))


#: Powers of a base that a worker keeps.
KEPT_POWERS = 1 << 20


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as they are needed, and kept up to a bound."""

    def __init__(self, base: int) -> None:
        self.bases = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, U64), np.ones(1, U64)]

    def get(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(n, 1 << 16)
            tables = [np.cumprod(np.r_[U64(1), np.full(size - 1, b, U64)], dtype=U64) for b in self.bases]
            if n > KEPT_POWERS:
                return [t[:n] for t in tables]
            self.tables = tables
        return [t[:n] for t in self.tables]


@lru_cache(maxsize=4)
def _powers(salt: int) -> _Powers:
    return _Powers(_BASES[salt] | 1)


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of ``codes[start:end]`` for each pair, the same wherever the run stands."""
    power, inverse = _powers(salt).get(len(codes) + 1)
    total = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * power[:-1], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U64) * U64(0xC2B2AE3D27D4EB4F))


def is_space(buf: np.ndarray) -> np.ndarray:
    """The separators of the word pattern ``[^\\x20\\x09-\\x0D]+``."""
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def find_words(chunk: Chunk, inside: np.ndarray | None = None) -> Words:
    """Runs of the bytes that ``inside`` marks, by default of all but the separators."""
    buf, offsets = chunk.buf, chunk.offsets
    n = len(buf)
    inside = ~is_space(buf) if inside is None else inside
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    return Words(start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def word_hashes(chunk: Chunk, words: Words, salt: int = 0) -> np.ndarray:
    return span_hashes(_byte_codes(salt)[chunk.buf], words.start, words.end, salt)


def joined_words(chunk: Chunk, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words of a chunk one after the other, each followed by one space, and where each begins (then the end)."""
    size = words.end - words.start
    begin = np.r_[0, np.cumsum(size + 1)]
    out = np.full(begin[-1], 32, np.uint8)
    word = np.repeat(np.arange(len(size)), size)
    ahead = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    out[begin[word] + ahead] = chunk.buf[words.start[word] + ahead]
    return out, begin


# Fixed values of XXH64.
_X1, _X2, _X3, _X4, _X5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U64(n)) | (x >> U64(64 - n))


def xxh64(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of ``buf[start:end]`` for each pair; spans of 32 bytes and more go to the library one by one."""
    import xxhash

    size = end - start
    out = np.empty(len(size), U64)
    long = np.flatnonzero(size >= 32)
    if len(long):
        data = buf.tobytes()
        out[long] = [xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    short = np.flatnonzero(size < 32)
    if not len(short):
        return out
    padded = np.zeros(len(buf) + 16, np.uint8)
    padded[: len(buf)] = buf
    eight = np.empty(len(buf) + 8, U64)  # the eight bytes from each place on
    for k in range(8):
        part = padded[k : k + (len(buf) + 15 - k) // 8 * 8].view("<u8")
        eight[k::8] = part[: len(eight[k::8])]
    at, left = start[short], size[short]
    h = U64(seed) + _X5 + left.astype(U64)
    for _ in range(3):
        go = np.flatnonzero(left >= 8)
        if not len(go):
            break
        k1 = _turn(eight[at[go]] * _X2, 31) * _X1
        h[go] = _turn(h[go] ^ k1, 27) * _X1 + _X4
        at[go] += 8
        left[go] -= 8
    go = np.flatnonzero(left >= 4)
    h[go] = _turn(h[go] ^ ((eight[at[go]] & U64(0xFFFFFFFF)) * _X1), 23) * _X2 + _X3
    at[go] += 4
    left[go] -= 4
    for _ in range(3):
        go = np.flatnonzero(left > 0)
        if not len(go):
            break
        h[go] = _turn(h[go] ^ (padded[at[go]].astype(U64) * _X5), 11) * _X1
        at[go] += 1
        left[go] -= 1
    h ^= h >> U64(33)
    h *= _X2
    h ^= h >> U64(29)
    h *= _X3
    out[short] = h ^ (h >> U64(32))
    return out


def gram_hashes(units: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of the ``n`` units from each place where as many are left in the chunk."""
    at = np.arange(max(0, len(units) - n + 1))
    return span_hashes(units, at, at + n, salt)


def byte_codes(buf: np.ndarray, salt: int = 0) -> np.ndarray:
    return _byte_codes(salt)[buf]


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Places from which ``size`` units lie in one document; ``first``: each document's first unit, then the end."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    if not counts.sum():
        return np.zeros(0, np.int64)
    skip = np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    return np.arange(counts.sum()) + skip


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in a constant number of passes for any width."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    size = -(-len(x) // width) * width
    padded = np.full(size, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of its anchor: the leftmost gram of least hash.

    The choice depends on the run's content alone, so equal windows choose alike, wherever they are.
    A block of places is handled at a time so that hash and place fit one word.
    """
    n = len(grams) - width + 1
    out = np.empty(max(n, 0), np.int64)
    step = max(1 << 22, width)
    for lo in range(0, max(n, 0), step):
        part = grams[lo : lo + step + width - 1]
        packed = (part & ~U64(0xFFFFFF)) | np.arange(len(part), dtype=U64)
        best = sliding_min(packed, width)
        out[lo : lo + len(best)] = (best & U64(0xFFFFFF)).astype(np.int64) + lo
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, then the length."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.r_[np.flatnonzero(change), n]


def covered(start: np.ndarray, length: int, size: int) -> np.ndarray:
    """Mask of the places in ``[s, s + length)`` for some start ``s``."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, np.minimum(start + length, size), -1)
    return np.cumsum(delta)[:-1] > 0
