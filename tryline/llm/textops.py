"""Vectorised word and shingle hashing over Arrow string columns (numpy, no per-word Python).

Text is handled in its UTF-8 bytes, straight from the Arrow buffers. Bytes
above 0x7F never equal ASCII white space or A-Z, so words and ASCII
lower-casing are the same on bytes as on characters. Hashes are 64 bits wide:
two different words (or shingles) that meet in one comparison collide with
probability 2^-64 each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20
_P = 0x9E3779B97F4A7C15 | 1


def splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, elementwise."""
    x = x + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = splitmix(np.arange(256, dtype=U64) * U64(7919) + U64(1))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Cache(dict):
    """Tables of one process; a task function that refers to them travels without them."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0.. and its inverses modulo 2^64, at least ``n`` of each."""
    if len(_POWERS.get("p", ())) < n:
        size = max(n, CHUNK_BYTES + 64)
        inverse = pow(_P, -1, 1 << 64)
        for key, base in (("p", _P), ("i", inverse)):
            a = np.full(size, base, dtype=U64)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    return _POWERS["p"][:n], _POWERS["i"][:n]


@dataclass
class Chunk:
    """Some consecutive rows of a batch: their bytes and, per row, where its text begins."""

    rows: slice
    data: np.ndarray      # uint8, the texts one after another
    offsets: np.ndarray   # int64, len(rows) + 1


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Slices of a string column of at most ``limit`` bytes (a longer text is one slice). Null is empty."""
    texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, off, buf = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield Chunk(slice(first, last), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    start: np.ndarray   # int64, byte offset in the chunk
    end: np.ndarray
    row: np.ndarray     # int64, row within the chunk
    first: np.ndarray   # int64, per row: index of its first word; one more entry at the end


def words(c: Chunk) -> Words:
    n = len(c.data)
    rows = len(c.offsets) - 1
    if not n:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(rows + 1, np.int64))
    inside = ~_SPACE[c.data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = c.offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]     # a word never runs across two texts
    starts[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, c.offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    return Words(start, end, row, first)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each byte span, optionally with A-Z lower-cased."""
    if not len(start):
        return np.zeros(0, U64)
    p, inv = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * p[:len(data)], out=sums[1:])
    h = (sums[end] - sums[start]) * inv[start]
    return splitmix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of integer keys: where one of each stands, every key's number among them, and their counts."""
    if not len(keys):
        z = np.zeros(0, np.int64)
        return z, z, z
    order = np.argsort(keys)
    new = np.append(True, keys[order[1:]] != keys[order[:-1]])
    first = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[first], number, np.diff(np.append(first, len(keys)))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes (rows not regarded)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, size, dtype=U64)
    for k in range(size):
        out = splitmix(out ^ h[k:k + n])
    return out


def shingle_sets(c: Chunk, size: int, lower: bool = True) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``size``-word shingles; with
    fewer words the whole sequence is one shingle; without words an empty set."""
    w = words(c)
    h = span_hashes(c.data, w.start, w.end, lower)
    whole = window_hashes(h, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a:b - size + 1]))
        else:
            out.append(window_hashes(h[a:b], b - a) if b > a else np.zeros(0, U64))
    return out
