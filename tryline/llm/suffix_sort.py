"""Suffix arrays by two-stage sorting, and common prefixes of neighbours (numpy).

A suffix is of type B when it is smaller than its successor, the suffix one
byte further, else of type A. Only type B suffixes are sorted by their
contents. One scan over the array from its front then induces all others: the
predecessor of a scanned suffix, if of type A, is the next in the bucket of
its first byte. Buckets are scanned a whole bucket at a time; within one, runs
of its own byte are followed in waves.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def byte_words(text: np.ndarray) -> np.ndarray:
    """At every offset the next eight bytes as a big-endian number, zeros behind the end."""
    padded = np.concatenate([text, np.zeros(WORD, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(WORD):
        out |= padded[k:k + len(text)].astype(np.uint64) << np.uint64(8 * (WORD - 1 - k))
    return out


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type B; the last one has the empty suffix behind it and is not."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    less = np.append(text[:-1] < text[1:], False)
    at = np.where(differs, np.arange(n), n)
    return less[np.minimum.accumulate(at[::-1])[::-1]]


def _sort_by_contents(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``at`` in the order of the ``depth`` bytes from each offset; of equal ones the later comes first,
    so that a suffix which ends precedes one that goes on with zero bytes."""
    n = len(words)
    at = at[::-1]
    at = at[np.argsort(words[at], kind="stable")]
    key = words[at]
    same = np.append(False, key[1:] == key[:-1])
    for offset in range(WORD, depth, WORD):
        # members of groups that are still equal
        open_ = np.flatnonzero(same | np.append(same[1:], False))
        if not len(open_):
            break
        group = np.cumsum(~same[open_])
        pos = at[open_] + offset
        key = np.where(pos < n, words[np.minimum(pos, n - 1)], np.uint64(0))
        order = np.lexsort((key, group))
        at[open_] = at[open_][order]
        key, group = key[order], group[order]
        same[open_[1:]] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        same[open_[:1]] = False
    return at


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Offsets of all suffixes of the uint8 array ``text`` in ascending order of at least ``depth`` leading bytes."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    is_b = smaller_than_successor(text)
    sizes = np.bincount(text, minlength=256)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(n, np.int64)
    b = _sort_by_contents(np.flatnonzero(is_b), words, depth)
    first = text[b]
    b_sizes = np.bincount(first, minlength=256)
    b_before = np.cumsum(b_sizes) - b_sizes
    out[(ends - b_sizes - b_before)[first] + np.arange(len(b))] = b
    front = starts.copy()
    out[front[text[n - 1]]] = n - 1      # the empty suffix comes first of all and induces the last one
    front[text[n - 1]] += 1
    for c in np.flatnonzero(sizes).tolist():
        scanned = starts[c]
        while scanned < front[c]:
            before = out[scanned:front[c]] - 1
            scanned = front[c]
            before = before[before >= 0]
            before = before[(text[before] == c) & ~is_b[before]]
            out[scanned:scanned + len(before)] = before
            front[c] += len(before)
        before = out[starts[c]:ends[c]] - 1
        before = before[before >= 0]
        before = before[text[before] > c]       # larger than its successor, so of type A
        byte = text[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        counts = np.bincount(byte, minlength=256)
        begin = np.cumsum(counts) - counts
        out[(front - begin)[byte] + np.arange(len(byte))] = before
        front += counts
    return out


def adjacent_prefixes(words: np.ndarray, at: np.ndarray, limit: int) -> np.ndarray:
    """Common bytes, up to ``limit``, of each suffix of ``at`` and the one before it; 0 for the first.

    Every offset of ``at`` needs ``limit`` bytes of text behind it.
    """
    out = np.zeros(len(at), np.int64)
    pairs = np.arange(1, len(at))
    for offset in range(0, limit, WORD):
        unequal = words[at[pairs] + offset] ^ words[at[pairs - 1] + offset]
        common = np.zeros(len(pairs), np.int64)
        for k in range(WORD):
            common += (unequal >> np.uint64(8 * (WORD - 1 - k))) == 0
        out[pairs] += common
        pairs = pairs[common == WORD]
    return np.minimum(out, limit)
