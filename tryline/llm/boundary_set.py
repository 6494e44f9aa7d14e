"""Compressed sets of text offsets with select, in containers of 2^16 offsets.

A set is held as Roaring bitmaps are: offsets that share their high bits form
one container, kept as a sorted array, a bitmap or a list of runs, whichever
is smallest. The cumulative cardinalities over the containers answer
``select(k)`` by a search for the container and a local select in it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LOW_BITS = 16
_LOW_MASK = (1 << LOW_BITS) - 1
#: A bitmap container has 8192 bytes; an array takes 2 bytes an offset, a run 4.
_BITMAP_BYTES = (1 << LOW_BITS) // 8
_BITS_SET = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


@dataclass(frozen=True)
class ArrayContainer:
    low: np.ndarray      # uint16, ascending

    def select(self, k: int) -> int:
        return int(self.low[k])


@dataclass(frozen=True)
class RunContainer:
    first: np.ndarray    # int64, first offset of each run
    before: np.ndarray   # int64, offsets in the runs before each run

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run] + k - self.before[run])


@dataclass(frozen=True)
class BitmapContainer:
    bits: np.ndarray     # uint8, lowest bit first
    upto: np.ndarray     # int64, bits set up to and including each byte

    def select(self, k: int) -> int:
        byte = int(np.searchsorted(self.upto, k, side="right"))
        rest = k - (int(self.upto[byte - 1]) if byte else 0)
        ones = np.flatnonzero(np.unpackbits(self.bits[byte:byte + 1], bitorder="little"))
        return byte * 8 + int(ones[rest])


def _container(low: np.ndarray) -> ArrayContainer | RunContainer | BitmapContainer:
    starts = np.flatnonzero(np.append(True, np.diff(low) != 1))
    if len(starts) * 4 < min(len(low) * 2, _BITMAP_BYTES):
        return RunContainer(low[starts], starts.astype(np.int64))
    if len(low) * 2 <= _BITMAP_BYTES:
        return ArrayContainer(low.astype(np.uint16))
    flags = np.zeros(1 << LOW_BITS, np.uint8)
    flags[low] = 1
    bits = np.packbits(flags, bitorder="little")
    return BitmapContainer(bits, np.cumsum(_BITS_SET[bits]))


class BoundarySet:
    """Offsets of a text in ascending order; ``select(k)`` is the k-th smallest, from 0."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> LOW_BITS
        first = np.flatnonzero(np.append(True, high[1:] != high[:-1])) if len(offsets) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(offsets))[:len(first)]
        self.high = high[first]
        self.upto = ends.astype(np.int64)
        self.containers = [_container(offsets[a:b] & _LOW_MASK) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(f"no offset {k} among {len(self)}")
        c = int(np.searchsorted(self.upto, k, side="right"))
        before = int(self.upto[c - 1]) if c else 0
        return (int(self.high[c]) << LOW_BITS) + self.containers[c].select(k - before)
