"""CRC-32 of any substring from running CRCs of its document, by GF(2) shift cancellation.

For byte strings A and B, crc(AB) = Z(len B) crc(A) xor crc(B), where Z(n) is
the linear map over GF(2) that n zero bytes apply to a CRC. One scan keeps the
CRC of every prefix that ends a word; the CRC of the bytes between two
prefixes is then the later one xor the earlier one shifted by the distance.
"""

from __future__ import annotations

from itertools import accumulate
from zlib import crc32

import numpy as np

_POLYNOMIAL = 0xEDB88320
_FULL = np.uint32(0xFFFFFFFF)
#: Distances with a table of their own; longer ones are put together from powers of two.
_NEAR = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


class CrcShift:
    """The maps Z(n) as lookup tables by byte of the CRC."""

    def __init__(self):
        self.byte = _byte_table()
        self.near = np.zeros((_NEAR, 4, 256), np.uint32)
        for part in range(4):
            self.near[0, part] = np.arange(256, dtype=np.uint32) << np.uint32(8 * part)
        for n in range(1, _NEAR):
            previous = self.near[n - 1]
            self.near[n] = (previous >> np.uint32(8)) ^ self.byte[previous & 0xFF]
        # Z(_NEAR), Z(2 _NEAR), Z(4 _NEAR), ...: each is the one before applied twice
        last = self.near[_NEAR - 1]
        power = (last >> np.uint32(8)) ^ self.byte[last & 0xFF]
        self.far = []
        for _ in range(48):
            self.far.append(power)
            power = self._apply(power, power)

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return (table[0][crc & 0xFF] ^ table[1][(crc >> np.uint32(8)) & 0xFF]
                ^ table[2][(crc >> np.uint32(16)) & 0xFF] ^ table[3][crc >> np.uint32(24)])

    def shift(self, crc: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Z(distance) crc, elementwise."""
        flat = self.near.reshape(_NEAR, 1024)
        low = distance % _NEAR
        out = (flat[low, crc & 0xFF] ^ flat[low, 256 + ((crc >> np.uint32(8)) & 0xFF)]
               ^ flat[low, 512 + ((crc >> np.uint32(16)) & 0xFF)] ^ flat[low, 768 + (crc >> np.uint32(24))])
        high, bit = distance // _NEAR, 0
        while high.any():
            at = np.flatnonzero(high & 1)
            out[at] = self._apply(self.far[bit], out[at])
            high, bit = high >> 1, bit + 1
        return out

    def space(self, crc: np.ndarray) -> np.ndarray:
        """The CRC of each string with one space behind it."""
        state = crc ^ _FULL
        return (state >> np.uint32(8)) ^ self.byte[(state & 0xFF) ^ 0x20] ^ _FULL


def _next(crc: int, word: bytes) -> int:
    return crc32(word, crc)


class WordCrcs:
    """Running CRCs of one document whose words are joined by single spaces."""

    def __init__(self, words: list[bytes], tables: CrcShift):
        self.tables = tables
        self.n = len(words)
        joined = [words[0], *[b" " + w for w in words[1:]]] if words else []
        lengths = np.fromiter(map(len, joined), np.int64, self.n)
        #: Offset and CRC behind every word.
        self.end = np.cumsum(lengths)
        self.end_crc = np.fromiter(accumulate(joined, _next, initial=0), np.uint32, self.n + 1)[1:]
        #: Offset and CRC of the prefix up to the first byte of every word.
        self.start = np.append(0, self.end[:-1] + 1) if self.n else self.end
        self.start_crc = np.append(np.zeros(1, np.uint32), tables.space(self.end_crc[:-1])) if self.n else self.end_crc

    def ngrams(self, size: int) -> np.ndarray:
        """CRC-32 of every run of ``size`` consecutive words, joined by single spaces."""
        count = self.n - size + 1
        if count <= 0:
            return np.zeros(0, np.uint32)
        end, end_crc = self.end[size - 1:], self.end_crc[size - 1:]
        return end_crc ^ self.tables.shift(self.start_crc[:count], end - self.start[:count])
