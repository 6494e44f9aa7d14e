"""Subword lattices of many short units at once (numpy).

A unit is a byte span that starts with a space (SentencePiece's word mark), or
with several, and holds no other one behind them. Its lattice has a node before every byte and after the
last, and an arc for every vocabulary piece that stands there; single bytes
are arcs through the vocabulary's byte pieces, so every unit has a path. The
arcs of all units are found together: substrings grow byte by byte and only
those that begin some piece go on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tryline.llm.textops import _BYTE, U64, _powers, span_hashes, splitmix

MARK = "▁"


class HashIndex:
    """Positions of 64-bit keys in an array of distinct keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = U64((1 << bits) - 1)
        self.key = np.zeros(1 << bits, U64)
        self.at = np.full(1 << bits, -1, np.int64)
        todo, slot = np.arange(len(keys)), keys & self.mask
        while len(todo):
            free = self.at[slot.astype(np.int64)] < 0
            # of several keys for one free slot the last written stays
            self.at[slot[free].astype(np.int64)] = todo[free]
            won = self.at[slot.astype(np.int64)] == todo
            self.key[slot[won].astype(np.int64)] = keys[todo[won]]
            todo, slot = todo[~won], (slot[~won] + U64(1)) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 if absent."""
        mask = int(self.mask)
        slot = (keys & self.mask).astype(np.int64)
        out = self.at[slot]
        hit = self.key[slot] == keys
        todo = np.flatnonzero((out >= 0) & ~hit)
        out[todo] = -1
        slot, want = (slot[todo] + 1) & mask, keys[todo]
        while len(todo):
            at = self.at[slot]
            hit = (at >= 0) & (self.key[slot] == want)
            out[todo[hit]] = at[hit]
            more = (at >= 0) & ~hit
            todo, want, slot = todo[more], want[more], (slot[more] + 1) & mask
        return out


class Spelling:
    """The bytes and scores of a SentencePiece vocabulary's pieces; ``ids`` are the vocabulary's own."""

    def __init__(self, model_path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.size = sp.get_piece_size()
        self.byte_id = np.zeros(256, np.int64)
        self.bytes_of: list[bytes] = [b""] * self.size
        self.score = np.array([sp.get_score(i) for i in range(self.size)])
        self.words: dict[int, str] = {}      # pieces that are text, as the vocabulary writes them
        for i in range(self.size):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:-1], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.words[i] = sp.id_to_piece(i)
                self.bytes_of[i] = self.words[i].replace(MARK, " ").encode()
        self.spell = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.spell_size = np.array([len(x) for x in self.bytes_of], np.int64)
        self.spell_at = np.cumsum(self.spell_size) - self.spell_size


class Pieces(Spelling):
    """A vocabulary whose pieces are found by the hashes of their bytes.

    Control and unknown pieces have no arcs. Nor have pieces with an inner
    word mark, which no single word holds; with ``space_runs`` those that only
    begin with several marks have, and a piece that runs from one word into
    the next is an error.
    """

    def __init__(self, model_path: str, space_runs: bool = False):
        super().__init__(model_path)
        self.normal = np.zeros(self.size, bool)
        for i, p in self.words.items():
            self.normal[i] = MARK not in (p.lstrip(MARK) if space_runs else p[1:])
            if space_runs and not self.normal[i]:
                raise ValueError(f"the piece {p!r} runs across words")
        ids = np.flatnonzero(self.normal).tolist()
        text = [self.bytes_of[i] for i in ids]
        self.usable = self.normal.copy()
        self.usable[self.byte_id] = True
        # all beginnings of pieces, each once, with the piece that ends there
        trie: dict[bytes, int] = {}
        for p in text:
            for k in range(1, len(p)):
                trie.setdefault(p[:k], -1)
        for p, i in zip(text, ids, strict=True):
            trie[p] = i
        joined = np.frombuffer(b"".join(trie), np.uint8)
        size = np.array([len(p) for p in trie], np.int64)
        end = np.cumsum(size)
        self.longest = int(size.max())
        self.index = HashIndex(span_hashes(joined, end - size, end, lower=False))
        self.piece = np.array(list(trie.values()), np.int64)
        # beginnings of one and two bytes by their bytes alone: the piece, -1 for none, -2 if nothing begins so
        self.short = {n: np.full(1 << 8 * n, -2, np.int64) for n in (1, 2)}
        for p, i in trie.items():
            if len(p) in self.short:
                self.short[len(p)][int.from_bytes(p, "big")] = i


@dataclass
class Lattice:
    """Arcs of units; node numbers run over all units, ``first[u]`` is unit u's start and ``last[u]`` its end."""

    first: np.ndarray
    last: np.ndarray
    tail: np.ndarray    # arc: from node
    head: np.ndarray    # arc: to node
    piece: np.ndarray   # arc: piece id


def build(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces, bytes_always: bool) -> Lattice:
    """Lattices of byte spans. Byte arcs stand at all bytes, or else only in characters that are no piece."""
    size = end - start
    first = np.cumsum(size + 1) - (size + 1)
    # node k of unit u is byte start[u] + k
    unit = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)
    byte = start[unit] + within
    node = first[unit] + within
    left = size[unit] - within
    tails, heads, found = [], [], []
    single = np.zeros(len(unit), bool)      # a piece of exactly one character begins here
    lead = (data[byte] & 0xC0) != 0x80
    char = np.where(data[byte] < 0x80, 1, np.where(data[byte] < 0xE0, 2, np.where(data[byte] < 0xF0, 3, 4)))
    alive = np.arange(len(unit))
    hashes = _Substrings(data)
    for n in range(1, pieces.longest + 1):
        alive = alive[left[alive] >= n]
        if not len(alive):
            break
        if n in pieces.short:
            code = data[byte[alive]].astype(np.int64)
            p = pieces.short[n][code if n == 1 else code << 8 | data[byte[alive] + 1]]
            alive, p = alive[p > -2], p[p > -2]
        else:
            at = pieces.index.find(hashes.of(byte[alive], n))
            alive, at = alive[at >= 0], at[at >= 0]
            p = pieces.piece[at]
        hit = p >= 0
        a = alive[hit]
        tails.append(node[a])
        heads.append(node[a] + n)
        found.append(p[hit])
        single[a[lead[a] & (char[a] == n)]] = True
    if bytes_always:
        need = np.ones(len(unit), bool)
    else:
        # every byte of a character without a piece of its own
        begin = np.maximum.accumulate(np.where(lead | (within == 0), np.arange(len(unit)), 0))
        need = ~single[begin]
    tails.append(node[need])
    heads.append(node[need] + 1)
    found.append(pieces.byte_id[data[byte[need]]])
    return Lattice(first, first + size, np.concatenate(tails), np.concatenate(heads), np.concatenate(found))


class _Substrings:
    """Hashes of equally long substrings, as ``span_hashes`` gives them."""

    def __init__(self, data: np.ndarray):
        p, self.inv = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(_BYTE[data] * p[:len(data)], out=self.sums[1:])

    def of(self, at: np.ndarray, n: int) -> np.ndarray:
        h = (self.sums[at + n] - self.sums[at]) * self.inv[at]
        return splitmix(h + U64(n * 0xD6E8FEB86659FD93 & (1 << 64) - 1))


def _log_sums(lat: Lattice, weight: np.ndarray, source: np.ndarray, target: np.ndarray, begin: np.ndarray,
              offset: np.ndarray, stable: bool = False) -> np.ndarray:
    """Log-space recursion over all units at once: nodes in order of their ``offset`` from ``begin``.

    ``stable``: a unit's sums don't depend, in their last bits, on the units beside it.
    """
    n_nodes = int(lat.last[-1]) + 1 if len(lat.last) else 0
    value = np.full(n_nodes, -np.inf)
    value[begin] = 0.0
    order = np.argsort(offset[target] * n_nodes + target, kind="stable" if stable else None)
    src, dst, w = source[order], target[order], weight[order]
    step = offset[dst]
    edges = np.flatnonzero(np.diff(step)) + 1 if len(step) else np.zeros(0, np.int64)
    for a, b in zip(np.append(0, edges).tolist(), np.append(edges, len(step)).tolist(), strict=True):
        if a == b:
            continue
        x = value[src[a:b]] + w[a:b]
        d = dst[a:b]
        cut = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        top = np.maximum.reduceat(x, cut)
        safe = np.where(np.isfinite(top), top, 0.0)
        with np.errstate(divide="ignore"):
            value[d[cut]] = safe + np.log(np.add.reduceat(np.exp(x - np.repeat(safe, np.diff(np.append(cut, b - a)))), cut))
    return value


def offsets_of(lat: Lattice) -> np.ndarray:
    size = lat.last - lat.first + 1
    return np.arange(int(size.sum())) - np.repeat(lat.first, size)


def forward(lat: Lattice, weight: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all paths from a unit's start to each node."""
    return _log_sums(lat, weight, lat.tail, lat.head, lat.first, offsets_of(lat))


def backward(lat: Lattice, weight: np.ndarray, stable: bool = False) -> np.ndarray:
    """The same from each node to its unit's end."""
    size = lat.last - lat.first
    return _log_sums(lat, weight, lat.head, lat.tail, lat.last, np.repeat(size, size + 1) - offsets_of(lat), stable)


def marginals(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Natural-log marginal probability of each unit over all its segmentations."""
    if not len(start):
        return np.zeros(0)
    lat = build(data, start, end, pieces, bytes_always=True)
    return forward(lat, logp[lat.piece])[lat.last]


def expected_counts(data: np.ndarray, start: np.ndarray, end: np.ndarray, count: np.ndarray, pieces: Pieces,
                    logp: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in the units, each weighted by its count."""
    if not len(start):
        return np.zeros(pieces.size)
    lat = build(data, start, end, pieces, bytes_always=True)
    w = logp[lat.piece]
    alpha, beta = forward(lat, w), backward(lat, w)
    size = lat.last - lat.first + 1
    total = np.repeat(alpha[lat.last] - np.log(count), size)
    return np.bincount(lat.piece, np.exp(alpha[lat.tail] + w + beta[lat.head] - total[lat.tail]), pieces.size)
