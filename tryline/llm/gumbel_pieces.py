"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding (operator 3).

A text's segmentations form a lattice: the lattices of its units (a run of
spaces or the text's start, with what follows up to the next space) one after
another. Pieces of several spaces are arcs like all others; no piece goes on
from a word into the next one's space (a vocabulary with such a piece is an
error), so no segmentation is left out by the cut. Its piece weights come from the vocabulary's own order of scores: piece of
rank r has weight ``1 / (r + RANK_SHIFT)``, raised to ``sharpness``. Given
the text, a segmentation's probability is its weight over that of all.

The ``k`` segmentations of the largest Gumbel-perturbed log probabilities are
a sample of size ``k`` without replacement. They are found by an A* search
over disjoint sets of segmentations whose priority is the largest perturbed
value in the set - exact, since that maximum is itself Gumbel distributed
around the set's log mass (the lattice's backward recursion) and, below a
found maximum, a truncated one. Popping a set yields its best member; the
rest splits by the first unit that differs, and only the best rest is opened.

``inclusion`` is the probability that the segmentation's perturbed value
exceeds the (k+1)-th largest one, the weight of the usual estimator for such
samples (1 if the text has no more than k segmentations).

All draws are functions of the row's key and a counter: the same key and text
give the same samples, whatever the batch or task.

Decoding joins the pieces' bytes and drops the leading space; it is exact for
every text, since a literal word mark and other characters without a piece are
spelled in byte pieces.

Defined cases: null and empty texts have one sample without pieces; a text
with fewer than k segmentations has them all. Rows of equal key and text get
equal samples; a null key counts as a key of its own. Masses are sums of
doubles, so only a segmentation whose share vanishes there (some 1e-308 of its
unit) counts as absent. A unit's lattice is held whole by a task.
"""

from __future__ import annotations

import heapq
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tryline.llm.lattice import Lattice, Pieces, Spelling, backward, build
from tryline.llm.textops import U64, Chunk, chunks, distinct, span_hashes, splitmix

RANK_SHIFT = 10.0
#: Arcs that a task keeps (some 36 bytes each).
MOST_ARCS = 3_000_000
_SEEN = U64((1 << 22) - 1)
_M = (1 << 64) - 1


def piece_logp(pieces: Pieces, sharpness: float) -> np.ndarray:
    """Log weights by the vocabulary's order of scores; byte pieces come behind all others."""
    rank = np.empty(pieces.size)
    order = np.lexsort((-pieces.score, ~pieces.normal))
    rank[order] = np.arange(pieces.size)
    logw = -sharpness * np.log(rank + RANK_SHIFT)
    return logw - np.log(np.exp(logw[pieces.usable]).sum())


class _Draws:
    """Uniform numbers in (0, 1) from a key, one after another."""

    def __init__(self, key: int):
        self.state = key

    def __call__(self) -> float:
        self.state = x = (self.state + 0x9E3779B97F4A7C15) & _M
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & _M
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & _M
        return (((x ^ x >> 31) >> 11) + 0.5) * 2.0 ** -53


def _truncated(u: float, mean: float, top: float) -> float:
    """A Gumbel number around ``mean``, given that it is at most ``top``."""
    low = math.log(-math.log(u))
    high = mean - top
    # -log(exp(-top) + exp(-g)) with g the free number, kept in range
    return mean - (max(high, low) + math.log1p(math.exp(-abs(high - low))))


class _Column:
    """An array that grows at its end, its room doubling."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1 << 12, dtype), 0

    def extend(self, x: np.ndarray) -> None:
        need = self.n + len(x)
        if need > len(self.room):
            room = np.empty(max(need, 2 * len(self.room)), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:need] = x
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class UnitStore:
    """Lattices of distinct units with conditional arc probabilities, kept from chunk to chunk by one task.

    Nothing of a unit depends on the units beside it. Units are told apart by
    their 64-bit hashes. Units that come a second time, in one chunk or a later
    one, are kept, the others only until the next chunk; above ``MOST_ARCS``
    the store begins anew.
    """

    def __init__(self, pieces: Pieces, logp: np.ndarray):
        self.pieces, self.logp = pieces, logp
        #: By the low bits of their hashes the units that came before (others of the same bits are kept a little early).
        self._seen = np.zeros(int(_SEEN) + 1, bool)
        self.reset()

    def reset(self) -> None:
        self.keys, self.kinds = np.zeros(0, U64), np.zeros(0, np.int64)      # of kept units, in the order of the keys
        self._start, self._stop = _Column(np.int32), _Column(np.int32)       # per unit: its first and last node
        self._begin, self._end = _Column(np.int32), _Column(np.int32)        # per node: its arcs
        self._head, self._piece = _Column(np.int32), _Column(np.int32)       # per arc
        self._logq, self._upto, self._others = _Column(float), _Column(float), _Column(float)
        self._all = (self._start, self._stop, self._begin, self._end, self._head, self._piece, self._logq, self._upto, self._others)
        self._kept = [0] * len(self._all)

    def kinds_of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The store's number of every unit (byte spans of ``data``), new ones added."""
        for column, n in zip(self._all, self._kept, strict=True):
            column.n = n
        if self._head.n > MOST_ARCS:
            self.reset()
        h = span_hashes(data, start, end, lower=False)
        at, number, count = distinct(h)
        keys = h[at]         # in ascending order
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        kind = np.empty(len(keys), np.int64)
        kind[known] = self.kinds[place[known]]
        again = self._seen[(keys & _SEEN).astype(np.int64)]
        self._seen[(keys & _SEEN).astype(np.int64)] = True
        often = np.flatnonzero(~known & (again | (count > 1)))
        kind[often] = self._add(data, start[at[often]], end[at[often]])
        self.keys, self.kinds = np.insert(self.keys, place[often], keys[often]), np.insert(self.kinds, place[often], kind[often])
        self._kept = [column.n for column in self._all]
        once = np.flatnonzero(~known & ~again & (count == 1))
        kind[once] = self._add(data, start[at[once]], end[at[once]])
        self.start, self.stop, self.begin, self.end, self.head, self.piece, self.logq, self.upto, self.others = (c.all for c in self._all)
        return kind[number]

    def _add(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Adds units and returns their numbers."""
        number = self._start.n + np.arange(len(start))
        if not len(start):
            return number
        lat: Lattice = build(data, start, end, self.pieces, bytes_always=False)
        w = self.logp[lat.piece]
        beta = backward(lat, w, stable=True)
        with np.errstate(invalid="ignore"):
            logq = w + beta[lat.head] - beta[lat.tail]
        alive = np.isfinite(logq)
        # the arcs come as one ascending run of nodes per length, which a stable sort merges
        order = np.flatnonzero(alive)[np.argsort(lat.tail[alive], kind="stable")]
        tail, logq = lat.tail[order], logq[order]
        nodes = int(lat.last[-1]) + 1
        edge = np.searchsorted(tail, np.arange(nodes + 1))
        begin, end_ = edge[:-1], edge[1:]
        # sums over a node's arcs up to each one, and over all others: only additions, so small shares keep their digits
        q = np.exp(logq)
        place = np.arange(len(tail)) - begin[tail]
        behind = end_[tail] - 1 - np.arange(len(tail))
        upto, after = q.copy(), np.zeros(len(q))
        before = np.zeros(len(q))
        for turn, step in ((place, -1), (behind, 1)):
            todo, k = np.flatnonzero(turn), 1
            while len(todo):
                now = turn[todo] == k
                here, todo, k = todo[now], todo[~now], k + 1
                if step < 0:
                    before[here] = upto[here - 1]
                    upto[here] = upto[here - 1] + q[here]
                else:
                    after[here] = after[here + 1] + q[here + 1]
        whole = upto[np.maximum(end_ - 1, 0)[tail]]
        node, arc = self._begin.n, self._head.n
        self._start.extend(lat.first + node)
        self._stop.extend(lat.last + node)
        self._begin.extend(begin + arc)
        self._end.extend(end_ + arc)
        self._head.extend(lat.head[order] + node)
        self._piece.extend(lat.piece[order])
        self._logq.extend(logq)
        self._upto.extend(upto / whole)
        self._others.extend(before + after)
        return number

    def ancestral(self, kind: np.ndarray, by_kind: np.ndarray, keys: np.ndarray, sample: int):
        """One independent segmentation of every unit occurrence: piece ids in order, where each occurrence's begin,
        log probabilities, and the probabilities of all other segmentations."""
        n = len(kind)
        occ = by_kind
        node, stop = self.start[kind[occ]], self.stop[kind[occ]]
        seed = keys[occ]
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        logq, others = np.zeros(n), np.zeros(n)
        count = np.zeros(n, np.int64)
        path, beside = np.zeros(n), np.zeros(n)      # of the occurrences under way
        step = 0
        while len(occ):
            x = splitmix(seed ^ U64(((sample + 1) << 40) + step))
            u = (x >> U64(11)).astype(np.float64) * 2.0 ** -53
            # the first arc whose running share is above u; the last one if rounding leaves none
            low, high = self.begin[node], self.end[node] - 1
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                right = self.upto[middle] <= u[open_]
                low[open_] = np.where(right, middle + 1, low[open_])
                high[open_] = np.where(right, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            beside += np.exp(path) * self.others[low]
            path += self.logq[low]
            steps.append((occ, self.piece[low]))
            node = self.head[low]
            more = node < stop
            step += 1
            done = occ[~more]
            logq[done], others[done], count[done] = path[~more], beside[~more], step
            occ, node, stop, seed, path, beside = occ[more], node[more], stop[more], seed[more], path[more], beside[more]
        begin = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(int(begin[-1]), np.int32)
        for k, (o, p) in enumerate(steps):
            ids[begin[o] + k] = p
        return ids, begin, logq, others

    def arcs_of(self, kind: int, ids: np.ndarray) -> tuple[int, ...]:
        """The arcs that spell a unit with these pieces."""
        node, arcs = int(self.start[kind]), []
        for p in ids.tolist():
            a, b = int(self.begin[node]), int(self.end[node])
            arcs.append(a + self.piece[a:b].tolist().index(p))
            node = int(self.head[arcs[-1]])
        return tuple(arcs)

    def without(self, kind: int, excluded: list[tuple[int, ...]]) -> _Without:
        return _Without(self, kind, excluded)


class _Without:
    """A unit's segmentations but for some: what is left of the mass behind every beginning that an excluded one has.

    The beginnings form a tree. The mass left at one is a sum over its arcs,
    each with what is left behind it, from the tree's leaves up: nothing is
    subtracted, so however small, what exists is found.
    """

    def __init__(self, store: UnitStore, kind: int, excluded: list[tuple[int, ...]]):
        self.store, self.node, self.stop = store, int(store.start[kind]), int(store.stop[kind])
        self.next: list[dict[int, int]] = [{}]
        nodes = [self.node]
        for arcs in excluded:
            at = 0
            for arc in arcs:
                if arc not in self.next[at]:
                    self.next[at][arc] = len(self.next)
                    self.next.append({})
                    nodes.append(int(store.head[arc]))
                at = self.next[at][arc]
        self.mass: list[list[float]] = [[]] * len(nodes)
        left = [0.0] * len(nodes)
        for at in range(len(nodes) - 1, -1, -1):
            if nodes[at] == self.stop:
                continue
            a = int(store.begin[nodes[at]])
            mass = np.exp(store.logq[a:int(store.end[nodes[at]])]).tolist()
            for arc, behind in self.next[at].items():
                mass[arc - a] *= left[behind]
            self.mass[at], left[at] = mass, sum(mass)
        self.left = left[0]

    def draw(self, draw: _Draws) -> tuple[tuple[int, ...], float]:
        """One of the segmentations left, as arcs, and its log probability."""
        store, node, at = self.store, self.node, 0
        arcs: list[int] = []
        while node < self.stop:
            a = int(store.begin[node])
            mass = self.mass[at] if at is not None else np.exp(store.logq[a:int(store.end[node])]).tolist()
            x, k, best = draw() * sum(mass), -1, -1
            for i, m in enumerate(mass):
                if m > 0.0:
                    best, x = i, x - m
                    if x < 0.0:
                        k = i
                        break
            k = best if k < 0 else k
            if k < 0:
                raise ArithmeticError("no segmentation is left")
            arcs.append(a + k)
            at = self.next[at].get(a + k) if at is not None else None
            node = int(store.head[a + k])
        return tuple(arcs), float(store.logq[arcs].sum())


class Units:
    """The units of a chunk's texts, as numbers of the store."""

    def __init__(self, c: Chunk, store: UnitStore):
        rows = len(c.offsets) - 1
        size = np.diff(c.offsets)
        data = np.insert(c.data, c.offsets[:-1], 32)
        edge = c.offsets + np.arange(rows + 1)
        # a unit begins with a run of spaces, of which the text's first is the inserted one
        space = data == 32
        space[1:] &= data[:-1] != 32
        space[edge[:-1]] = True
        start = np.flatnonzero(space)
        end = np.append(start[1:], len(data))
        row = np.searchsorted(edge, start, side="right") - 1
        full = size[row] > 0
        start, end, row = start[full], end[full], row[full]
        self.store = store
        self.first = np.searchsorted(row, np.arange(rows + 1))      # per text its first unit
        self.kind = store.kinds_of(data, start, end)
        self.by_kind = np.argsort(self.kind)


class _Sample:
    """A segmentation of a text: per unit its log probability, the mass of all others, and the ancestral draw it is of or its own arcs."""

    def __init__(self, logq: np.ndarray, others: np.ndarray, source: np.ndarray, own: dict[int, tuple[int, ...]]):
        self.logq, self.others, self.source, self.own = logq, others, source, own
        self.total = float(logq.sum())

    def unit(self, units: Units, draws: list, a: int, j: int) -> np.ndarray:
        if j in self.own:
            return units.store.piece[list(self.own[j])]
        ids, begin = draws[self.source[j]][:2]
        return ids[begin[a + j]:begin[a + j + 1]]

    def ids(self, units: Units, draws: list, a: int) -> np.ndarray:
        """All piece ids, run by run of units of one source."""
        n = len(self.source)
        cuts = {0, n, *(np.flatnonzero(np.diff(self.source)) + 1).tolist()}
        for j in self.own:
            cuts |= {j, j + 1}
        edge = sorted(cuts)
        parts = []
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            if x in self.own:
                parts.append(self.unit(units, draws, a, x))
            else:
                ids, begin = draws[self.source[x]][:2]
                parts.append(ids[begin[a + x]:begin[a + y]])
        return np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)


class _Rest:
    """All segmentations that share a sample's units before ``low`` and differ from it at some unit from there on."""

    def __init__(self, sample: _Sample, low: int):
        self.sample, self.low = sample, low
        before = np.cumsum(sample.logq[:-1]) if len(sample.logq) else sample.logq
        with np.errstate(divide="ignore"):
            #: Log mass of those that first differ at each place from ``low`` on.
            self.logs = np.log(sample.others[low:])
        self.before = np.concatenate([[0.0], before])[low:] if len(sample.logq) else before
        self.logs += self.before
        self.excluded: dict[int, list[tuple[int, ...]]] = {}

    def set_left(self, j: int, left: float) -> None:
        """The mass left at unit ``j`` is now ``left``."""
        self.logs[j - self.low] = self.before[j - self.low] + math.log(left) if left > 0.0 else -math.inf

    def log_mass(self) -> float:
        top = float(self.logs.max(initial=-math.inf))
        return top + math.log(float(np.exp(self.logs - top).sum())) if top > -math.inf else top

    def place(self, draw: _Draws) -> int:
        """A unit to differ at, by mass."""
        total = np.cumsum(np.exp(self.logs - self.logs.max()))
        k = min(int(np.searchsorted(total, draw() * total[-1], side="right")), len(total) - 1)
        while self.logs[k] == -math.inf:
            k -= 1
        return self.low + k


def _search(units: Units, row: int, k: int, key: int, draws: list) -> list[tuple[_Sample, float, float]]:
    """Up to ``k`` samples of one text: (sample, perturbed value, inclusion score), best first."""
    a, b = int(units.first[row]), int(units.first[row + 1])
    draw, order = _Draws(key), itertools.count()
    value = -math.log(-math.log(draw()))
    first = _Sample(draws[0][2][a:b], draws[0][3][a:b], np.zeros(b - a, np.int16), {})
    found = [(first, value)]
    queue: list = []

    def push(rest: _Rest, top: float) -> None:
        mean, u = rest.log_mass(), draw()
        if mean > -math.inf:
            heapq.heappush(queue, (-_truncated(u, mean, top), next(order), rest))

    push(_Rest(first, 0), value)
    while queue and len(found) < k:
        value, _, rest = heapq.heappop(queue)
        value = -value
        old = rest.sample
        j = rest.place(draw)
        kind = int(units.kind[a + j])
        excluded = rest.excluded.setdefault(j, [])
        if not excluded:
            excluded.append(units.store.arcs_of(kind, old.unit(units, draws, a, j)))
        arcs, lq = units.store.without(kind, excluded).draw(draw)
        s = len(found)
        more = draws[s]
        sample = _Sample(np.concatenate([old.logq[:j], [lq], more[2][a + j + 1:b]]),
                         np.concatenate([old.others[:j], [0.0], more[3][a + j + 1:b]]),
                         np.concatenate([old.source[:j + 1], np.full(b - a - j - 1, s, np.int16)]),
                         {**{i: x for i, x in old.own.items() if i < j}, j: arcs})
        found.append((sample, value))
        excluded.append(arcs)
        rest.set_left(j, units.store.without(kind, excluded).left)
        push(rest, value)
        push(_Rest(sample, j + 1), value)
    limit = max((-q[0] for q in queue), default=-math.inf)
    return [(s, g, 1.0 if limit == -math.inf else -math.expm1(-math.exp(min(s.total - limit, 700.0)))) for s, g in found]


def sample_chunk(c: Chunk, keys: np.ndarray, k: int, store: UnitStore):
    """Per text its samples: lists of (ids, log probability, perturbed value, inclusion score)."""
    units = Units(c, store)
    n_units = np.diff(units.first)
    # an occurrence's draws depend on its row's key and its place in the row alone
    place = np.arange(len(units.kind)) - np.repeat(units.first[:-1], n_units)
    seed = splitmix(np.repeat(splitmix(keys), n_units) + place.astype(U64))
    draws = [store.ancestral(units.kind, units.by_kind, seed, s) for s in range(k)]
    for row, key in enumerate(splitmix(keys ^ U64(0x6B65)).tolist()):
        a = int(units.first[row])
        yield [(s.ids(units, draws, a), s.total, g, inc) for s, g, inc in _search(units, row, k, key, draws)]


def spelled(ids: np.ndarray, pieces: Spelling) -> np.ndarray:
    """The bytes a segmentation spells, without the leading space."""
    size = pieces.spell_size[ids]
    end = np.cumsum(size)
    return pieces.spell[np.repeat(pieces.spell_at[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)][1:]


def decode(ids: np.ndarray, pieces: Spelling) -> str:
    """The text a segmentation spells."""
    return spelled(ids, pieces).tobytes().decode()


_SCORES = [("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()), ("perturbed", pa.float64()),
           ("inclusion", pa.float64())]
#: Texts sampled together, in bytes; ids decoded together.
SAMPLE_CHUNK, DECODE_CHUNK = 512 << 10, 128 << 10


def _run(model: str, k: int, sharpness: float, names: list[str], text_col: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # not kept beyond the task: a worker that goes on to other work would hold it
        pieces = Pieces(model, space_runs=True)
        store = UnitStore(pieces, piece_logp(pieces, sharpness))
        for batch in batches:
            for c in chunks(batch.column(text_col), SAMPLE_CHUNK):
                rows = len(c.offsets) - 1
                part = batch.slice(c.rows.start, rows)
                keys = part.column("__key").to_numpy().view(U64)
                at, out, last = [], [], []
                for row, found in enumerate(sample_chunk(c, keys, k, store)):
                    text = c.data[c.offsets[row]:c.offsets[row + 1]]
                    for n, (ids, lp, g, inc) in enumerate(found):
                        at.append(row)
                        out.append((n + 1, len(ids), lp, g, inc))
                        if digest:
                            last.append((zlib.crc32(ids.astype("<u4").tobytes()), np.array_equal(spelled(ids, pieces), text)))
                        else:
                            last.append(ids)
                take = pa.array(at, pa.int64())
                cols = [part.column(x).take(take) for x in names]
                cols += [pa.array(v, t) for v, (_, t) in zip(zip(*out, strict=True), _SCORES, strict=True)] if out \
                    else [pa.array([], t) for _, t in _SCORES]
                if digest:
                    cols += [pa.array([x[0] for x in last], pa.int64()), pa.array([x[1] for x in last], pa.bool_())]
                else:
                    off = np.concatenate([[0], np.cumsum([len(x) for x in last])]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(last) if last else np.zeros(0, np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *(x for x, _ in _SCORES), *(("ids_crc32", "round_trip") if digest else ("ids",))])
    return run


def sample_segmentations(docs: DataFrame, model: str, k: int = 2, sharpness: float = 1.0, id_col: str = "doc_id",
                         text_col: str = "text", keep: list[str] | None = None, key: Column | None = None,
                         digest: bool = False) -> DataFrame:
    """Per row up to ``k`` rows: ``keep`` columns (the id alone by default), ``sample`` (rank from 1), ``n_pieces``,
    ``log_prob``, ``perturbed``, ``inclusion`` and ``ids``; with ``digest`` in place of the ids
    ``ids_crc32`` (of little-endian 32-bit ids) and ``round_trip`` (whether decoding gave the text back)."""
    keep = [id_col] if keep is None else keep
    seed = F.xxhash64(F.col(id_col).cast("string")) if key is None else key
    text = [] if text_col in keep else [F.col(text_col).alias("__text")]
    inner = docs.select(*[F.col(f"`{x}`") for x in keep], *text, seed.alias("__key"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema if f.name in keep]
    schema += ["sample int", "n_pieces long", "log_prob double", "perturbed double", "inclusion double"]
    schema += ["ids_crc32 long", "round_trip boolean"] if digest else ["ids array<int>"]
    return inner.mapInArrow(_run(model, k, sharpness, keep, "__text" if text else text_col, digest), ", ".join(schema))


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a list column one after another, and where each row's begin."""
    edge = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[edge[0]:edge[-1]], edge - edge[0]


class _Decoder:
    """Texts of many segmentations at once: a piece's bytes are taken by its number, a text's first ones without their space."""

    def __init__(self, model: str):
        pieces = Spelling(model)
        self.bytes = pa.array([*pieces.bytes_of, *(x[1:] for x in pieces.bytes_of)], pa.large_binary())
        self.size = pieces.size

    def __call__(self, column: pa.ListArray) -> Iterator[tuple[slice, pa.StringArray]]:
        """Texts of a column of ids, some rows after others; null for null."""
        ids, edge = _lists(column)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(edge, edge[first] + DECODE_CHUNK, side="right")) - 1)
            at = edge[first:last + 1] - edge[first]
            take = ids[edge[first]:edge[last]].astype(np.int64)
            take[at[:-1][at[1:] > at[:-1]]] += self.size
            _, offsets, data = self.bytes.take(pa.array(take)).buffers()
            at = np.frombuffer(offsets, np.int64)[at].astype(np.int32)
            text = pa.Array.from_buffers(pa.string(), last - first, [None, pa.py_buffer(at), data])
            text.validate(full=True)
            if column.null_count:
                text = pc.if_else(column.slice(first, last - first).is_valid(), text, None)
            yield slice(first, last), text
            first = last


def _join_pieces(model: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _Decoder(model)
        for batch in batches:
            for rows, text in decoder(batch.column("ids")):
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), text], names=[*names, "decoded"])
    return run


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text its ``ids`` spell (null for null)."""
    names = [c for c in encoded.columns if c != "decoded"]
    inner = encoded.select(*names)
    return inner.mapInArrow(_join_pieces(model, names), ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema] + ["decoded string"]))


def _check_pieces(model: str, names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _Decoder(model)
        for batch in batches:
            for rows, text in decoder(batch.column("ids")):
                part = batch.slice(rows.start, rows.stop - rows.start)
                ids, edge = _lists(part.column("ids"))
                raw = np.ascontiguousarray(ids, "<u4")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                same = pc.equal(text, part.column(text_col).fill_null(""))
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), pa.array(crc, pa.int64()), same],
                                                 names=[*names, "ids_crc32", "round_trip"])
    return run


def digest_pieces(encoded: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """``encoded`` decoded and compared: in place of texts and ids ``ids_crc32`` (of little-endian 32-bit ids) and
    ``round_trip``, whether the ids spell the text that was encoded (null: empty)."""
    names = [c for c in encoded.columns if c not in (text_col, "ids")]
    return encoded.mapInArrow(_check_pieces(model, names, text_col), ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in names] + ["ids_crc32 long", "round_trip boolean"]))
