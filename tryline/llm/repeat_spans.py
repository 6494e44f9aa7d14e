"""Exact repeats of at least ``length`` bytes across all documents, found by suffix arrays and cut out (operator 11).

A byte goes when it lies in a string of ``length`` bytes that also starts
earlier: in a document of smaller id, or further left in the same one.

What a suffix array of the whole corpus would tell is found in shares that
one task can hold:

1. **Segments.** The least hash among the ``KMER``-byte strings of a window of
   ``length`` bytes is its anchor. Consecutive windows with one anchor are a
   segment (some 40 windows). Equal windows have equal anchor strings at equal
   distances, so they lie in segments that share the anchor's hash.
2. **Collapse.** Segments are dealt out by anchor hash. Of segments with equal
   contents all but the earliest are repeats as a whole; this happens in each
   map task first, so that a text with any number of copies reaches a task as
   one row per map task. Anchors with a single segment in the corpus are done.
3. **Suffix sort.** The remaining segments of an anchor differ in part. Their
   bytes are fetched and dealt out by anchor; ``suffix_sort`` orders the
   suffixes of many anchors' segments at once, common prefixes of neighbours
   give the classes of equal windows, and all but the earliest of a class are
   repeats.
4. **Cut.** The spans of a document are merged and cut from its text.

An anchor with more than ``HOT`` different segments is not gathered: its
segments are cut into single windows, which are dealt out by their own hash
and collapsed as in step 2, so no key holds more than one row per map task.
Texts cross the network twice (steps 3 and 4), segments as packed arrays.
Equal contents of one anchor are told by 64-bit hashes.

Rows of equal id and rows without id are ordered by a row key of a written
copy (made only if there are such rows); rows without id come last. Defined
cases: a null text is empty; texts below ``length`` bytes stay; equal texts
keep the earliest; texts of any length are scanned in pieces that overlap by
``length - 1`` bytes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tryline.llm.common import Scratch
from tryline.llm.suffix_sort import adjacent_prefixes, byte_words, suffix_array
from tryline.llm.textops import span_hashes, splitmix

U64 = np.uint64
LENGTH, KMER = 100, 24
#: Different segments of one anchor above which they are cut into single windows.
HOT = 20_000
#: Bytes scanned at a time; bytes of text whose segments a map task collapses before it sends them.
PIECE_BYTES, FLUSH_BYTES = 512 << 10, 16 << 20
#: Bytes of segments that are suffix-sorted at a time (some 60 bytes are held for each), that go into one share, and that are fetched at a time.
SORT_BYTES, SHARE_BYTES, FETCH_BYTES = 1 << 20, 2 << 20, 8 << 20
#: Text bytes whose segments make one bucket: small for small corpora, bounded by memory for large ones.
BUCKET_BYTES, MOST_SMALL_BUCKETS, LARGE_BUCKET_BYTES = 2 << 20, 4096, 32 << 20
#: Single windows that make one bucket (some 200 bytes are held for each).
BUCKET_WINDOWS = 1 << 18
BUCKETS_PER_TASK = 4
_SEPARATOR = np.uint8(0xFF)      # in no UTF-8 text
_LAST = np.iinfo(np.int64).max

Batches = Iterator[pa.RecordBatch]
Task = Callable[[Batches], Batches]

#: A segment: anchor hash, hash of its bytes, its document (id and row key), first byte, anchor's distance from it, windows.
SEGMENT = np.dtype([("anchor", "<u8"), ("contents", "<u8"), ("id", "<i8"), ("key", "<i8"), ("start", "<u4"), ("off", "u1"), ("windows", "u1")])
SPAN = np.dtype([("id", "<i8"), ("key", "<i8"), ("start", "<u4"), ("end", "<u4")])

SPANS, SEGMENTS, HOT_SEGMENTS = 0, 1, 2
PIECES = "kind int, bucket long, n long, piece binary, bytes binary"


def pack(rows: np.ndarray) -> bytes:
    """A structured array byte plane by byte plane, which shuffle compression can use."""
    return np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), rows.dtype.itemsize).T).tobytes()


def unpack(piece: bytes, dtype: np.dtype) -> np.ndarray:
    planes = np.frombuffer(piece, np.uint8).reshape(dtype.itemsize, -1)
    return np.array(planes.T, order="C").reshape(-1).view(dtype)


def _pieces(kind: int, bucket: np.ndarray, rows: np.ndarray, blobs: list[bytes] | None = None) -> pa.RecordBatch | None:
    """One row per bucket; ``blobs`` (one per row of ``rows``) are joined in the same order."""
    if not len(rows):
        return None
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist()
    bounds = list(zip(first, [*first[1:], len(rows)], strict=True))
    joined = [None] * len(bounds) if blobs is None else [b"".join(blobs[k] for k in order[a:b]) for a, b in bounds]
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(bounds), pa.int32()), pa.array(bucket[first], pa.int64()), pa.array([b - a for a, b in bounds], pa.int64()),
         pa.array([pack(rows[a:b]) for a, b in bounds], pa.binary()), pa.array(joined, pa.binary())],
        names=["kind", "bucket", "n", "piece", "bytes"])


def _doc_bucket(rows: np.ndarray, buckets: int) -> np.ndarray:
    return (splitmix(rows["id"].astype(U64) ^ splitmix(rows["key"].astype(U64))) % U64(buckets)).astype(np.int64)


def _anchor_bucket(rows: np.ndarray, buckets: int) -> np.ndarray:
    return (splitmix(rows["anchor"].copy()) % U64(buckets)).astype(np.int64)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima of blocks forwards and backwards."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).reshape(-1)
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def segments_of(data: np.ndarray, first: np.ndarray, length: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Segments of texts that lie one after another in ``data``, text k from ``first[k]`` to ``first[k + 1]``.

    Returns start, number of windows, anchor's distance, anchor hash, contents hash and text number of each.
    """
    n = len(data)
    valid = np.zeros(n + 1, np.int32)
    a, b = first[:-1], first[1:] - (length - 1)
    fits = b > a
    np.add.at(valid, a[fits], 1)
    np.add.at(valid, b[fits], -1)
    starts = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U64), none.astype(U64), none
    at = np.arange(n - kmer + 1)
    hashes = span_hashes(data, at, at + kmer, lower=False)
    # the position in the low bits: of equal hashes the leftmost is least
    low = U64(max(int(n).bit_length(), 1))
    least = sliding_minimum((hashes >> low << low) | at.astype(U64), length - kmer + 1)[starts]
    anchor = (least & ((U64(1) << low) - U64(1))).astype(np.int64)
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
    begin = starts[new]
    windows = np.diff(np.append(new, len(starts)))
    off = anchor[new] - begin
    contents = span_hashes(data, begin, begin + windows + length - 1, lower=False)
    contents = splitmix(contents ^ (off.astype(U64) << U64(32)))
    return begin, windows, off, hashes[anchor[new]], contents, np.searchsorted(first, begin, side="right") - 1


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, row keys, and the texts' bytes with their offsets."""
    texts = batch.column("text").fill_null("").cast(pa.large_string())
    _, off, buf = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return batch.column("id").to_numpy(), batch.column("key").to_numpy(), data, offsets


def scan(batch: pa.RecordBatch, length: int, kmer: int, piece: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """Segments of a batch of documents, a piece of text at a time."""
    ids, keys, data, offsets = _texts(batch)
    parts, rows, bases, held = [], [], [], 0

    def emit() -> np.ndarray:
        first = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
        begin, windows, off, anchor, contents, part = segments_of(np.concatenate(parts), first, length, kmer)
        out = np.zeros(len(begin), SEGMENT)
        row = np.array(rows, np.int64)[part]
        out["id"], out["key"] = ids[row], keys[row]
        out["start"] = begin - first[part] + np.array(bases, np.int64)[part]
        out["off"], out["windows"], out["anchor"], out["contents"] = off, windows, anchor, contents
        return out

    for row in range(len(ids)):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for base in range(a, b - length + 1, piece):
            parts.append(data[base:min(base + piece + length - 1, b)])
            rows.append(row)
            bases.append(base - a)
            held += len(parts[-1])
            if held >= piece:
                yield emit()
                parts, rows, bases, held = [], [], [], 0
    if parts:
        yield emit()


def collapse(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of every group of equal segments, ordered by anchor, and the spans of the others."""
    order = np.argsort(rows["anchor"], kind="stable")
    anchor = rows["anchor"][order]
    same = np.append(False, anchor[1:] == anchor[:-1]) if len(rows) else np.zeros(0, bool)
    several = same | np.append(same[1:], False) if len(rows) else same
    rows = rows[order]
    some = rows[several]
    some = some[np.lexsort((some["start"], some["key"], some["id"], some["contents"], some["anchor"]))]
    again = np.append(False, (some["anchor"][1:] == some["anchor"][:-1]) & (some["contents"][1:] == some["contents"][:-1])) \
        if len(some) else np.zeros(0, bool)
    late = some[again]
    spans = np.zeros(len(late), SPAN)
    for name in ("id", "key", "start"):
        spans[name] = late[name]
    spans["end"] = late["start"] + late["windows"] + np.uint32(length - 1)
    return np.concatenate([rows[~several], some[~again]]), spans


def _scan_task(length: int, kmer: int, buckets: int, flush: int) -> Task:
    """Documents to packed segments by anchor, collapsed within the task, and the spans that this settles."""
    def run(batches: Batches) -> Batches:
        held: list[np.ndarray] = []
        size = 0

        def out() -> Batches:
            rows, spans = collapse(np.concatenate(held), length)
            yield from filter(None, (_pieces(SEGMENTS, _anchor_bucket(rows, buckets), rows),
                                     _pieces(SPANS, _doc_bucket(spans, buckets), spans)))
            held.clear()

        for batch in batches:
            for found in scan(batch, length, kmer):
                held.append(found)
                size += int(found["windows"].sum())
                if size >= flush:
                    yield from out()
                    size = 0
        if held:
            yield from out()

    return run


def _by_bucket(batches: Batches) -> Iterator[tuple[int, list[tuple[int, pa.Buffer, pa.Buffer | None]]]]:
    """The pieces of one bucket after another, from rows sorted by bucket; pieces stay in their batch's memory."""
    now, held = None, []
    for batch in batches:
        numbers = [batch.column(k).to_pylist() for k in ("bucket", "kind")]
        for bucket, kind, piece, blob in zip(*numbers, batch.column("piece"), batch.column("bytes"), strict=True):
            if bucket != now:
                if held:
                    yield now, held
                now, held = bucket, []
            held.append((kind, piece.as_buffer(), blob.as_buffer()))
    if held:
        yield now, held


def _collapse_task(length: int, doc_buckets: int, hot: int, most: int) -> Task:
    """Segments of one bucket after another: spans of equal ones, and the differing ones of anchors that several share.

    Beyond ``most`` segments held, those of hot anchors are passed on at once.
    """
    def run(batches: Batches) -> Batches:
        for _, pieces in _by_bucket(batches):
            held, count, limit = [], 0, most
            hot_anchors = np.zeros(0, U64)
            for kind, piece, _ in pieces:
                if kind == SPANS:
                    rows = unpack(piece, SPAN)
                    yield _pieces(SPANS, _doc_bucket(rows, doc_buckets), rows)
                    continue
                rows = unpack(piece, SEGMENT)
                if len(hot_anchors):
                    known = np.isin(rows["anchor"], hot_anchors)
                    if known.any():
                        yield _pieces(HOT_SEGMENTS, _doc_bucket(rows[known], doc_buckets), rows[known])
                        rows = rows[~known]
                held.append(rows)
                count += len(rows)
                if count > limit:
                    rows, spans = collapse(np.concatenate(held), length)
                    yield from filter(None, [_pieces(SPANS, _doc_bucket(spans, doc_buckets), spans)])
                    names, counts = np.unique(rows["anchor"], return_counts=True)
                    hot_anchors = np.union1d(hot_anchors, names[counts > hot])
                    known = np.isin(rows["anchor"], hot_anchors)
                    yield from filter(None, [_pieces(HOT_SEGMENTS, _doc_bucket(rows[known], doc_buckets), rows[known])])
                    held = [rows[~known]]
                    count = len(held[0])
                    limit = max(most, 2 * count)
            if not held:
                continue
            rows, spans = collapse(np.concatenate(held), length)
            yield from filter(None, [_pieces(SPANS, _doc_bucket(spans, doc_buckets), spans)])
            names, number, counts = np.unique(rows["anchor"], return_inverse=True, return_counts=True)
            shared = counts[number]
            for kind, some in ((SEGMENTS, (shared > 1) & (shared <= hot)), (HOT_SEGMENTS, shared > hot)):
                yield from filter(None, [_pieces(kind, _doc_bucket(rows[some], doc_buckets), rows[some])])

    return run


def _join_by_doc(dtype: np.dtype, merge: Callable[[np.ndarray], np.ndarray] | None) -> Task:
    """Packed rows by document bucket to one row per document, its rows packed again."""
    def run(batches: Batches) -> Batches:
        for _, pieces in _by_bucket(batches):
            rows = np.concatenate([unpack(piece, dtype) for _, piece, _ in pieces])
            rows = rows[np.lexsort((rows["start"], rows["key"], rows["id"]))]
            if merge is not None:
                rows = merge(rows)
            new = np.flatnonzero(np.append(True, (rows["id"][1:] != rows["id"][:-1]) | (rows["key"][1:] != rows["key"][:-1]))).tolist()
            ends = [*new[1:], len(rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["id"][new]), pa.array(rows["key"][new]),
                 pa.array([pack(rows[a:b]) for a, b in zip(new, ends, strict=True)], pa.binary())], names=["id2", "key2", "rows"])

    return run


def merge_spans(rows: np.ndarray) -> np.ndarray:
    """Disjoint, not touching spans in ascending order; ``rows`` are ordered by document and start."""
    new_doc = np.append(True, (rows["id"][1:] != rows["id"][:-1]) | (rows["key"][1:] != rows["key"][:-1]))
    number = np.cumsum(new_doc).astype(np.int64)
    reach = np.maximum.accumulate((number << 33) + rows["end"].astype(np.int64))
    before = np.append(np.int64(0), reach[:-1])
    new = np.flatnonzero((number << 33) + rows["start"].astype(np.int64) > before)
    out = rows[new]
    out["end"] = reach[np.append(new[1:], len(rows)) - 1] - (number[new] << 33)
    return out


def _fetch_task(length: int, share_buckets: int, hot_buckets: int, flush: int) -> Task:
    """Documents beside their open segments to the segments' bytes; hot ones to single windows."""
    def run(batches: Batches) -> Batches:
        held, blobs, single = [], [], []
        size = 0

        def out() -> Batches:
            if single:
                rows = np.concatenate(single)
                yield _pieces(HOT_SEGMENTS, _anchor_bucket(rows, hot_buckets), rows)
            if blobs:
                rows = np.concatenate(held)
                yield _pieces(SEGMENTS, _anchor_bucket(rows, share_buckets), rows, blobs)
            for some in (held, blobs, single):
                some.clear()

        for batch in batches:
            for text, packed in zip(batch.column("text"), batch.column("rows"), strict=True):
                every = unpack(packed.as_buffer(), SEGMENT)
                body = text.as_buffer()
                data = np.frombuffer(body, np.uint8)
                view = memoryview(body)
                # a long document's segments some after others
                for k in range(0, len(every), flush // (2 * length)):
                    rows = every[k:k + flush // (2 * length)]
                    hot = rows[rows["contents"] == 0]
                    rows = rows[rows["contents"] != 0]
                    if len(hot):
                        single.append(_single_windows(hot, data, length))
                        size += single[-1].nbytes
                    if len(rows):
                        held.append(rows)
                        blobs.extend(bytes(view[a:a + w + length - 1]) for a, w in zip(rows["start"].tolist(), rows["windows"].tolist(), strict=True))
                        size += int(rows["windows"].sum(dtype=np.int64)) + (length - 1) * len(rows)
                    if size >= flush:
                        yield from out()
                        size = 0
        yield from out()

    return run


def _single_windows(rows: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """The windows of segments as segments of one window each, the window's own hash as anchor."""
    windows = rows["windows"].astype(np.int64)
    out = np.zeros(int(windows.sum()), SEGMENT)
    out["id"], out["key"] = np.repeat(rows["id"], windows), np.repeat(rows["key"], windows)
    step = np.arange(len(out)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(rows["start"].astype(np.int64), windows) + step
    out["start"], out["windows"] = start, 1
    out["anchor"] = span_hashes(data, start, start + length, lower=False)
    # with the whole's hash this tells both halves: 128 bits for windows of the entire corpus
    out["contents"] = np.maximum(span_hashes(data, start, start + length // 2, lower=False), U64(1))
    return out


def repeated_windows(rows: np.ndarray, bytes_: bytes, length: int) -> np.ndarray:
    """Spans of all windows of the segments ``rows`` (their bytes one after another) that equal an earlier one."""
    windows = rows["windows"].astype(np.int64)
    sizes = windows + length - 1
    # every segment is followed by a separator, which no window holds
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.full(int(sizes.sum()) + len(rows), _SEPARATOR, np.uint8)
    inside = np.ones(len(text), bool)
    inside[begin + sizes] = False
    text[inside] = np.frombuffer(bytes_, np.uint8)
    words = byte_words(text)
    order = suffix_array(text, words, length)
    segment = np.repeat(np.arange(len(rows)), sizes + 1)
    offset = np.arange(len(text)) - begin[segment]
    order = order[offset[order] < windows[segment[order]]]
    if not len(order):
        return np.zeros(0, SPAN)
    equal = adjacent_prefixes(words, order, length) >= length
    docs = np.lexsort((rows["key"], rows["id"]))
    new = np.append(False, (rows["id"][docs][1:] != rows["id"][docs][:-1]) | (rows["key"][docs][1:] != rows["key"][docs][:-1]))
    rank = np.empty(len(rows), np.int64)
    rank[docs] = np.cumsum(new)
    seg = segment[order]
    place = (rank[seg] << 32) + rows["start"].astype(np.int64)[seg] + offset[order]
    first = np.flatnonzero(~equal)
    earliest = np.repeat(np.minimum.reduceat(place, first), np.diff(np.append(first, len(place))))
    late = np.sort(order[place > earliest])
    if not len(late):
        return np.zeros(0, SPAN)
    seg, off = segment[late], offset[late]
    new = np.flatnonzero(np.append(True, (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)))
    last = np.append(new[1:], len(late)) - 1
    out = np.zeros(len(new), SPAN)
    out["id"], out["key"] = rows["id"][seg[new]], rows["key"][seg[new]]
    out["start"] = rows["start"][seg[new]] + off[new].astype(np.uint32)
    out["end"] = rows["start"][seg[new]] + off[last].astype(np.uint32) + np.uint32(length)
    return out


def _sort_task(length: int, doc_buckets: int, sort_bytes: int) -> Task:
    """Segments with their bytes, whole anchors together, to the spans of repeated windows."""
    def run(batches: Batches) -> Batches:
        for _, pieces in _by_bucket(batches):
            rows = np.concatenate([unpack(piece, SEGMENT) for _, piece, _ in pieces])
            body = memoryview(b"".join(blob for _, _, blob in pieces))
            sizes = rows["windows"].astype(np.int64) + length - 1
            begin = np.cumsum(sizes) - sizes
            order = np.argsort(rows["anchor"], kind="stable")
            anchor = rows["anchor"][order]
            first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            upto = np.cumsum(sizes[order])[np.append(first[1:], len(rows)) - 1]
            # whole anchors until a share is full
            share = np.unique(upto // sort_bytes, return_index=True)[1]
            cuts = [*first[share].tolist(), len(rows)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                some = order[a:b]
                part = b"".join(body[p:p + s] for p, s in zip(begin[some].tolist(), sizes[some].tolist(), strict=True))
                spans = repeated_windows(rows[some], part, length)
                yield from filter(None, [_pieces(SPANS, _doc_bucket(spans, doc_buckets), spans)])

    return run


def _cut_task(digest: bool) -> Task:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            n, removed, spans, kept = [], [], [], []
            for text, packed in zip(batch.column("text"), batch.column("rows"), strict=True):
                body = memoryview(text.as_buffer() or b"")
                rows = unpack(packed.as_py(), SPAN) if packed.is_valid else np.zeros(0, SPAN)
                left, parts = 0, []
                for a, b in zip(rows["start"].tolist(), rows["end"].tolist(), strict=True):
                    parts.append(body[left:a])
                    left = b
                parts.append(body[left:])
                n.append(len(body))
                removed.append(int((rows["end"].astype(np.int64) - rows["start"]).sum()))
                spans.append(len(rows))
                whole = b"".join(parts)
                kept.append(hashlib.sha256(whole).hexdigest() if digest else whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.string() if digest else pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """``(doc_id, id, key, text)`` with a unique ``(id, key)`` in the documents' order, and the bytes of all texts."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    per_id = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
    state = per_id.agg(F.max(F.when(F.col("doc_id").isNull(), 2).otherwise(F.col("n"))).alias("most"), F.sum("size").alias("size")).first()
    if (state["most"] or 0) > 1:
        named = scratch.table(named, "rows")
        key = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    else:
        key = F.lit(0).cast("long")
    keyed = named.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("id"), key.alias("key"), "text")
    return keyed, int(state["size"] or 0)


def _dealt(pieces: DataFrame, tasks: int) -> DataFrame:
    return pieces.repartition(tasks, "bucket").sortWithinPartitions("bucket")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, digest: bool = False,
                   kmer: int = KMER, hot: int = HOT) -> DataFrame:
    """Per document ``id_col, n_bytes, n_removed, n_spans, kept``: its remaining bytes, or with ``digest`` their SHA-256.

    ``n_spans`` counts the maximal runs of removed bytes. ``length`` is at most 255.
    """
    if not kmer < length <= 255:
        raise ValueError("length must be above kmer and below 256")
    scratch = Scratch(docs.sparkSession, "repeats")
    keyed, size = _keyed(docs, id_col, text_col, scratch)
    buckets = max(min(size // BUCKET_BYTES, MOST_SMALL_BUCKETS), size // LARGE_BUCKET_BYTES, 8 * BUCKETS_PER_TASK)
    tasks = buckets // BUCKETS_PER_TASK
    most = 4 * LARGE_BUCKET_BYTES // (length - kmer)
    scanned = keyed.select("id", "key", "text").mapInArrow(_scan_task(length, kmer, buckets, FLUSH_BYTES), PIECES)
    found = scratch.table(_dealt(scanned, tasks).mapInArrow(_collapse_task(length, buckets, hot, most), PIECES), "found")
    open_rows = {row["kind"]: row["n"] for row in found.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    spans = [found.where(F.col("kind") == SPANS)]
    if open_rows.get(SEGMENTS) or open_rows.get(HOT_SEGMENTS):
        shares = max(open_rows.get(SEGMENTS, 0) * 2 * length // SHARE_BYTES, 8 * BUCKETS_PER_TASK)
        hot_buckets = max(open_rows.get(HOT_SEGMENTS, 0) * (length - kmer) // BUCKET_WINDOWS, buckets)
        marked = found.where(F.col("kind") != SPANS).mapInArrow(_mark_hot, PIECES)
        per_doc = _dealt(marked, tasks).mapInArrow(_join_by_doc(SEGMENT, None), "id2 long, key2 long, rows binary")
        beside = keyed.join(per_doc, (F.col("id") == F.col("id2")) & (F.col("key") == F.col("key2"))).select("text", "rows")
        fetched = scratch.table(beside.mapInArrow(_fetch_task(length, shares, hot_buckets, FETCH_BYTES), PIECES), "fetched")
        sorted_ = _dealt(fetched.where(F.col("kind") == SEGMENTS), shares // BUCKETS_PER_TASK)
        spans.append(sorted_.mapInArrow(_sort_task(length, buckets, SORT_BYTES), PIECES))
        if open_rows.get(HOT_SEGMENTS):
            again = _dealt(fetched.where(F.col("kind") == HOT_SEGMENTS), hot_buckets // BUCKETS_PER_TASK).mapInArrow(_collapse_task(length, buckets, hot, most), PIECES)
            spans.append(again.where(F.col("kind") == SPANS))
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    merged = scratch.table(_dealt(every, tasks).mapInArrow(_join_by_doc(SPAN, merge_spans), "id2 long, key2 long, rows binary"), "spans")
    scratch.drop(*[name for name in ("found", "fetched") if name in scratch.paths])
    beside = keyed.join(merged, (F.col("id") == F.col("id2")) & (F.col("key") == F.col("key2")), "left").select("doc_id", "text", "rows")
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "kept binary")
    return beside.mapInArrow(_cut_task(digest), shape).withColumnRenamed("doc_id", id_col)


def _mark_hot(batches: Batches) -> Batches:
    """Hot segments need their bytes only once more: their contents hash is set to 0, no other's is."""
    for batch in batches:
        for kind, bucket, piece in zip(*[batch.column(k).to_pylist() for k in ("kind", "bucket", "piece")], strict=True):
            rows = unpack(piece, SEGMENT)
            rows["contents"] = 0 if kind == HOT_SEGMENTS else np.maximum(rows["contents"], 1)
            yield _pieces(SEGMENTS, np.full(len(rows), bucket), rows)
