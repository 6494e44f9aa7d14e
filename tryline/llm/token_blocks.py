"""Token ids in files of patched frame-of-reference blocks (operator 4).

Documents are ranged by id and sorted, so file order is document order. Each
task encodes its documents and writes shard files of at most about
``SHARD_TOKENS`` ids; only files named in the returned manifest count, so a
task that is run again leaves no trace in the result.

A block holds ``BLOCK`` ids: the block's minimum is subtracted, the rest is
packed at the width that holds ``PERCENTILE`` of its values, and values that
need more bits stand in the block's exception list (their packed bits are
zero). Layout of a shard, little-endian: the header, then the sections named
in it - block minimums, widths, exception counts, an index of block starts in
the packed bytes, packed bytes, exception positions and values, document ids
and the first id index of each document.

Encoding uses the tokenizers library. For byte-level BPE with the usual
splitting rule, texts are cut before runs of white space (where that rule
always cuts) and each distinct piece, known by a 64-bit hash, is encoded once per worker's cache; other
tokenizers, and texts that hold one of the tokenizer's added tokens, are
encoded whole.

Defined cases: null and empty texts hold the end id alone; ids are ordered
ascending, null first; rows of equal id follow one another, each with its own
tokens; an empty table makes no file and no row.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tryline.llm.common import Scratch, worker_cache
from tryline.llm.lattice import HashIndex
from tryline.llm.textops import U64, Chunk, chunks, span_hashes

BLOCK = 128
PERCENTILE = 0.9
SHARD_TOKENS = 4 << 20
#: Shards that a reading task takes one after another, where there are very many.
SHARDS_PER_READ = 64
#: Texts encoded together, in bytes (a task holds some 90 bytes for each); new pieces encoded together.
ENCODE_CHUNK, LEARN_PIECES = 1 << 20, 1 << 14
CACHE_PIECES = 1_000_000
MAGIC = b"TLB1"
_HEADER = "<4sIQQQQQ"   # magic, block, docs, tokens, blocks, packed bytes, exceptions
_STEP = 2048                           # blocks packed at a time


#: By the bytes that a packed width needs: the type whose bits are taken.
_KINDS = (np.uint8, np.uint16, np.uint32, np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def pack_blocks(ids: np.ndarray) -> dict[str, np.ndarray]:
    """The sections of an id sequence (uint32)."""
    n_blocks = -(-len(ids) // BLOCK)
    out = {"base": np.zeros(n_blocks, np.uint32), "width": np.zeros(n_blocks, np.uint8), "n_exc": np.zeros(n_blocks, np.uint16)}
    packed: list[np.ndarray] = []
    pos: list[np.ndarray] = []
    val: list[np.ndarray] = []
    for a in range(0, n_blocks, _STEP):
        part = ids[a * BLOCK:(a + _STEP) * BLOCK]
        n = -(-len(part) // BLOCK)
        full = np.empty(n * BLOCK, np.uint32)
        full[:len(part)] = part
        full[len(part):] = part[-1]
        full = full.reshape(n, BLOCK)
        base = full.min(1)
        rest = full - base[:, None]
        need = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)
        width = np.sort(need, axis=1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1]
        over = need > width[:, None]
        rows, cols = np.nonzero(over)
        pos.append(cols.astype(np.uint8))
        val.append(rest[rows, cols])
        rest[rows, cols] = 0
        s = slice(a, a + n)
        out["base"][s], out["width"][s], out["n_exc"][s] = base, width, over.sum(1)
        # blocks of one width are packed together, then put back in order
        size = width.astype(np.int64) * (BLOCK // 8)
        start = np.cumsum(size) - size
        bytes_ = np.empty(int(size.sum()), np.uint8)
        for w in np.unique(width[width > 0]).tolist():
            sel = np.flatnonzero(width == w)
            kind = _KINDS[(w - 1) // 8]
            bits = np.unpackbits(rest[sel].astype(kind).view(np.uint8).reshape(len(sel), BLOCK, -1), axis=2, bitorder="little")[:, :, :w]
            rows_ = np.packbits(bits.reshape(len(sel), BLOCK * w), axis=1, bitorder="little")
            bytes_[start[sel][:, None] + np.arange(rows_.shape[1])] = rows_
        packed.append(bytes_)
    size = out["width"].astype(np.uint64) * np.uint64(BLOCK // 8)
    out["start"] = np.cumsum(size, dtype=np.uint64) - size
    out["packed"] = np.concatenate(packed) if packed else np.zeros(0, np.uint8)
    out["exc_pos"] = np.concatenate(pos) if pos else np.zeros(0, np.uint8)
    out["exc_val"] = np.concatenate(val) if val else np.zeros(0, np.uint32)
    return out


def unpack_blocks(x: dict[str, np.ndarray], first: int, last: int) -> np.ndarray:
    """Ids of the blocks ``first`` to ``last`` (exclusive), through the index of block starts."""
    parts = []
    exc = np.concatenate([[0], np.cumsum(x["n_exc"], dtype=np.int64)])
    for a in range(first, last, _STEP):
        s = slice(a, min(a + _STEP, last))
        width, start, base = x["width"][s], x["start"][s].astype(np.int64), x["base"][s]
        n = len(width)
        rest = np.zeros((n, BLOCK), np.uint32)
        for w in np.unique(width[width > 0]).tolist():
            sel = np.flatnonzero(width == w)
            raw = x["packed"][start[sel][:, None] + np.arange(BLOCK // 8 * w)]
            kind = _KINDS[(w - 1) // 8]
            bits = np.zeros((len(sel), BLOCK, 8 * kind().itemsize), np.uint8)
            bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(sel), BLOCK, w)
            rest[sel] = np.packbits(bits, axis=2, bitorder="little").view(kind)[:, :, 0]
        rows = np.repeat(np.arange(n), x["n_exc"][s])
        e = slice(exc[s.start], exc[s.stop])
        rest[rows, x["exc_pos"][e]] = x["exc_val"][e]
        parts.append((rest + base[:, None]).ravel())
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


_TYPES = (("base", np.uint32), ("width", np.uint8), ("n_exc", np.uint16), ("start", np.uint64), ("packed", np.uint8),
          ("exc_pos", np.uint8), ("exc_val", np.uint32), ("doc", np.int64), ("has_doc", np.uint8), ("first", np.uint64))


def shard_bytes(ids: np.ndarray, docs: list[int | None], first: np.ndarray) -> bytes:
    x = pack_blocks(ids)
    x["doc"] = np.array([d or 0 for d in docs], np.int64)
    x["has_doc"] = np.array([d is not None for d in docs], np.uint8)
    x["first"] = first.astype(np.uint64)
    head = struct.pack(_HEADER, MAGIC, BLOCK, len(docs), len(ids), len(x["base"]), len(x["packed"]), len(x["exc_pos"]))
    return head + b"".join(x[name].astype(kind, copy=False).tobytes() for name, kind in _TYPES)


def read_shard(data: bytes) -> tuple[dict[str, np.ndarray], int]:
    """The sections of a shard and its number of ids."""
    magic, block, docs, tokens, blocks, packed, exceptions = struct.unpack_from(_HEADER, data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token block file")
    count = {"packed": packed, "exc_pos": exceptions, "exc_val": exceptions, "doc": docs, "has_doc": docs, "first": docs + 1}
    at, x = struct.calcsize(_HEADER), {}
    for name, kind in _TYPES:
        x[name] = np.frombuffer(data, kind, count.get(name, blocks), at)
        at += x[name].nbytes
    return x, tokens


def document_ids(x: dict[str, np.ndarray], tokens: int, k: int) -> np.ndarray:
    """Ids of the shard's ``k``-th document, decoding its blocks only."""
    a, b = int(x["first"][k]), int(x["first"][k + 1])
    lo = a // BLOCK
    return unpack_blocks(x, lo, -(-b // BLOCK))[a - lo * BLOCK:b - lo * BLOCK]


class Encoder:
    """Whole-text ids from a tokenizer file, with a bounded cache of pieces.

    The splitting rule of byte-level BPE gives the last character of a run of
    white space to what follows if it is a space, and to itself otherwise; the
    rest of the run is one token sequence. Where no run is longer than two
    characters, cutting before every space and around every line break is
    therefore a cut of the rule's own, and so is one between a letter and a
    punctuation mark; other texts are cut before each run.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        pre = spec.get("pre_tokenizer") or {}
        self.cut = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                    and not pre.get("add_prefix_space") and spec["model"]["type"] == "BPE")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.spaced = re.compile(r"(?:(?![\x1c-\x1f])\s)*(?:[\x1c-\x1f]|\S)+|\s+")
        self.reset()

    def reset(self) -> None:
        """Empties the cache: piece hashes, and where each piece's ids stand."""
        self.keys, self.first, self.ids = np.zeros(0, U64), np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.main, self.young = HashIndex(self.keys), HashIndex(self.keys)
        self.old = 0                 # pieces in the main index; later ones are in the young one

    def direct(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, fresh: list[str]) -> list[np.ndarray]:
        """Ids of pieces without white space behind their first character, encoded as lines of a text."""
        lines = [p for p in fresh if p not in (" ", "\n")]
        line_break = self.direct("\n")[0]
        found: list[np.ndarray] = []
        for k in range(0, len(lines), LEARN_PIECES):
            some = lines[k:k + LEARN_PIECES]
            ids = np.array(self.tok.encode_batch_fast(["\n".join(["", *some, ""])], add_special_tokens=False)[0].ids, np.uint32)
            edge = np.flatnonzero(ids == line_break)
            if len(edge) != len(some) + 1:
                raise ValueError("a line break is not a token of its own")
            found += [ids[a:b] for a, b in zip((edge[:-1] + 1).tolist(), edge[1:].tolist(), strict=True)]
        learned = iter(found)
        return [self.direct(p) if p in (" ", "\n") else next(learned) for p in fresh]

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.main.find(keys)
        miss = np.flatnonzero(at < 0)
        more = self.young.find(keys[miss])
        at[miss] = np.where(more < 0, -1, more + self.old)
        return at

    def add(self, keys: np.ndarray, ids: list[np.ndarray]) -> None:
        self.keys = np.concatenate([self.keys, keys])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(x) for x in ids])])
        self.ids = np.concatenate([self.ids, *ids])
        if len(self.keys) > 1.3 * self.old + 10_000:
            self.main, self.old = HashIndex(self.keys), len(self.keys)
        self.young = HashIndex(self.keys[self.old:])

    def encode_chunk(self, c: Chunk) -> list[np.ndarray]:
        """Ids of every text of a chunk."""
        rows = len(c.offsets) - 1
        texts: dict[int, str] = {}

        def text(row: int) -> str:
            return c.data[c.offsets[row]:c.offsets[row + 1]].tobytes().decode()

        odd = _odd_rows(c) if self.cut else np.ones(rows, bool)
        for a in self.added if self.cut else ():
            joined = c.data.tobytes()
            pos = joined.find(a.encode())
            while pos >= 0:
                odd[np.searchsorted(c.offsets, pos, side="right") - 1] = True
                pos = joined.find(a.encode(), pos + 1)
        for row in np.flatnonzero(odd).tolist():
            texts[row] = text(row)
        if len(self.keys) > CACHE_PIECES:
            self.reset()
        size = np.diff(c.offsets)
        cut = (c.data == 32) | (c.data == 10)
        cut[1:] |= (c.data[:-1] == 10) | (_LETTER[c.data[:-1]] & _PUNCTUATION[c.data[1:]])
        cut[c.offsets[:-1][size > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(c.data))
        row = np.searchsorted(c.offsets, start, side="right") - 1
        usual = ~odd[row]
        start, end, row = start[usual], end[usual], row[usual]
        h = span_hashes(c.data, start, end, lower=False)
        at = self.find(h)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            keys, first = np.unique(h[miss], return_index=True)
            pick = miss[first]
            raw = c.data.tobytes()
            self.add(keys, self.learn([raw[x:y].decode() for x, y in zip(start[pick].tolist(), end[pick].tolist(), strict=True)]))
            at[miss] = self.find(h[miss])
        n = self.first[at + 1] - self.first[at]
        edge = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.first[at] - edge[:-1], n) + np.arange(edge[-1])]
        of_row = edge[np.searchsorted(row, np.arange(rows + 1))]
        out = [ids[x:y] for x, y in zip(of_row[:-1].tolist(), of_row[1:].tolist(), strict=True)]
        if texts:
            whole = {r: t for r, t in texts.items() if not self.cut or any(a in t for a in self.added)}
            for r, e in zip(whole, self.tok.encode_batch_fast(list(whole.values()), add_special_tokens=False), strict=True):
                out[r] = np.array(e.ids, np.uint32)
            parts = {r: self.spaced.findall(t) for r, t in texts.items() if r not in whole}
            fresh = list(set().union(*parts.values()))
            known = {p: self.direct(p) for p in fresh}
            for r, p in parts.items():
                out[r] = np.concatenate([known[x] for x in p]) if p else np.zeros(0, np.uint32)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [x for c in chunks(pa.array(texts, pa.string()), ENCODE_CHUNK) for x in self.encode_chunk(c)]


def _odd_rows(c: Chunk) -> np.ndarray:
    """Texts that can't be cut before every space and around every line break:
    with a white space run of three or one at the end, or with any other white space."""
    d = c.data
    odd = np.zeros(len(c.offsets) - 1, bool)
    if not len(d):
        return odd
    white = (d == 32) | (d == 10)
    bad = ((d >= 9) & (d <= 13) & (d != 10))
    bad[2:] |= white[2:] & white[1:-1] & white[:-2]
    nxt, third = np.append(d[1:], 0), np.append(d[2:], [0, 0])[:len(d)]
    bad |= (d == 0xC2) & ((nxt == 0x85) | (nxt == 0xA0))
    bad |= (d == 0xE1) & (nxt == 0x9A) & (third == 0x80)
    bad |= (d == 0xE2) & (nxt == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
    bad |= (d == 0xE2) & (nxt == 0x81) & (third == 0x9F)
    bad |= (d == 0xE3) & (nxt == 0x80) & (third == 0x80)
    size = np.diff(c.offsets)
    full = np.flatnonzero(size)
    odd[full] = white[c.offsets[1:][full] - 1]
    odd[np.searchsorted(c.offsets, np.flatnonzero(bad), side="right") - 1] = True
    return odd


def _file_system(uri: str):
    """The file system of a folder's URI and the path in it."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        fs, root = _file_system(folder)
        kept = worker_cache()
        if kept.get("encoder_of") != tokenizer:
            kept["encoder_of"], kept["encoder"] = tokenizer, Encoder(tokenizer)
        encoder: Encoder = kept["encoder"]
        task = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[int] = []
        held, seq = 0, 0

        def flush() -> pa.RecordBatch:
            path = f"{root}/shard-{task:06d}-{seq:06d}-{uuid.uuid4().hex}.tlb"
            first = np.concatenate([[0], np.cumsum(sizes)])
            with fs.open_output_stream(path) as f:
                f.write(shard_bytes(np.concatenate(parts), docs, first))
            return pa.RecordBatch.from_pydict({"task": [task], "seq": [seq], "path": [path.rsplit("/", 1)[1]],
                                               "docs": [len(docs)], "tokens": [held]}, schema=_MANIFEST)

        fs.create_dir(root, recursive=True)
        for batch in batches:
            for c in chunks(batch.column(1), ENCODE_CHUNK):
                found = encoder.encode_chunk(c)
                for doc, ids in zip(batch.column(0).slice(c.rows.start, len(found)).to_pylist(), found, strict=True):
                    docs.append(doc)
                    parts += (ids, end)
                    sizes.append(len(ids) + 1)
                    held += len(ids) + 1
                    if held >= SHARD_TOKENS:
                        yield flush()
                        docs, parts, sizes, held, seq = [], [], [], 0, seq + 1
        if docs:
            yield flush()
    return run


_MANIFEST = pa.schema([("task", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Writes the shards of ``docs`` below ``folder`` and their manifest; returns the manifest:
    ``(task, seq, path, docs, tokens, start)`` with ``start`` the number of ids before a shard."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranged = texts.repartitionByRange("id").sortWithinPartitions("id")
    manifest = ranged.mapInArrow(_write(f"{folder}/shards", tokenizer, end_id), "task long, seq long, path string, docs long, tokens long")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    shards = spark.read.parquet(f"{folder}/manifest")
    # offsets of tasks (one row each), then of a task's shards
    tasks = shards.groupBy(F.col("task").alias("__task")).agg(F.sum("tokens").alias("__tokens"))
    earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("__task", F.coalesce(F.sum("__tokens").over(earlier), F.lit(0)).alias("__start"))
    before = Window.partitionBy("task").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("__in", F.coalesce(F.sum("tokens").over(before), F.lit(0))).join(tasks, F.col("task") == F.col("__task"))
    return placed.select(*shards.columns, (F.col("__start") + F.col("__in")).alias("start"))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with fs.open_input_stream(f"{root}/{path}") as f:
                    x, tokens = read_shard(f.read())
                ids = unpack_blocks(x, 0, len(x["base"]))[:tokens].astype("<u4")
                first = x["first"].astype(np.int64)
                for a in range(0, len(first) - 1, 1024):
                    edge = first[a:a + 1025]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x["doc"][a:a + 1024], mask=x["has_doc"][a:a + 1024] == 0), pa.array(start + edge[:-1]),
                         pa.array(np.diff(edge)),
                         pa.array([ids[b:c].tobytes() for b, c in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)], pa.binary())],
                        names=["id", "start", "n_tokens", "ids"])
    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document in the shards; ``ids`` are little-endian uint32."""
    n = manifest.count()
    tasks = min(n, max(16 * manifest.sparkSession.sparkContext.defaultParallelism, n // SHARDS_PER_READ))
    shards = manifest.select("path", "start").repartition(max(1, tasks))
    return shards.mapInArrow(_read(f"{folder}/shards"), "id long, start long, n_tokens long, ids binary")


def token_digest(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``docs`` as shards, reads them back: ``(id_col, start, n_tokens, ids_crc32)``."""
    scratch = Scratch(docs.sparkSession, "token-blocks")
    manifest = scratch.table(write_tokens(docs, f"{scratch.root}/files", tokenizer, end_id, id_col, text_col), "placed")
    return read_tokens(manifest, f"{scratch.root}/files").select(
        F.col("id").alias(id_col), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
