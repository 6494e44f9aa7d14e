"""Exact top-k inner products with a bit-sliced index (operator 10).

Vectors are quantised to integers ``floor(scale * x)``. An index block holds
up to about ``BLOCK_ROWS`` vectors as bit slices: for every component the
value minus the block's minimum, one bitmap over the rows per binary digit.
A query's scores of all rows of a block are the sum of its weights times the
component slices, formed by carry-save adders on whole bitmaps: for a set bit
``c`` of ``|q_d|`` the slice ``b`` of component ``d`` enters the sum at digit
``b + c`` (complemented if ``q_d`` is negative, with the constant adjusted).
The top rows are then selected from the most significant score slice downward
with population counts; rows left undecided at the end have exactly equal
scores and are resolved by smaller id. Per block and query at most ``k`` rows
leave a task; a window over a query's block winners gives the final ranks.

The queries are a stated set. Blocks of queries meet blocks of rows through a
join on the query block's number, so a task holds one of each.

Defined cases: vectors that are null or hold null or non-finite components
take no part, neither as rows nor as queries; vectors of different lengths
are compared on their common components; ties go to the smaller id; a query
has as many results as there are other rows, ``k`` at most. Rows of equal id
are candidates each, and a query excludes every row of its own id; equal
query rows are answered once. Rows with null id take no part. Nothing
is cut or wrapped: components beyond 2^62 in magnitude, and blocks whose
scores could pass 2^62, raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tryline.llm.common import Scratch

BLOCK_ROWS = 16_384
BLOCK_QUERIES = 128
#: Magnitudes of components and scores stay below this, so that no sum wraps.
LIMIT = float(1 << 62)


def quantise(vec: Column, scale: int) -> Column:
    """``array<long>`` of floor(scale * x); null unless all components are finite numbers."""
    good = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    too_large = F.exists(vec, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) >= LIMIT)
    return F.when(good, F.when(too_large, F.raise_error(F.lit("a quantised component doesn't fit"))).otherwise(whole))


def _add(sums: list, level: int, carry: np.ndarray) -> None:
    """Adds a bitmap at a digit; ``sums[digit]`` keeps up to two bitmaps waiting for a third."""
    while True:
        while len(sums) <= level:
            sums.append([])
        slot = sums[level]
        if len(slot) < 2:
            slot.append(carry)
            return
        a, b = slot
        part = a ^ b
        slot[:] = [part ^ carry]
        carry = (a & b) | (part & carry)
        level += 1


class Block:
    """The bit-sliced index of some rows, in ascending id order."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        rows, dims = values.shape
        self.words = (rows + 63) // 64
        above = self.values - self.values.min(0)
        self.slices = [[self.pack((above[:, d] >> b) & 1 == 1) for b in range(int(above[:, d].max()).bit_length())]
                       for d in range(dims)]
        self.all = self.pack(np.ones(rows, dtype=bool))

    def pack(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 8, dtype=np.uint8)
        bits = np.packbits(flags, bitorder="little")
        out[:len(bits)] = bits
        return out.view(np.uint64)

    def unpack(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=len(self.ids), bitorder="little"))

    def scores(self, q: np.ndarray) -> list[np.ndarray]:
        """Score slices from the least significant digit, up to an additive constant for all rows."""
        sums: list = []
        for d in range(min(len(q), len(self.slices))):
            w = int(q[d])
            if not w:
                continue
            digits = [c for c in range(abs(w).bit_length()) if abs(w) >> c & 1]
            for b, bits in enumerate(self.slices[d]):
                bits = bits if w > 0 else self.all ^ bits
                for c in digits:
                    _add(sums, b + c, bits)
        out = []
        level = 0
        while level < len(sums):
            slot = sums[level]
            if len(slot) == 2:
                a, b = slot
                slot[:] = []
                _add(sums, level + 1, a & b)
                slot.append(a ^ b)
            out.append(slot[0] if slot else np.zeros(self.words, np.uint64))
            level += 1
        return out

    def top(self, q: np.ndarray, k: int, exclude: int) -> np.ndarray:
        """Rows of the k highest scores, ties to the smaller id, without rows whose id is ``exclude``."""
        a, b = np.searchsorted(self.ids, [exclude, exclude + 1])
        maybe = self.all
        if b > a:
            flags = np.ones(len(self.ids), dtype=bool)
            flags[a:b] = False
            maybe = self.pack(flags)
        sure = np.zeros(self.words, np.uint64)
        n_sure = 0
        for s in reversed(self.scores(q)):
            ones = maybe & s
            n = int(np.bitwise_count(ones).sum())
            if n_sure + n > k:
                maybe = ones
            else:
                sure, n_sure, maybe = sure | ones, n_sure + n, maybe & ~s
                if n_sure == k:
                    return self.unpack(sure)
        # the undecided rows all have one score; they stand in id order
        return np.concatenate([self.unpack(sure), self.unpack(maybe)[:k - n_sure]])


def _matrix(vectors: list) -> np.ndarray:
    """Integer rows, shorter vectors filled up with zeros (which add nothing to a product)."""
    values = np.zeros((len(vectors), max(map(len, vectors), default=0)), dtype=np.int64)
    for i, v in enumerate(vectors):
        values[i, :len(v)] = v
    return values


def _pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
    values = _matrix(pdf["v"].tolist())
    width = np.int16 if values.size == 0 or np.abs(values).max() < 1 << 15 else np.int64
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "n": [len(pdf)], "dims": [values.shape[1]], "wide": [width is np.int64],
                         "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                         "vals": [values.astype(width).tobytes()]})


PACKED = "block long, n long, dims long, wide boolean, ids binary, vals binary"


def _unpack_block(r: dict, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(r[prefix + "vals"], np.int64 if r[prefix + "wide"] else np.int16).astype(np.int64)
    return np.frombuffer(r[prefix + "ids"], np.int64), values.reshape(r[prefix + "n"], r[prefix + "dims"])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(*_unpack_block(r, "r_"))
                ids, queries = _unpack_block(r, "q_")
                m = min(queries.shape[1], block.values.shape[1])
                # the largest sum any pair could reach, by magnitudes
                most = np.abs(queries[:, :m].astype(float)).max(0, initial=0.0) @ np.abs(block.values[:, :m].astype(float)).max(0, initial=0.0)
                if most >= LIMIT:
                    raise OverflowError("inner products of these vectors can exceed 64 bits; use a smaller scale")
                out: list[tuple] = []
                for at, (qid, q) in enumerate(zip(ids.tolist(), queries, strict=True)):
                    hit = block.top(q, k, qid)
                    m = min(len(q), block.values.shape[1])
                    score = block.values[hit, :m] @ q[:m]
                    out += zip([qid] * len(hit), [r["q_block"] << 32 | at] * len(hit), block.ids[hit].tolist(), score.tolist(), strict=True)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                     names=["query_id", "query", "vec_id", "score"])
    return run


def bsi_topk(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
             vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query row's ``k`` highest integer inner products among all other rows."""
    scratch = Scratch(rows.sparkSession, "bsi-topk")
    q = rows.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vec_col), scale).alias("v"), is_query.alias("q"),
                    F.monotonically_increasing_id().alias("uid")).where("id is not null and v is not null")
    q = scratch.table(q, "quantised")
    n_rows, n_queries = q.agg(F.count(F.lit(1)), F.count_if("q")).first()
    n_blocks, n_qblocks = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    # blocks are dealt by row, not by id: rows of one id don't meet in a block
    index = scratch.table(q.select("id", "v", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).alias("block"))
                          .groupBy("block").applyInPandas(_pack_block, PACKED), "index")
    asked = q.where("q").dropDuplicates(["id", "v"]).select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(n_qblocks)).alias("block"))
    asked = scratch.table(asked.groupBy("block").applyInPandas(_pack_block, PACKED), "queries")
    left = index.select(*[F.col(c).alias("r_" + c) for c in index.columns]).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(n_qblocks - 1))))
    right = asked.select(*[F.col(c).alias("q_" + c) for c in asked.columns])
    # one pair of blocks per row: deal the pairs out evenly
    pairs = left.join(right, F.col("qb") == F.col("q_block")).drop("qb").repartition(F.col("r_block"), F.col("q_block"))
    best = pairs.mapInArrow(_search(k), "query_id long, query long, vec_id long, score long")
    w = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH q AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
