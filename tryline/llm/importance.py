"""Importance resampling of documents towards a target distribution (operator 13).

Features are all runs of one to ``size`` consecutive words, hashed by the
CRC-32 of their bytes into ``buckets``. The running CRCs of a document are
stored once, and every run's CRC is derived from two of them
(``prefix_crc``). A bucket's gain is the logarithm of its smoothed share in
the target texts over its share in all documents; a document's weight is the
floored mean gain of its features, and Gumbel noise seeded by its id makes a
draw without replacement of the highest scores.

Spark side: one scan writes each document's bucket numbers (two bytes each)
beside its key, so texts are read once. Corpus counts are partial sums per
task over that table, joined into one row per bucket: the driver holds
``buckets`` counters, whatever the corpus. Ranks come from a global range sort
of the narrow scores and per-range counts; no task sees all documents.

Defined cases: a null text has no words; documents without features have
weight 0; a null id draws its noise from ``<seed>:null`` and loses ties to all
others; equal rows are ranked one after another. With no target or no
documents the smoothed shares still stand. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tryline.llm.common import Scratch
from tryline.llm.prefix_crc import CrcShift, WordCrcs

SIZE, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
#: Bytes of bucket numbers put into one Arrow batch.
BATCH_BYTES = 8 << 20
_MILLI = 1000

#: A-Z in lower case, ASCII letters, digits and all bytes of other characters as they are, the rest a space.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def feature_buckets(text: str, tables: CrcShift, size: int = SIZE, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``size`` words."""
    crcs = WordCrcs(words(text), tables)
    runs = [crcs.ngrams(k) for k in range(1, size + 1)]
    return crcs.n, np.concatenate(runs) % np.uint32(buckets)


def _featurise(size: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(doc_id, text)`` to ``(doc_id, n_words, features)``; features are bucket numbers as packed integers."""
    packed = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = CrcShift()
        ids, counts, features, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(features, pa.binary())],
                                             names=["doc_id", "n_words", "features"])
            for column in (ids, counts, features):
                column.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                n, found = feature_buckets(text.as_py() or "", tables, size, buckets)
                ids.append(doc_id.as_py())
                counts.append(n)
                features.append(found.astype(packed).tobytes())
                held += len(features[-1]) + 32
                if held > BATCH_BYTES:
                    yield flush()
                    held = 0
        yield flush()

    return run


def _unpack(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a batch one after another, and how many each row has."""
    packed = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    rows = [v.as_buffer() for v in column]
    lengths = np.fromiter((len(r) // packed.itemsize if r else 0 for r in rows), np.int64, len(rows))
    return np.frombuffer(b"".join(rows), packed), lengths


def _count(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_unpack(batch.column(0), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket; ``buckets`` counters reach the driver."""
    per_task = features.select("features").mapInArrow(_count(buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Per bucket the floored thousandfold log ratio of smoothed shares, target over source."""
    t, s = target.astype(np.float64), source.astype(np.float64)
    all_t, all_s, b = float(target.sum()), float(source.sum()), float(len(target))
    ratio = (t + 1.0) * (all_s + b) / ((s + 1.0) * (all_t + b))
    return np.array([math.floor(_MILLI * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a row key, in thousandths, floored."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-_MILLI * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(gain: np.ndarray, buckets: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lengths = _unpack(batch.column("features"), buckets)
            sums = np.append(0, np.cumsum(gain[found]))
            ends = np.cumsum(lengths)
            weight = (sums[ends] - sums[ends - lengths]) // np.maximum(lengths, 1)
            jitter = np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(lengths), pa.array(weight), pa.array(weight + jitter)],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def ranked(scores: DataFrame, scratch: Scratch) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3... by descending score, then ascending id (null last).

    The range sort deals rows out; its parts are written with their number, so
    a part's rank offset is the count of the parts before it (one row each).
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = scratch.table(scores.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged")
    sizes = parts.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("__part").alias("__p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (parts.withColumn("__inside", inside).join(offsets, F.col("__part") == F.col("__p"))
            .withColumn("rank", (F.col("__inside") + F.col("__before")).cast("long")).drop("__part", "__p", "__inside", "__before"))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                        buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Per document ``id_col, n_words, n_features, weight, score, rank``; rank is null unless drawn.

    ``percent`` of a hundred of the documents with ``least_words`` words or
    more are drawn. ``target`` needs ``text_col`` only.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    shape = "doc_id long, n_words long, features binary"
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    features = scratch.table(named.mapInArrow(_featurise(size, buckets), shape), "features")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_featurise(size, buckets), shape)
    gain = gains(bucket_counts(wanted, buckets), bucket_counts(features, buckets))
    scores = scratch.table(features.mapInArrow(_weigh(gain, buckets, seed),
                                               "doc_id long, n_words long, n_features long, weight long, score long"), "scores")
    scratch.drop("features")
    able = scores.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = ranked(able, scratch).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scores.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return order.unionByName(rest).withColumnRenamed("doc_id", id_col)
