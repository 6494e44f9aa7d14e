"""Language identification by averaged hashed subword embeddings (operator 7).

A text's features are the hashed byte n-grams of its words (ASCII letters
lower-cased, all other ASCII characters word boundaries). Their embeddings are
averaged and a linear softmax gives the language. Embeddings and weights are
learned together by stochastic gradient descent in numpy, on a bounded sample
of labelled rows, whatever the number of languages: about ``SAMPLE_ROWS`` per
language of at most ``SAMPLE_CHARS`` characters each, chosen by a hash of the
id, and fewer where they have more than the language's equal share of
``TOTAL_CHARS``; of a language that has only longer texts, the ``LONG_ROWS``
shortest within its share, one at least. A part of the sample is kept for calibration: a temperature is
fitted to it, and the least score whose acceptances reach ``PRECISION``
becomes the rejection threshold.

Prediction covers every n-gram of every text. Since the average and the
linear layer commute, tasks add up rows of the table embeddings x weights.

Defined cases: a text that is null or has no letter is ``und`` with score 0
and not accepted; so is everything if no labelled row exists. Equal texts get
equal predictions. Ties go to the language that sorts first. Rows with null
id or language are never learned from. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tryline.llm.textops import Chunk, chunks

SAMPLE_ROWS = 600
SAMPLE_CHARS = 20_000
LONG_ROWS = 100
TOTAL_CHARS = 100_000_000
ORDERS = (1, 2, 3, 4)
BITS = 15
DIM = 16
EPOCHS = 6
BATCH = 16
RATE = 2.0
PRECISION = 0.99
UNKNOWN = "und"

_NORMAL = np.full(256, 32, np.uint8)
_NORMAL[128:] = np.arange(128, 256)
for _b in range(26):
    _NORMAL[97 + _b] = _NORMAL[65 + _b] = 97 + _b


def features(c: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order of n-grams: positions (bytes of the chunk) and their buckets; n-grams inside one text that hold a letter."""
    x = _NORMAL[c.data].astype(np.uint32)
    n = len(x)
    end = np.repeat(c.offsets[1:], np.diff(c.offsets))
    for size in ORDERS:
        m = n - size + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint32)
        blank = np.ones(m, bool)
        for k in range(size):
            code |= x[k:k + m] << np.uint32(8 * k)
            blank &= x[k:k + m] == 32
        at = np.flatnonzero(~blank & (np.arange(m) + size <= end[:m]))
        h = (code[at] ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0xC2B2AE35)
        yield at, (h >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray       # buckets x languages: embeddings times weights
    bias: np.ndarray
    temperature: float
    threshold: float


def _histograms(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its buckets and their shares."""
    out = []
    for c in chunks(texts):
        rows = len(c.offsets) - 1
        row_of = np.repeat(np.arange(rows), np.diff(c.offsets))
        keys = np.concatenate([np.zeros(0, np.int64), *(row_of[at] << BITS | b for at, b in features(c))])
        u, n = np.unique(keys, return_counts=True)
        first = np.searchsorted(u, np.arange(rows + 1) << BITS)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            out.append((u[a:b] & ((1 << BITS) - 1), n[a:b] / max(1, n[a:b].sum())))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: pa.Array, labels: list[str], seed: int = 7) -> Model:
    """Trains on four fifths of the rows (all, if fewer than 20) and calibrates on the rest."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    docs = _histograms(texts)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(docs))
    held = order[:len(order) // 5] if len(order) >= 20 else order
    train = order[len(order) // 5:] if len(order) >= 20 else order
    emb = rng.normal(0, 0.1, (1 << BITS, DIM))
    w = rng.normal(0, 0.1, (DIM, len(languages)))
    bias = np.zeros(len(languages))
    steps, step = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for a in range(0, len(train), BATCH):
            pick = train[a:a + BATCH]
            size = np.array([len(docs[i][0]) for i in pick])
            idx = np.concatenate([docs[i][0] for i in pick])
            share = np.concatenate([docs[i][1] for i in pick])
            row = np.repeat(np.arange(len(pick)), size)
            mean = np.stack([np.bincount(row, share * emb[idx, d], len(pick)) for d in range(DIM)], axis=1)
            grad = _softmax(mean @ w + bias)
            grad[np.arange(len(pick)), y[pick]] -= 1.0
            rate = RATE * (1.0 - step / steps)
            back = grad @ w.T
            w -= rate / len(pick) * (mean.T @ grad)
            bias -= rate / len(pick) * grad.sum(0)
            # a feature's own step is scaled up: its share of a text is small
            move = share * 50.0
            for d in range(DIM):
                emb[:, d] -= rate / len(pick) * np.bincount(idx, move * back[row, d], 1 << BITS)
            step += 1
    model = Model(languages, emb @ w, bias, 1.0, 0.0)
    logits = np.stack([(share[:, None] * model.table[idx]).sum(0) + bias for idx, share in (docs[i] for i in held)])
    grid = np.exp(np.linspace(-3, 3, 61))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), y[held]], 1e-300)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / model.temperature)
    score, right = p.max(1), p.argmax(1) == y[held]
    down = np.argsort(-score, kind="stable")
    precise = np.flatnonzero(np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= PRECISION)
    model.threshold = float(score[down[precise[-1]]]) if len(precise) else 1.0
    return model


def _has_letter(c: Chunk) -> np.ndarray:
    rows = len(c.offsets) - 1
    letter = np.zeros(len(c.data) + 1, np.int64)
    np.cumsum((_NORMAL[c.data] != 32) & (c.data < 128), out=letter[1:])
    out = letter[c.offsets[1:]] > letter[c.offsets[:-1]]
    for i in np.flatnonzero(~out).tolist() if rows else []:
        out[i] = any(ch.isalpha() for ch in c.data[c.offsets[i]:c.offsets[i + 1]].tobytes().decode())
    return out


def predict_chunk(c: Chunk, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per text the language's number (-1: unknown) and the calibrated score."""
    rows = len(c.offsets) - 1
    if not model.languages:
        return np.full(rows, -1), np.zeros(rows)
    total = np.zeros((rows, len(model.languages)))
    count = np.zeros(rows)
    table = model.table.astype(np.float32)
    for at, bucket in features(c):
        first = np.searchsorted(at, c.offsets)
        size = np.diff(first)
        full = np.flatnonzero(size)
        if len(full):
            total[full] += np.add.reduceat(table[bucket], first[full], axis=0, dtype=np.float64)
        count += size
    p = _softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
    known = _has_letter(c)
    return np.where(known, p.argmax(1), -1), np.where(known, p.max(1), 0.0)


def _predict(model: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for c in chunks(batch.column("__text"), 1 << 20):
                part = batch.slice(c.rows.start, len(c.offsets) - 1)
                best, score = predict_chunk(c, model)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in names), pa.array(languages[best].tolist(), pa.string()), pa.array(score),
                     pa.array((best >= 0) & (score >= model.threshold))], names=[*names, "lang_pred", "score", "accepted"])
    return run


def train(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits a model on a bounded, hashed sample of the labelled rows that ``may_learn``."""
    rows = docs.where(may_learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 40)).alias("h"))
    rows = rows.where(F.length("text") > 0).withColumn("size", F.length("text"))
    short = F.col("size") <= SAMPLE_CHARS
    per = rows.groupBy("lang").agg(F.count_if(short).alias("n"), F.sum(F.when(short, F.col("size"))).alias("chars")).orderBy("lang").collect()
    if not per:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 1.0)
    share = TOTAL_CHARS // len(per)
    below = [(r["lang"], int((1 << 40) * min(1.0, sample_rows / r["n"], share / r["chars"]))) for r in per if r["n"]]
    long = [(r["lang"],) for r in per if not r["n"]]
    spark = docs.sparkSession
    limits = spark.createDataFrame(below, "lang string, below long")
    picked = rows.where(short).join(limits, "lang").where(F.col("h") < F.col("below")).select("text", "lang", "h")
    if long:
        order = Window.partitionBy("lang").orderBy("size", "h", "text")
        few = (rows.join(spark.createDataFrame(long, "lang string"), "lang", "left_semi")
               .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= min(LONG_ROWS, sample_rows)))
        upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        shortest = few.withColumn("upto", upto).where((F.col("nth") == 1) | (F.col("upto") <= share))
        picked = picked.unionByName(shortest.select("text", "lang", "h"))
    sample = picked.orderBy("h", "lang", "text").toArrow()
    return fit(sample["text"].combine_chunks(), sample["lang"].to_pylist())


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` and ``accepted`` for every row."""
    inner = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return inner.mapInArrow(_predict(model, keep), ", ".join([*schema, "lang_pred string", "score double", "accepted boolean"]))
