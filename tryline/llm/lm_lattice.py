"""Language-model scoring by the marginal likelihood of subword lattices (operator 2).

The vocabulary is an existing SentencePiece one; its pieces' unigram
probabilities are learned from the training documents by expectation
maximisation over all segmentations of the distinct training words (each once: what
the pieces have to spell are words not seen before). A word's
probability is the sum over all paths through its lattice, by a forward
recursion in log space. Training words are vocabulary entries too: an arc
over the whole word has its relative frequency less a discount (Ney's
estimate from the words seen once and twice), and the paths of pieces share
the discounted mass. A document's score is the sum over its words and its
end.

Scale: words are counted by a grouped sum. The most frequent words, at most
``HEAD_WORDS`` (a proven bound, 24 bytes each), are broadcast; all others meet
their counts through a shuffled join, so no size of vocabulary has to fit
anywhere. Words are compared by 64-bit hashes and counted with their text.

Defined cases: null and empty texts have one token, the end. A null id is
neither held out nor learned from. Equal rows are learned from and scored
each. Without training tokens every probability comes from the vocabulary's
initial weights, and the base score is that of an empty count table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.llm.common import Scratch, doc_bucket
from tryline.llm.lattice import HashIndex, Pieces, expected_counts, marginals
from tryline.llm.textops import _LOWER, U64, chunks, distinct, span_hashes, splitmix, words

HEAD_WORDS = 500_000
EM_ROUNDS = 2
PIECE_SMOOTHING = 0.1
BASE_SMOOTHING = 0.1
LN10 = float(np.log(10))
#: Hash of the end token; its word is the empty string, which no text has.
END_HASH = 0x1E4D
COUNT_CHUNK = 4 << 20
SCORE_BATCH = 20_000


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte spans as an Arrow binary column."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    joined = data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(joined)]) \
        .cast(pa.binary())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = batch.num_rows
        for c in chunks(batch.column(0), COUNT_CHUNK):
            w = words(c)
            h = span_hashes(c.data, w.start, w.end, lower=True)
            at, _, n = distinct(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[at].view(np.int64)), _gather(_LOWER[c.data], w.start[at], w.end[at]), pa.array(n.astype(np.int64))],
                names=["h", "word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([END_HASH], pa.int64()), pa.array([b""], pa.binary()), pa.array([ends], pa.int64())],
                                         names=["h", "word", "n"])


def _units(words_: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as lattice units, each behind a space: bytes, starts, ends."""
    words_ = words_.cast(pa.large_binary())
    _, off, buf = words_.buffers()
    off = np.frombuffer(off, np.int64)[words_.offset:words_.offset + len(words_) + 1]
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None and buf.size else np.zeros(0, np.uint8)
    off = off - off[0]
    data = np.insert(data, off[:-1], 32)
    off = off + np.arange(len(off))
    return data, off[:-1], off[1:]


def _expect(model: str, logp: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        total = np.zeros(pieces.size)
        for batch in batches:
            for a in range(0, batch.num_rows, SCORE_BATCH):
                part = batch.slice(a, SCORE_BATCH)
                total += expected_counts(*_units(part.column("word")), np.ones(part.num_rows), pieces, logp)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["piece", "n"])
    return run


def learn_pieces(vocab: DataFrame, model: str, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Log probabilities of the vocabulary's pieces, learned from distinct words; the table's size is the vocabulary's."""
    pieces = Pieces(model)
    # before any counting: by rank, as the vocabulary's own scores order them
    rank = np.empty(pieces.size)
    rank[np.argsort(-pieces.score, kind="stable")] = np.arange(pieces.size)
    count = 1.0 / (rank + 10.0)
    count /= count[pieces.usable].sum()
    smoothing = 0.0
    for step in range(rounds + 1):
        p = np.where(pieces.usable, count + smoothing, 0.0)
        with np.errstate(divide="ignore"):
            logp = np.log(p / p.sum())
        if step == rounds:
            break
        rows = (vocab.where("h <> %d" % END_HASH).select("word").mapInArrow(_expect(model, logp), "piece long, n double")
                .groupBy("piece").agg(F.sum("n").alias("n")).toArrow())
        count, smoothing = np.zeros(pieces.size), PIECE_SMOOTHING
        count[rows["piece"].to_numpy()] = rows["n"].to_numpy()
    return logp


def _add_marginals(model: str, logp: np.ndarray, only_new: bool, names: list[str]):
    """Adds ``lattice``, the log10 marginal of each word (``only_new``: where ``n`` is null, else kept)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            for a in range(0, batch.num_rows, SCORE_BATCH):
                part = batch.slice(a, SCORE_BATCH)
                old = part.column("lattice").to_numpy(zero_copy_only=False).copy() if only_new else np.zeros(part.num_rows)
                todo = np.flatnonzero(part.column("n").is_null().to_numpy(zero_copy_only=False)) if only_new \
                    else np.arange(part.num_rows)
                distinct = part.column("word").take(pa.array(todo)).dictionary_encode()
                value = marginals(*_units(distinct.dictionary), pieces, logp) / LN10
                old[todo] = value[distinct.indices.to_numpy()] if len(todo) else 0.0
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), pa.array(old)], names=[*names, "lattice"])
    return run


def _score_documents(head):
    """Per document the sums over head words and the list of all others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, base, score = head.value
        index = HashIndex(keys)
        for batch in batches:
            for c in chunks(batch.column("text")):
                rows = len(c.offsets) - 1
                w = words(c)
                h = span_hashes(c.data, w.start, w.end, lower=True)
                at = index.find(h)
                known = at >= 0
                r, a = w.row[known], at[known]
                other = np.flatnonzero(~known)
                first, _, n = distinct(h[other] ^ splitmix(w.row[other].astype(U64)))
                order = np.argsort(w.row[other[first]], kind="stable")
                pick, n = other[first[order]], n[order]
                tail = pa.StructArray.from_arrays(
                    [pa.array(h[pick].view(np.int64)), _gather(_LOWER[c.data], w.start[pick], w.end[pick]), pa.array(n.astype(np.int64))],
                    names=["h", "word", "k"])
                off = np.searchsorted(w.row[pick], np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(x).slice(c.rows.start, rows) for x in ("uid", "id", "held_out")]
                    + [pa.array(np.diff(w.first).astype(np.int64)), pa.array(np.bincount(r, minlength=rows).astype(np.int64)),
                       pa.array(np.bincount(r, base[a], rows).astype(float)), pa.array(np.bincount(r, score[a], rows).astype(float)),
                       pa.ListArray.from_arrays(pa.array(off), tail)],
                    names=["uid", "id", "held_out", "n_words", "n_known", "base", "score", "tail"])
    return run


def score_documents(docs: DataFrame, model: str, holdout: int = 10, id_col: str = "doc_id", text_col: str = "text",
                    head_words: int = HEAD_WORDS) -> DataFrame:
    """``(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)``; log10 probabilities.

    Documents whose crc32 bucket modulo ``holdout`` is 0 are held out of
    learning.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "lm-lattice")
    rest = doc_bucket(F.col(id_col), holdout)
    named = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                        F.coalesce(rest == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    counted = docs.where(rest != 0).select(F.col(text_col)).mapInArrow(_count_words, "h long, word binary, n long")
    vocab = scratch.table(counted.groupBy("h", "word").agg(F.sum("n").alias("n")), "words")
    total, types, once, twice = vocab.agg(F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") == 1),
                                          F.count_if(F.col("n") == 2)).first()
    total = total or 0
    room = total + BASE_SMOOTHING * (types + 1)
    discount = (once + 1.0) / (once + 2.0 * twice + 2.0)
    new_mass = discount * types / total if total else 0.5
    logp = learn_pieces(vocab, model)
    scored = scratch.table(vocab.mapInArrow(_add_marginals(model, logp, False, ["h", "word", "n"]),
                                            "h long, word binary, n long, lattice double").select("h", "n", "lattice"), "scored")

    def base_of(n):
        return np.log10((n + BASE_SMOOTHING) / room)

    def score_of(n, lattice):
        return np.log10((n - discount) / total + new_mass * 10.0 ** lattice)

    least = _least_count(scored, head_words)
    head = scored.where((F.col("n") >= least) & (F.col("h") != END_HASH)).toArrow()
    n, lat = head["n"].to_numpy().astype(float), head["lattice"].to_numpy()
    shared = spark.sparkContext.broadcast((head["h"].to_numpy().view(U64).copy(), base_of(n), score_of(n, lat)))
    n_end = scored.where(F.col("h") == END_HASH).agg(F.sum("n")).first()[0] or 0
    end_base = float(base_of(n_end))
    end_score = float(np.log10((n_end - discount) / total if n_end else 0.5))

    first = scratch.table(named.mapInArrow(
        _score_documents(shared),
        "uid long, id long, held_out boolean, n_words long, n_known long, base double, score double, "
        "tail array<struct<h:long,word:binary,k:long>>"), "documents")
    tail = first.select("uid", F.explode("tail").alias("t")).select("uid", "t.*")
    rare = scored.where((F.col("n") < least) & (F.col("h") != END_HASH))
    met = tail.join(rare, "h", "left").mapInArrow(_add_marginals(model, logp, True, ["uid", "k", "n"]),
                                                  "uid long, k long, n long, lattice double")
    seen = F.log10((F.coalesce("n", F.lit(0)) + BASE_SMOOTHING) / room)
    # deep in the tail of the pieces 10^x is 0 in floating point, its logarithm is not
    new = F.col("lattice") + float(np.log10(new_mass))
    known = F.log10((F.col("n") - discount) / max(total, 1) + F.pow(F.lit(10.0), new))
    per = met.groupBy("uid").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("t_known"),
        F.sum(F.col("k") * seen).alias("t_base"),
        F.sum(F.col("k") * F.coalesce(known, new)).alias("t_score"))
    zero = F.lit(0.0)
    return first.drop("tail").join(per, "uid", "left").select(
        F.col("id").alias(id_col), "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + F.coalesce("t_known", F.lit(0)) + (1 if n_end else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("t_base", zero) + end_base).alias("base_score"),
        (F.col("score") + F.coalesce("t_score", zero) + end_score).alias("score"))


def _least_count(scored: DataFrame, head_words: int) -> int:
    """Smallest count such that at most ``head_words`` words have it or more."""
    # counts in eighths of powers of two: a few hundred classes at most
    cls = F.floor(F.log2("n") * 8)
    rows = scored.groupBy(cls.alias("c")).agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).orderBy(F.desc("c")).collect()
    least, words_ = (rows[0]["least"] + 1 if rows else 1), 0
    for r in rows:
        words_ += r["m"]
        if words_ > head_words:
            return least
        least = r["least"]
    return 1
