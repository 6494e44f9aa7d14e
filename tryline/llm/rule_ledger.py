"""Quality rules as a bitmask ledger (operator 6).

Every rule is evaluated once per document. The ledger holds the measurements
and one bit per failed rule; a *policy* is a version name and a mask of the
rules it enforces. Verdicts, policy comparisons and ablations read the ledger
alone: a document is kept when ``fail_bits & mask = 0``, and a rule's own
effect is found from counts of distinct bit patterns, so no text is read
twice and a new policy costs a pass over integers.

Defined cases: null and empty texts measure zero everywhere and fail
``few_words``. Words are runs without ASCII white space; lines are split at
``\\n``; comparisons are exact (case matters). Repeated rows get equal ledger
rows. Other columns pass through untouched (clashing names are replaced by
the ledger's). Ratios are compared in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tryline.llm.textops import U64, Chunk, chunks, distinct, span_hashes, splitmix, window_hashes, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words",
            "longest_word")
SYMBOLS = "#*$%&|<>"

#: Rules by bit. A rule is true when the document FAILS it.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 16 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("few_letter_words", "100 * n_letter_words < 70 * n_words"),
    ("very_long", "n_words > 100000"),
    ("huge_word", "longest_word > 1000"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version and the rules it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = {p.version: p for p in (
    BASE,
    Policy("v1", (*BASE.rules, "many_symbols", "short_words", "long_words", "repeated_lines", "few_letter_words")),
    # the length limits are measured for every document but enforced by this version only
    Policy("strict", tuple(BIT)),
)}

#: Bytes of text measured at a time (a longer text is measured whole): what fits a core's cache.
CHUNK = 512 << 10

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 256)]] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def measure(c: Chunk) -> dict[str, np.ndarray]:
    """The measurements of every row of a chunk, by MEASURES."""
    rows = len(c.offsets) - 1
    w = words(c)
    n_words = np.diff(w.first)
    size = len(c.data)
    # characters = bytes that don't continue a UTF-8 sequence; those in words
    lead = np.zeros(size + 1, dtype=np.int64)
    np.cumsum((c.data & 0xC0) != 0x80, out=lead[1:])
    chars = lead[w.end] - lead[w.start]
    letters = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(_LETTER[c.data], out=letters[1:])
    longest = np.zeros(rows, dtype=np.int64)
    np.maximum.at(longest, w.row, chars)

    # lines with a word; equal lines of one row share a key
    breaks = np.flatnonzero(c.data == 10)
    start = np.union1d(c.offsets[:-1], breaks + 1)
    start = start[start < size]
    end = np.minimum(np.append(start[1:], size), size)
    end = end - ((end > start) & (c.data[np.maximum(end - 1, 0)] == 10)) if size else end
    has_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[has_word], end[has_word]
    line_row = np.searchsorted(c.offsets, start, side="right") - 1
    salt = splitmix(line_row.astype(U64))
    first, _, _ = distinct(span_hashes(c.data, start, end, lower=False) ^ salt)
    n_lines = np.bincount(line_row, minlength=rows)
    n_dup = n_lines - np.bincount(line_row[first], minlength=rows)

    # words in three-word windows that occur twice or more in their row
    h = window_hashes(span_hashes(c.data, w.start, w.end, lower=False), 3)
    whole = w.row[:len(h)] == w.row[2:] if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    _, number, count = distinct(h[at] ^ splitmix(w.row[at].astype(U64)))
    again = at[count[number] > 1] if len(at) else at
    covered = np.zeros(len(w.start), dtype=bool)
    for k in range(3):
        covered[again + k] = True
    has_letter = letters[w.end] > letters[w.start]
    return {"n_words": n_words, "word_chars": np.bincount(w.row, chars, rows).astype(np.int64),
            "n_symbols": _per_row(_SYMBOL[c.data], c.offsets), "n_lines": n_lines, "n_dup_lines": n_dup,
            "n_repeat_words": np.bincount(w.row[covered], minlength=rows),
            "n_letter_words": np.bincount(w.row[has_letter], minlength=rows), "longest_word": longest}


def _measure_batches(names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure(c) for c in chunks(batch.column(text), CHUNK)]
            new = [pa.array(np.concatenate([p[m] for p in parts]) if parts else np.zeros(0), pa.int64()) for m in MEASURES]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *new], names=[*names, *MEASURES])
    return run


def failed(mask: int) -> Column:
    """Whether a ledger row fails any rule of the mask."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) != 0


def ledger(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), the measurements and ``fail_bits``."""
    keep = [n for n in (docs.columns if keep is None else keep) if n not in (*MEASURES, "fail_bits")]
    # the text goes to the tasks once, also where it is kept
    text = text_col if text_col in keep else "__text"
    inner = docs.select(*keep, *([] if text in keep else [F.col(text_col).alias(text)]))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
                       + [f"{m} long" for m in MEASURES])
    out = inner.mapInArrow(_measure_batches(keep, text), schema)
    bits = " | ".join(f"if({rule}, {1 << k}L, 0L)" for k, (_, rule) in enumerate(RULES))
    return out.withColumn("fail_bits", F.expr(bits))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` (never kept when the base rules fail)."""
    return rows.withColumns({"base_failed": failed(BASE.mask), "kept": ~failed(policy.mask | BASE.mask)})


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents failing it, failing it alone, and kept if it were left out.

    The ledger is first counted by bit pattern (at most 2^rules groups); the
    rest is bitwise arithmetic on those counts.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]))
    p = patterns.withColumn("r", rules).select("fail_bits", "n", "r.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    others = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long").bitwiseXOR(F.col("bit")))
    return p.groupBy("rule", "bit").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit & (others == 0), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(others == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.bit_or(F.when(hit, F.col("fail_bits")).otherwise(F.lit(0).cast("long"))).alias("failed_with"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
         len([x FOR x IN w IF regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) AS n_letter_words,
         coalesce(list_max([length(x) FOR x IN w]), 0) AS longest_word
  FROM d),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
a AS (
  SELECT m.doc_id, n_words, word_chars, n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_letter_words, longest_word
  FROM m LEFT JOIN covered USING (doc_id)),
b AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 16 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_letter_words < 70 * n_words THEN 64 ELSE 0 END
    + CASE WHEN n_words > 100000 THEN 128 ELSE 0 END
    + CASE WHEN longest_word > 1000 THEN 256 ELSE 0 END AS fail_bits
  FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_letter_words, longest_word,
       CAST(fail_bits AS BIGINT) AS fail_bits, fail_bits & 3 <> 0 AS base_failed, fail_bits & 127 = 0 AS kept
FROM b
"""
