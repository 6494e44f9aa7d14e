"""Fill-in-the-middle transformation at line boundaries (operator 12).

A text is cut into lines (each with its newline; a last line may have none).
Two cuts, drawn from the SHA-256 of ``<seed>:<id>``, give prefix, middle and
suffix, which are put out in the order prefix, suffix, middle (``psm``) or
suffix, prefix, middle (``spm``) behind sentinels. The line ends of a text,
in code points, form a ``BoundarySet``; both cut offsets are selects in it.

One pass over the rows, no shuffle; a text and its offsets are in memory one
at a time.

Defined cases: a null text is empty; an empty text, a text that holds a
sentinel, and the share of texts that ``rate`` leaves out stay as they are
(form ``plain``, null lengths). A null id draws from ``<seed>:null``. Equal
rows give equal results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tryline.llm.boundary_set import BoundarySet

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Texts of a hundred that are transformed, and of these a hundred that are put out as spm.
RATE, SPM_SHARE = 100, 50


@dataclass(frozen=True)
class Transformed:
    form: str
    lines: int
    output: str
    prefix_chars: int | None
    middle_chars: int | None


def line_ends(text: str) -> np.ndarray:
    """Code point offsets behind every line of ``text``."""
    if not text:
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10) + 1
    if not text.endswith("\n"):
        ends = np.append(ends, len(text))
    return ends


def transform(text: str, draws: tuple[int, int, int, int], rate: int = RATE, spm_share: int = SPM_SHARE) -> Transformed:
    """``text`` rearranged by four unsigned draws: two cuts, whether at all, and the form."""
    ends = BoundarySet(line_ends(text))
    n = len(ends)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= rate:
        return Transformed("plain", n, text, None, None)
    first, last = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    a, b = (ends.select(k - 1) if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm_share:
        return Transformed("spm", n, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a)
    return Transformed("psm", n, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a)


def restore(output: str, form: str) -> str:
    """The text that ``transform`` rearranged; no sentinel overlaps itself, so the first ones are the inserted ones."""
    if form == "plain":
        return output
    head, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output[len(head):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def draws_of(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


_FIELDS = [("n", pa.int64()), ("form", pa.string()), ("output", pa.large_string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_DIGESTS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
            ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
#: Bytes of output put into one Arrow batch.
BATCH_BYTES = 16 << 20


def _task(seed: int, rate: int, spm_share: int, digest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    fields = _DIGESTS if digest else _FIELDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, size = [], [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]],
                names=["doc_id", *[name for name, _ in fields]])
            ids.clear()
            rows.clear()
            return out

        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                key, text = doc_id.as_py(), value.as_py() or ""
                t = transform(text, draws_of(key, seed), rate, spm_share)
                ids.append(key)
                if digest:
                    rows.append((t.lines, t.form, t.prefix_chars, t.middle_chars, _sha(t.output), _sha(restore(t.output, t.form))))
                    size += 256
                else:
                    rows.append((t.lines, t.form, t.output, t.prefix_chars, t.middle_chars))
                    size += len(t.output) + 64
                if size > BATCH_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   spm_share: int = SPM_SHARE, digest: bool = False) -> DataFrame:
    """Per document ``id_col, n, form, output, prefix_chars, middle_chars`` (``n``: lines).

    With ``digest`` the output's and the rebuilt text's SHA-256 stand for the output.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = ["n long", "form string", "prefix_chars long", "middle_chars long", "output_sha256 string", "restored_sha256 string"] if digest \
        else ["n long", "form string", "output string", "prefix_chars long", "middle_chars long"]
    out = named.mapInArrow(_task(seed, rate, spm_share, digest), "doc_id long, " + ", ".join(parts))
    return out.withColumnRenamed("doc_id", id_col)


ORACLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS hex
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(hex, 1, 8) AS BIGINT) % (len(units) + 1) AS c1,
         CAST('0x' || substr(hex, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CAST('0x' || substr(hex, 25, 8) AS BIGINT) % 100 AS share,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM cut),
parts AS (
  SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN share < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(c1, c2)], '') AS p,
         array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(units[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
