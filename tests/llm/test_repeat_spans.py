"""Suffix sorting against sorted(), repeat removal against a set of all windows seen so far."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.edge import awkward, empty
from tryline.llm import repeat_spans as R
from tryline.llm.suffix_sort import adjacent_prefixes, byte_words, smaller_than_successor, suffix_array

WORDS = [f"w{k}" for k in range(50)]


def test_suffix_array_sorts_all_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(1500):
        text = rng.integers(0, rng.integers(1, 5), rng.integers(1, 60)).astype(np.uint8) + np.uint8(rng.choice([0, 251]))
        raw = bytes(text)
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert suffix_array(text, byte_words(text), 64).tolist() == want
        assert smaller_than_successor(text).tolist() == [raw[i:] < raw[i + 1:] for i in range(len(raw))]


def test_adjacent_prefixes_are_exact_up_to_the_limit():
    text = np.frombuffer(b"abcabcabcabdabcabcabcabcabd" * 3 + bytes(30), np.uint8)
    words = byte_words(text)
    order = suffix_array(text, words, 24)
    order = order[order < len(text) - 24]
    raw, got = bytes(text), adjacent_prefixes(words, order, 20)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1]:order[k - 1] + 20], raw[order[k]:order[k] + 20]
        assert got[k] == next((i for i in range(20) if a[i] != b[i]), 20)


def test_sliding_minimum():
    rng = np.random.default_rng(2)
    for n, width in ((5, 5), (17, 4), (100, 77), (78, 77)):
        values = rng.integers(0, 9, n).astype(np.uint64)
        assert R.sliding_minimum(values, width).tolist() == [min(values[k:k + width]) for k in range(n - width + 1)]


def brute(rows, length=100):
    """Rows in order; per row what is left of it."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                covered[s:s + length] = b"\1" * length
            else:
                seen.add(raw[s:s + length])
        kept = bytes(c for c, gone in zip(raw, covered, strict=True) if not gone)
        runs = bytes(covered).replace(b"\0", b" ").split()
        out.append((doc_id, len(raw), sum(covered), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def random_rows(seed):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(150):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randrange(80)))
        if rng.random() < 0.5:
            text += " " + rng.choice(passages) + " " + " ".join(rng.choice(WORDS) for _ in range(30))
        if rng.random() < 0.1:
            text += "x" * rng.randrange(400)
        if rng.random() < 0.1:
            text += passages[0][:120] * 3
        rows.append((i, text))
    return rows + [(200 + i, rows[i][1]) for i in range(20)] + [(300, None), (301, ""), (302, "é中" * 100), (303, "中é中" * 100)]


@pytest.mark.parametrize("hot", [R.HOT, 1])
def test_whole_operator_equals_brute_force(spark, hot):
    """With ``hot`` 1 every shared anchor with three or more segments goes by single windows."""
    rows = random_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in R.remove_repeats(docs, digest=True, hot=hot).collect())
    assert got == brute(rows)


def test_hot_anchors_leave_a_full_bucket():
    """Beyond ``most`` segments those of a hot anchor pass on; no segment is lost."""
    rng = np.random.default_rng(5)
    rows = np.zeros(900, R.SEGMENT)
    rows["anchor"] = np.where(np.arange(900) < 700, 7, np.arange(900) // 2)
    rows["contents"] = rng.integers(1, 1 << 60, 900)
    rows["id"], rows["windows"] = np.arange(900), 5
    parts = [R._pieces(R.SEGMENTS, np.zeros(100, np.int64), rows[k:k + 100]) for k in range(0, 900, 100)]
    out = {kind: [] for kind in (R.SPANS, R.SEGMENTS, R.HOT_SEGMENTS)}
    for batch in R._collapse_task(100, 3, hot=50, most=250)(iter(parts)):
        for kind, piece in zip(batch.column("kind").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            out[kind].append(R.unpack(piece, R.SPAN if kind == R.SPANS else R.SEGMENT))
    assert sorted(np.concatenate(out[R.HOT_SEGMENTS])["id"].tolist()) == list(range(700))
    assert sorted(np.concatenate(out[R.SEGMENTS])["id"].tolist()) == list(range(700, 900))
    assert not out[R.SPANS]


def test_fetching_and_sorting_hold_little_memory():
    """What a task holds doesn't grow with a batch's open segments or a share's bytes; nothing is lost on the way."""
    import tracemalloc
    text = "".join(random.Random(3).choices("abcdefgh ", k=60_000))
    rows = np.zeros(1500, R.SEGMENT)
    rows["anchor"], rows["contents"], rows["windows"] = np.arange(1500) % 300, 1 + np.arange(1500) % 2, 41
    rows["contents"][::10] = 0
    rows["start"] = np.arange(1500) * 39
    batch = pa.RecordBatch.from_pydict({"text": [text] * 150, "rows": [R.pack(rows)] * 150})
    tracemalloc.start()
    seen = {R.SEGMENTS: 0, R.HOT_SEGMENTS: 0}
    for out in R._fetch_task(100, 64, 64, R.FETCH_BYTES)(iter([batch])):
        for kind, n, blob in zip(*[out.column(k).to_pylist() for k in ("kind", "n", "bytes")], strict=True):
            seen[kind] += n
            assert kind == R.HOT_SEGMENTS or len(blob) == n * 140
    assert tracemalloc.get_traced_memory()[1] < 90 << 20
    assert seen == {R.SEGMENTS: 150 * 1350, R.HOT_SEGMENTS: 150 * 150 * 41}
    many = np.zeros(40_000, R.SEGMENT)
    many["anchor"], many["windows"], many["id"] = np.arange(40_000) // 20, 41, np.arange(40_000)
    bytes_ = np.random.default_rng(1).integers(97, 105, 140 * 40_000).astype(np.uint8)
    bytes_[-140:] = bytes_[-280:-140]
    share = R._pieces(R.SEGMENTS, np.zeros(40_000, np.int64), many, [bytes(x) for x in bytes_.reshape(-1, 140)])
    tracemalloc.reset_peak()
    base = tracemalloc.get_traced_memory()[0]
    [out] = R._sort_task(100, 1, R.SORT_BYTES)(iter([share]))
    peak = tracemalloc.get_traced_memory()[1] - base
    tracemalloc.stop()
    assert R.unpack(out.column("piece")[0].as_py(), R.SPAN).tolist() == [(39_999, 0, 0, 140)]
    assert peak < 120 << 20


def test_pieces_of_long_texts_overlap():
    text = " ".join(random.Random(1).choices(WORDS, k=3000))
    batch = pa.RecordBatch.from_pydict({"id": [5], "key": [0], "text": [text]})
    for piece in (150, 1000, 1 << 20):
        rows = np.concatenate(list(R.scan(batch, 100, 24, piece)))
        windows = np.concatenate([np.arange(s, s + w) for s, w in zip(rows["start"], rows["windows"].astype(int), strict=True)])
        assert sorted(windows.tolist()) == list(range(len(text) - 99))


def test_general_output_and_awkward_rows(spark):
    """Equal ids are ordered by row; of the long text's copies one stays in part (it repeats itself), null ids come last."""
    docs = awkward(spark)
    got = R.remove_repeats(docs, length=100).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        assert r["n_bytes"] - r["n_removed"] == len(r["kept"])
        by_id.setdefault(r["doc_id"], []).append(r["n_removed"])
    long = len("alpha beta gamma delta " * 4000)
    assert by_id[8] == [long - 23]      # all windows but those of the first period of 23 bytes repeat
    assert by_id[9] == [long, long]
    assert by_id[12] == [20000 - 1]
    assert by_id[None] == [0, 0]
    assert R.remove_repeats(empty(spark)).count() == 0


def test_null_ids_are_later_than_all_others(spark):
    text = " ".join(random.Random(4).choices(WORDS, k=60))
    docs = spark.createDataFrame([(None, text), (2**63 - 2, text), (None, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["n_removed"]) for r in R.remove_repeats(docs).collect())
    assert got == [(False, 0), (True, len(text)), (True, len(text))]
