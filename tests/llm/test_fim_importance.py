"""Container sets and fill-in-middle against plain Python; importance resampling against zlib and math."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.edge import awkward, empty
from tryline.llm import fim
from tryline.llm import importance as I
from tryline.llm.boundary_set import ArrayContainer, BitmapContainer, BoundarySet, RunContainer
from tryline.llm.prefix_crc import CrcShift, WordCrcs

SF = "/root/testdata/sf0.001"


def test_boundary_set_selects_in_every_kind_of_container():
    rng = np.random.default_rng(1)
    block = 1 << 16
    sparse = np.sort(rng.choice(block, 500, replace=False))
    dense = block + np.sort(rng.choice(block, 40000, replace=False))
    runs = 3 * block + np.concatenate([np.arange(100, 9000), np.arange(20000, 60000)])
    offsets = np.concatenate([sparse, dense, runs, [7 * block + 5]])
    got = BoundarySet(offsets)
    assert [type(c) for c in got.containers] == [ArrayContainer, BitmapContainer, RunContainer, ArrayContainer]
    assert len(got) == len(offsets)
    for k in [0, 499, 500, 501, *rng.integers(0, len(offsets), 300).tolist(), len(offsets) - 1]:
        assert got.select(k) == offsets[k]
    with pytest.raises(IndexError):
        got.select(len(offsets))
    assert len(BoundarySet(np.zeros(0, np.int64))) == 0


def plain_fim(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[k:k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", text, None, None
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@pytest.mark.parametrize("rate", [100, 40])
def test_fill_in_middle_equals_plain_python_and_restores(spark, rate):
    rng = random.Random(2)
    texts = ["", None, "\n", "\n\n\n", "a", "a\n", "a\nb", "é\n中文\n\U0001F600 <", "<P>x\ny", "a<S>", "x<M\n>", "<\nP>", "<P\n", "line\n" * 70000]
    texts += ["".join(rng.choice("ab\n<>PSM é中") for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = [(i - 3, t) for i, t in enumerate(texts)] + [(None, "no id\nat all\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in fim.fill_in_middle(docs, rate=rate).collect()}
    digests = {r["doc_id"]: r for r in fim.fill_in_middle(docs, rate=rate, digest=True).collect()}
    for doc_id, text in rows:
        want = plain_fim(doc_id, text, rate=rate)
        r, d = got[doc_id], digests[doc_id]
        assert (r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) == want
        assert fim.restore(r["output"], r["form"]) == (text or "")
        assert d["output_sha256"] == hashlib.sha256(want[2].encode()).hexdigest()
        assert d["restored_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_crc_of_substrings_from_two_prefixes():
    rng = random.Random(3)
    tables = CrcShift()
    words = [bytes(rng.choices(b"abcdefg\xc3\xa9", k=rng.choice([1, 2, 5, 63, 64, 65, 300, 70000]))) for _ in range(60)]
    crcs = WordCrcs(words, tables)
    for size in (1, 2, 5, 60, 61):
        want = [zlib.crc32(b" ".join(words[k:k + size])) for k in range(len(words) - size + 1)]
        assert crcs.ngrams(size).tolist() == want
    assert WordCrcs([], tables).ngrams(1).tolist() == []


def plain_importance(docs, target, percent=25, least=20, buckets=10_000, size=2):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}

    def features(text):
        w = word.findall((text or "").translate(lower))
        return len(w), [zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets for n in range(1, size + 1) for k in range(len(w) - n + 1)]

    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, 0) for r in rows if r not in drawn], key=repr)


def as_rows(df):
    return sorted([(r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"] or 0) for r in df.collect()], key=repr)


def test_importance_equals_brute_force_on_the_small_tables(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain_importance([tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.select("text").collect()])
    assert as_rows(I.importance_resample(docs, target)) == want


def test_importance_of_awkward_rows(spark):
    docs, target = awkward(spark).where("doc_id is null or doc_id <> 9"), awkward(spark).select("text", "source")
    want = plain_importance([tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.select("text").collect()],
                            percent=50, least=2, buckets=200_000, size=3)
    got = as_rows(I.importance_resample(docs, target, percent=50, least_words=2, buckets=200_000, size=3))
    assert got == want
    assert I.importance_resample(empty(spark), target).count() == 0
    assert [r["rank"] for r in I.importance_resample(docs.where("doc_id = 8"), empty(spark), percent=100).collect()] == [1]


def test_ranks_of_ties_and_repeated_rows(spark):
    docs = spark.createDataFrame([(4, "same words " * 12)] * 5 + [(3, "same words " * 12)], "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["rank"]) for r in I.importance_resample(docs, docs, percent=100).collect())
    assert len({rank for _, rank in got}) == 6 and sorted(rank for _, rank in got) == [1, 2, 3, 4, 5, 6]
