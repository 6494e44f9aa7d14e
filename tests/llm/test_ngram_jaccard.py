import collections
import random
import re

import pytest

from tests.llm.edge import awkward, empty
from tryline.llm import ngram_jaccard
from tryline.llm.ngram_jaccard import ngram_jaccard_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) >= size:
        return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows, size, percent):
    """Component of every row by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    ids = [i for i, _ in rows]
    up = {i: i for i in ids if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if ids[a] is None or ids[b] is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(ids[a]), find(ids[b])))
                up[y] = x
    return collections.Counter((i, len(s), None if i is None else find(i)) for i, s in zip(ids, sets, strict=True))


def check(spark, rows, size, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in ngram_jaccard_components(df, size=size, percent=percent).collect())
    assert got == brute(rows, size, percent)
    return got


def variants(rng, words, n, most):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_equals_brute_force_on_chains_of_near_copies(spark, size, percent, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "ROUNDS", 1 if size == 3 else 2)
    rng = random.Random(size)
    texts = []
    for g in range(2):
        base = [f"w{rng.randrange(300)}" for _ in range(120 + 40 * g)]
        texts += variants(rng, base, 14, 5)
        w = list(base)
        for k in range(14):              # a chain: neighbours are near, the ends are not
            w[k * 7] = f"c{g}-{k}"
            texts.append(" ".join(w))
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    texts += ["common line of words here " + " ".join(f"u{rng.randrange(9999)}" for _ in range(rng.randrange(0, 6))) for _ in range(30)]
    rng.shuffle(texts)
    got = check(spark, list(enumerate(texts)), size, percent)
    assert len({c for _, _, c in got}) < len(texts) - 30


def test_exactly_at_the_threshold(spark):
    words = [f"w{k}" for k in range(21)]           # 19 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(words[:-2])), (4, " ".join([*words, "x", "y"]))]
    check(spark, rows, 3, 90)


def test_awkward_rows(spark):
    df = awkward(spark)
    got = collections.Counter(tuple(r) for r in ngram_jaccard_components(df, size=3, percent=90).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.collect()], 3, 90)


def test_empty_table(spark):
    assert ngram_jaccard_components(empty(spark)).collect() == []


def test_filter_sizes_are_safe():
    """The lemma behind the sample and the prefixes, by exhaustion of sizes."""
    for percent in (80, 90):
        for n in range(1, 400):
            need = -(-percent * n // 100)
            level = ngram_jaccard._level(n, percent)
            assert ngram_jaccard.sample_size(n, percent) == min(n, n - need + level)
            for m in range(need, n + 1):          # a partner's size, the smaller one
                least = min(level, ngram_jaccard._level(m, percent))
                for k in (n, m):
                    places = ngram_jaccard.sample_size(k, percent) - least + 1
                    assert ngram_jaccard.prefix_size(k, percent) >= places
