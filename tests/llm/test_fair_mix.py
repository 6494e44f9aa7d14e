import collections
import hashlib
import random
import re

from tests.llm.edge import awkward, empty
from tryline.llm import fair_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    sized = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    size = {n: sum(k for _, s, k in sized if s == n) for n in names}
    w = {n: r % 3 + 1 for r, n in enumerate(names)}
    budget = sum(size.values())
    capped: set = set()
    while True:
        left = budget - sum(3 * size[n] for n in capped)
        free = [n for n in names if n not in capped]
        goal = {n: 3 * size[n] if n in capped else left * w[n] / sum(w[x] for x in free) for n in names}
        over = {n for n in free if goal[n] > 3 * size[n]}
        if not over:
            break
        capped |= over
    order = []
    for r, n in enumerate(names):
        own = sorted((hashlib.md5(f"mix:{'null' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, k)
                     for i, s, k in sized if s == n and k > 0)
        for e in range(3):
            cum = 0
            for _, known, i, k in own:
                cum += k
                if goal[n] > 0:
                    order.append(((e * size[n] + cum) / goal[n], r, known, i, e, k))
    taken, total = collections.Counter(), 0
    for _, _, known, i, _, k in sorted(order):
        total += k
        if total > budget:
            break
        taken[i if known else None] += k
    return sized, size, goal, taken


def compare(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = fair_mix.mix_report(df).collect()
    sized, size, goal, taken = brute(rows)
    assert len(got) == len(rows)
    by = collections.Counter()
    source = {i: s for i, s, _ in sized}
    for r in got:
        by[r.doc_id] += r.taken
        s = source[r.doc_id]
        assert r.source_size == size[s] and abs(r.target - goal[s]) < 1e-6 * max(1, goal[s])
        assert 0 <= r.taken <= 3 * r.size
    assert {k: v for k, v in by.items() if v} == {k: v for k, v in taken.items() if v}
    return got


def documents(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join("w" * 3 for _ in range(rng.randrange(0, 40))), rng.choice(sources)) for i in range(n)]


def test_equals_brute_force(spark):
    compare(spark, documents(400, ["a", "b", "c", "d", None, "a", "a", "é"]))


def test_blocks_of_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(fair_mix, "ROWS_PER_BLOCK", 1)   # 16^2 and 16^4 blocks
    compare(spark, documents(600, ["hot"] * 8 + ["x", "y"]))


def test_targets_stop_at_three_times_the_source(spark):
    got = compare(spark, documents(200, ["big"] * 60 + ["s1", "s2", "s3"]))
    small = [r for r in got if r.source_size * 3 == r.target]
    assert small


def test_awkward_rows(spark):
    df = awkward(spark)
    got = fair_mix.mix_report(df).collect()
    assert len(got) == df.count()
    assert all(r["size"] == 0 or r.taken <= 3 * r["size"] for r in got)
    again = fair_mix.mix_report(df.repartition(5)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))


def test_empty_and_wordless(spark):
    assert fair_mix.mix_report(empty(spark)).collect() == []
    assert fair_mix.mix(empty(spark)).collect() == []
    rows = fair_mix.mix_report(spark.createDataFrame([(1, " ", "a")], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r.target, r.taken) for r in rows] == [(0, 0.0, 0)]


def test_mixed_documents_follow_the_report(spark):
    rows = documents(300, ["a", "b", "c", "c", "c"])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    count = collections.Counter(r.doc_id for r in fair_mix.mix(df).collect())
    report = {r.doc_id: r for r in fair_mix.mix_report(df).collect()}
    assert {i: c for i, c in count.items()} == {i: r.taken // r["size"] for i, r in report.items() if r.taken}


def test_repeated_rows_are_mixed_each(spark):
    df = awkward(spark)
    taken = sum(r.taken for r in fair_mix.mix_report(df).collect())
    assert sum(len(WORD.findall(r.text or "")) for r in fair_mix.mix(df).collect()) == taken
