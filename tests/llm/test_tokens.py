"""Token blocks, lattices and sampled segmentations."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.edge import awkward, empty
from tryline.llm import gumbel_pieces as G
from tryline.llm import lattice, lm_lattice
from tryline.llm import token_blocks as B
from tryline.llm.textops import U64, chunks

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b", "a   b", "x \n y", "\n\n\na", "a\tb", "t \t\t u", "end ", "end\n", "e  f", "  lead", "<|endoftext|> x", "a\x1cb\x1c c", "\x85q",
       "é中 文　字   z", "", "\n", " ", "a\n\nb", "a \nb", "a\n b", "q\0r s", "it's we'll  don't"]


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces(MODEL)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60_000), max_size=700), st.integers(0, 1))
def test_blocks_round_trip(values, wide):
    ids = np.array(values, np.uint32) * np.uint32(1 + 70_000 * wide)
    x, n = B.read_shard(B.shard_bytes(ids, [None, 5], np.array([0, len(ids) // 2, len(ids)])))
    assert n == len(ids) and np.array_equal(B.unpack_blocks(x, 0, len(x["base"]))[:n], ids)
    assert np.array_equal(B.document_ids(x, n, 1), ids[len(ids) // 2:])


def test_exceptions_are_rare_and_widths_small():
    ids = np.tile(np.arange(100, 228, dtype=np.uint32), 50)
    ids[::64] = 50_000
    x = B.pack_blocks(ids)
    assert x["width"].max() == 7 and x["n_exc"].max() == 2


def test_encoder_equals_the_library():
    e = B.Encoder(BPE)
    for text, ids in zip(ODD, e.encode(ODD), strict=True):
        assert ids.tolist() == e.tok.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t.,'é中  \x1c", max_size=30), min_size=1, max_size=5))
def test_encoder_on_white_space(texts):
    e = B.Encoder(BPE)
    for text, ids in zip(texts, e.encode(texts), strict=True):
        assert ids.tolist() == e.tok.encode(text, add_special_tokens=False).ids


def test_digest_reads_the_files_back(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    df = awkward(spark).where("doc_id is not null")
    rows = sorted(B.token_digest(df, BPE, 2).collect(), key=lambda r: r.start)
    texts = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda x: x[0])
    assert [r.doc_id for r in rows] == [i for i, _ in texts]
    start = 0
    for r, (_, t) in zip(rows, texts, strict=True):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert B.token_digest(awkward(spark), BPE, 2).count() == awkward(spark).count()
    assert B.token_digest(empty(spark), BPE, 2).collect() == []


def test_encoding_holds_little_memory():
    """What a task holds while it encodes doesn't grow with its texts; pieces learned in parts are those of the library."""
    import random
    import tracemalloc
    pick = random.Random(4)
    texts = [" ".join(f"{pick.choice('abcde')}{pick.randrange(50_000)}" for _ in range(700)) for _ in range(1500)]
    e = B.Encoder(BPE)
    e.encode(["warm up"])
    tracemalloc.start()
    for c in chunks(pa.array(texts, pa.string()), B.ENCODE_CHUNK):
        found = e.encode_chunk(c)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    assert found[-1].tolist() == e.tok.encode(texts[-1], add_special_tokens=False).ids


def paths(unit: bytes, pieces, logp, always):
    """All segmentations of a unit with their log weights, by recursion."""
    by = {}
    for i in np.flatnonzero(pieces.normal):
        by.setdefault(pieces.bytes_of[i], int(i))

    def go(k):
        if k == len(unit):
            yield (), 0.0
            return
        arcs = [(unit[k:e], by[unit[k:e]]) for e in range(k + 1, len(unit) + 1) if unit[k:e] in by]
        if always or not char_known[k]:
            arcs.append((unit[k:k + 1], int(pieces.byte_id[unit[k]])))
        for text, i in arcs:
            for rest, w in go(k + len(text)):
                yield (i, *rest), logp[i] + w

    text = unit.decode()
    char_known = [c.encode() in by for c in text for _ in c.encode()]
    return dict(go(0))


@pytest.mark.parametrize("always", [True, False])
def test_marginals_equal_enumeration(pieces, always):
    logp = G.piece_logp(pieces, 1.0)
    units = [" the", " anonth", " é中", " x\U0001F600y", " a.b", "  "[:1], " thble,"]
    data = np.frombuffer("".join(units).encode(), np.uint8)
    end = np.cumsum([len(u.encode()) for u in units])
    start = np.concatenate([[0], end[:-1]])
    lat = lattice.build(data, start, end, pieces, always)
    alpha = lattice.forward(lat, logp[lat.piece])[lat.last]
    beta = lattice.backward(lat, logp[lat.piece])[lat.first]
    for k, u in enumerate(units):
        want = math.log(sum(map(math.exp, paths(u.encode(), pieces, logp, always).values())))
        assert abs(alpha[k] - want) < 1e-9 and abs(beta[k] - want) < 1e-9


def test_expected_counts_equal_enumeration(pieces):
    logp = G.piece_logp(pieces, 1.0)
    unit = " anonth".encode()
    got = lattice.expected_counts(np.frombuffer(unit, np.uint8), np.array([0]), np.array([len(unit)]), np.array([3.0]), pieces, logp)
    every = paths(unit, pieces, logp, True)
    z = sum(map(math.exp, every.values()))
    want = np.zeros(pieces.size)
    for p, w in every.items():
        for i in p:
            want[i] += 3.0 * math.exp(w) / z
    assert np.allclose(got, want)


def samples(texts, keys, k, pieces, logp):
    out = []
    for c in chunks(pa.array(texts, pa.string())):
        out += list(G.sample_chunk(c, np.array(keys, U64)[c.rows], k, G.UnitStore(pieces, logp)))
    return out


def test_samples_are_distinct_decodable_and_complete(pieces):
    logp = G.piece_logp(pieces, 1.0)
    texts = [*ODD, "▁ literal ▁", "ab", "the anonth"]
    for t, found in zip(texts, samples(texts, range(len(texts)), 4, pieces, logp), strict=True):
        assert len({s[0].tobytes() for s in found}) == len(found) >= 1
        assert all(G.decode(s[0], pieces) == t for s in found)
        assert [s[2] for s in found] == sorted((s[2] for s in found), reverse=True)


@pytest.mark.parametrize("word", ["ab", "of", "the"])
def test_all_segmentations_of_a_word_at_production_sharpness(pieces, word):
    """However small their shares (10^-19 for letters one by one), all are found, and only then are scores 1."""
    logp = G.piece_logp(pieces, 1.0)
    few = paths(b" " + word.encode(), pieces, logp, False)
    [found] = samples([word], [7], len(few) + 5, pieces, logp)
    assert {tuple(s[0].tolist()) for s in found} == set(few) and all(s[3] == 1.0 for s in found)
    [found] = samples([word], [7], len(few) - 1, pieces, logp)
    assert len(found) == len(few) - 1 and all(0.0 < s[3] <= 1.0 for s in found)
    z = math.log(sum(map(math.exp, few.values())))
    assert all(abs(s[1] - (few[tuple(s[0].tolist())] - z)) < 1e-6 for s in found)


def test_every_word_of_the_vocabulary_can_be_sampled(pieces):
    """All one-word texts that are pieces themselves, at k = 2, 8 and 64: no error, distinct, exact."""
    logp = G.piece_logp(pieces, 1.0)
    words = sorted({pieces.bytes_of[i][1:].decode() for i in np.flatnonzero(pieces.normal) if pieces.bytes_of[i][:1] == b" " and len(pieces.bytes_of[i]) > 1})
    assert len(words) > 10_000
    for k, some in ((2, words), (8, words), (64, words[::20])):
        for w, found in zip(some, samples(some, range(len(some)), k, pieces, logp), strict=True):
            assert len({s[0].tobytes() for s in found}) == len(found) >= 1
            assert all(G.decode(s[0], pieces) == w for s in found[:2])


def test_samples_are_the_top_k_of_gumbel_keys(pieces):
    """Ordered samples follow the law of the k largest perturbed values over all segmentations: drawn one after
    another by probability among those left. Checked by frequency of ordered pairs."""
    logp = G.piece_logp(pieces, 0.5)
    every = paths(b" ano", pieces, logp, False)
    z = sum(map(math.exp, every.values()))
    p = {a: math.exp(w) / z for a, w in every.items()}
    n, seen = 6000, {}
    for found in samples(["ano"] * n, range(n), 2, pieces, logp):
        pair = tuple(tuple(f[0].tolist()) for f in found)
        seen[pair] = seen.get(pair, 0) + 1 / n
    for a in p:
        for b in p:
            if a != b:
                want = p[a] * p[b] / (1 - p[a])
                assert abs(seen.get((a, b), 0) - want) < 5 * math.sqrt(want / n) + 1e-3


def test_samples_do_not_depend_on_the_texts_beside_them(pieces):
    """Alone, in one chunk with others, and with a store that has seen others: the same bits."""
    logp = G.piece_logp(pieces, 1.0)
    texts = ["the anonth of the work", "ab of common clubs", "x" * 3000 + " é中", "Mississippi work the"] * 3
    alone = [samples([t], [i], 5, pieces, logp)[0] for i, t in enumerate(texts)]
    beside = samples(texts, range(len(texts)), 5, pieces, logp)
    store = G.UnitStore(pieces, logp)
    again = []
    for i in reversed(range(len(texts))):
        [c] = chunks(pa.array([texts[i]], pa.string()))
        again.insert(0, list(G.sample_chunk(c, np.array([i], U64), 5, store))[0])
    plain = lambda found: [[(s[0].tolist(), *s[1:]) for s in f] for f in found]
    assert plain(alone) == plain(beside) == plain(again)


def test_sampling_follows_the_lattice(pieces):
    """First samples are drawn with their probabilities; the estimator by inclusion scores is unbiased."""
    logp = G.piece_logp(pieces, 1.0)
    every = paths(b" anon", pieces, logp, False)
    z = sum(map(math.exp, every.values()))
    runs = samples(["anon"] * 4000, range(4000), 2, pieces, logp)
    first, weight = {}, 0.0
    for found in runs:
        p = tuple(found[0][0].tolist())
        first[p] = first.get(p, 0) + 1 / len(runs)
        weight += sum(math.exp(s[1]) / s[3] for s in found) / len(runs)
    for p, w in every.items():
        assert abs(first.get(p, 0) - math.exp(w) / z) < 0.04
    assert abs(weight - 1.0) < 0.05


def test_samples_depend_on_key_and_text_alone(spark, pieces):
    df = awkward(spark)
    one = sorted(map(str, G.sample_segmentations(df, MODEL, k=2).collect()))
    assert one == sorted(map(str, G.sample_segmentations(df.repartition(7), MODEL, k=2).collect()))
    back = G.decode_pieces(G.sample_segmentations(df, MODEL, k=2, keep=["doc_id", "text"]), MODEL).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert all(r.round_trip for r in G.sample_segmentations(df, MODEL, k=2, digest=True).collect())
    assert G.sample_segmentations(empty(spark), MODEL).collect() == []


def test_pieces_of_several_spaces_are_sampled():
    """All segmentations of texts with runs of spaces, pieces of several spaces among them."""
    pieces = lattice.Pieces(MODEL, space_runs=True)
    logp = G.piece_logp(pieces, 1.0)
    double = next(i for i in np.flatnonzero(pieces.normal) if pieces.bytes_of[i] == b"  ")
    for text in ("   a", "a   ", "a   b", "  ", "   "):
        few = paths(b" " + text.encode(), pieces, logp, False)
        [found] = samples([text], [7], len(few) + 5, pieces, logp)
        assert {tuple(s[0].tolist()) for s in found} == set(few) and all(G.decode(s[0], pieces) == text for s in found)
        assert any(double in s[0] for s in found)
    beside = samples(["a  ", "  b", "", " ", "c"], range(5), 3, pieces, logp)
    assert [G.decode(found[0][0], pieces) for found in beside] == ["a  ", "  b", "", " ", "c"]


def test_digests_are_of_ids_and_of_decoded_texts(spark, monkeypatch):
    """The query decodes what the operator returned: other ids are noticed."""
    from tryline.llm import queries
    df = awkward(spark)
    monkeypatch.setattr(queries, "read_table", lambda *_: df)
    encoded = G.sample_segmentations(df, MODEL, k=2, keep=["doc_id", "text"])
    want = sorted((str(r.doc_id), r["sample"], r.n_pieces, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in encoded.collect())
    got = queries.op3_gumbel_pieces(spark, "").collect()
    assert sorted((str(r.doc_id), r["sample"], r.n_pieces, r.ids_crc32) for r in got) == want and all(r.round_trip for r in got)
    twice = lambda *a, **b: G.sample_segmentations(*a, **b).withColumn("ids", F.concat("ids", "ids"))
    monkeypatch.setattr(queries, "sample_segmentations", twice)
    assert all(r.round_trip == (r.n_pieces == 0) for r in queries.op3_gumbel_pieces(spark, "").collect())


def test_decoding_in_parts(spark, monkeypatch):
    monkeypatch.setattr(G, "DECODE_CHUNK", 3)
    one = G.sample_segmentations(awkward(spark).limit(6), MODEL, k=1, keep=["doc_id", "text"])
    df = one.unionByName(one.limit(1).withColumn("ids", F.lit(None).cast("array<int>")))
    back = G.decode_pieces(df, MODEL).collect()
    assert sum(r.decoded is None for r in back) == 1 and all(r.decoded == (r.text or "") for r in back if r.decoded is not None)


def test_scores_equal_plain_python(spark, pieces, monkeypatch):
    import collections
    import re
    word = re.compile(r"[^\x20\x09-\x0D]+")
    rows = [(i, f"word{i % 7} the the anonth w{i} Common") for i in range(60)] + [(100, None), (101, ""), (None, "the x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    count = collections.Counter()
    for i, t in rows:
        if i is not None and not held(i):
            count.update([*word.findall(low(t)), ""])
    total, types = sum(count.values()), len(count)
    once, twice = (sum(v == k for v in count.values()) for k in (1, 2))
    discount = (once + 1) / (once + 2 * twice + 2)
    new = discount * types / total
    logp = lm_lattice.learn_pieces(spark.createDataFrame([(k + 1, bytearray(w.encode()), n) for k, (w, n) in enumerate(
        sorted(count.items())) if w], "h long, word binary, n long"), MODEL)

    def p(w):
        return sum(map(math.exp, paths(b" " + w.encode(), pieces, logp, True).values()))

    for head in (2, 1000):
        got = sorted(lm_lattice.score_documents(df, MODEL, head_words=head).collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
        for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
            w = word.findall(low(t))
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held(i), len(w) + 1, total)
            assert r.n_known == sum(count[k] > 0 for k in [*w, ""])
            assert abs(r.base_score - sum(math.log10((count[k] + 0.1) / (total + 0.1 * (types + 1))) for k in [*w, ""])) < 1e-6
            want = sum(math.log10((max(count[k] - discount, 0) / total if count[k] else 0) + new * p(k)) for k in w)
            assert abs(r.score - want - math.log10((count[""] - discount) / total)) < 1e-6


def test_scores_of_awkward_rows(spark):
    df = awkward(spark)
    got = lm_lattice.score_documents(df, MODEL).collect()
    assert len(got) == df.count() and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_lattice.score_documents(empty(spark), MODEL).collect() == []
    alone = spark.createDataFrame([(i, "only held out") for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0], "doc_id long, text string")
    assert all(r.train_tokens == 0 and math.isfinite(r.score) for r in lm_lattice.score_documents(alone, MODEL).collect())
