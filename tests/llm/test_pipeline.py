"""The pipeline's stages on planted documents, and the driver's contract."""

import random

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.edge import awkward, empty
from tryline.llm import rule_ledger
from tryline.llm.gumbel_pieces import decode_pieces


def test_stage_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secrets", "mixing", "encoding"]
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {q if q == "pipeline" else q.split("_")[0] + "_" for q in entry.queries()
                                                               if q == "pipeline" or q.startswith("op")}


def clean(rng, n=120):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_planted_documents(spark):
    rng = random.Random(5)
    texts = {i: clean(rng) for i in range(30)}
    words = texts[3].split()
    words[60] = "changed"
    texts |= {100: texts[3], 101: " ".join(words), 102: "too short", 103: "spam spam spam " * 40,
              104: clean(rng) + " password=hunter2hunter2 " + clean(rng)}
    docs = spark.createDataFrame([(i, t, "en", "ab"[i % 2], len(t)) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(texts) - {102, 103}
    alone = stages["near_duplicates"](spark, kept, "")
    assert alone.columns == docs.columns and {r.doc_id for r in alone.collect()} == set(texts) - {100, 101, 102, 103}
    masked = {r.doc_id: r for r in stages["secrets"](spark, alone, "").collect()}
    assert "hunter2" not in masked[104].text and masked[104].n_chars == len(masked[104].text)
    assert all(masked[i].text == texts[i] for i in masked if i != 104)
    mixed = stages["mixing"](spark, alone, "")
    assert mixed.columns == docs.columns
    coded = stages["encoding"](spark, mixed, "").collect()
    assert len(coded) == 2 * mixed.count()
    back = decode_pieces(stages["encoding"](spark, mixed, ""), corpus_pipeline.PIECE_MODEL).collect()
    assert all(r.decoded == texts[r.doc_id] for r in back)


def test_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            rows = out.collect()
            assert name == "encoding" or out.columns == docs.columns
            if docs.isEmpty():
                assert rows == []


def test_repeated_rows_leave_one(spark):
    got = corpus_pipeline.near_duplicates(spark, awkward(spark), "").collect()
    assert [r.doc_id for r in got].count(9) == 0 and [r.doc_id for r in got].count(8) == 1
    assert sum(r.doc_id is None for r in got) == 2


def test_ids_that_name_no_row(spark):
    """Different texts under one id both stay; copies without an id go like others, and behind those with one."""
    rng = random.Random(7)
    a, b, c, d = (clean(rng) for _ in range(4))
    rows = [(1, a), (1, b), (2, b), (None, c), (None, c), (None, a), (3, d), (3, d), (5, None), (5, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c), (3, d), (5, None), (5, None), (None, "")], key=str)


def test_policies_only_add_rules():
    assert all(p.mask & rule_ledger.BASE.mask == rule_ledger.BASE.mask for p in rule_ledger.POLICIES.values())
