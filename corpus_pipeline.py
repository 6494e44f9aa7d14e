"""Corpus pipeline: quality rules, near duplicates, secrets, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; all but the last return the columns of documents. The runner writes
every stage's result as Parquet and rereads it for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.llm import fair_mix, rule_ledger, secret_scan
from tryline.llm.common import Scratch, read_table
from tryline.llm.gumbel_pieces import sample_segmentations
from tryline.llm.ngram_jaccard import ngram_jaccard_components

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v1 keeps (operator 6)."""
    rows = rule_ledger.ledger(docs)
    return rule_ledger.apply_policy(rows, rule_ledger.POLICIES["v1"]).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate group (operator 1: five words, similarity 0.8): that of the smallest id.

    Rows are told apart by a number of their own, whatever their ids: rows of
    one id with different texts are different documents, and rows without id
    link like all others (they are last in their groups). Rows without words
    are groups of their own.
    """
    scratch = Scratch(spark, "near-duplicates")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.when(F.col("doc_id").isNull(), 2).otherwise(F.col("n")))).first()[0]
    if (ids or 0) > 1:
        # the ids name no row: a written running number does
        rows = scratch.table(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    else:
        rows = docs.withColumn("__row", F.col("doc_id"))
    comp = scratch.table(ngram_jaccard_components(rows, id_col="__row", size=5, percent=80), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    kept = comp.select("__row", "component_id").join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(first.alias("k"))
    kept = scratch.table(kept.select(F.col("k.__row").alias("__kept")), "kept")
    return rows.join(kept, F.col("__row") == F.col("__kept"), "left_semi").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret span replaced by a mark (operator 5)."""
    out = secret_scan.redact(secret_scan.scan(docs)).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a weighted fair mix of the sources takes them, in its order (operator 9)."""
    return fair_mix.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every mixed document (operator 3)."""
    return sample_segmentations(docs, PIECE_MODEL, k=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL can express neither the similarity join nor the sampling; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; the last stage's result."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, name)
    return docs
