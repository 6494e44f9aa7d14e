"""Registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.llm import bsi_topk, fair_mix, fim, rule_ledger, secret_scan
from tryline.llm.common import doc_bucket, read_table
from tryline.llm.gumbel_pieces import digest_pieces, sample_segmentations
from tryline.llm.html_text import extract_main_text
from tryline.llm.importance import importance_resample
from tryline.llm.langid import predict, train
from tryline.llm.lm_lattice import score_documents
from tryline.llm.ngram_jaccard import ngram_jaccard_components
from tryline.llm.repeat_spans import remove_repeats
from tryline.llm.token_blocks import token_digest

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return ngram_jaccard_components(read_table(spark, sf_dir, "documents"), size=3, percent=90)


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marginal log probability of every document, learned from nine tenths of them."""
    return score_documents(read_table(spark, sf_dir, "documents"), PIECE_MODEL, holdout=10)


def op3_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, decoded again, as digests of the ids and of the texts."""
    encoded = sample_segmentations(read_table(spark, sf_dir, "documents"), PIECE_MODEL, k=2, keep=["doc_id", "text"])
    return digest_pieces(encoded, PIECE_MODEL)


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, written as block files and read back."""
    return token_digest(read_table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.scan(docs)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality ledger of every document under policy v1."""
    rows = rule_ledger.ledger(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rule_ledger.apply_policy(rows, rule_ledger.POLICIES["v1"])


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = read_table(spark, sf_dir, "documents")
    rest = doc_bucket(F.col("doc_id"), 4)
    model = train(docs, rest != 2)
    named = docs.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "text")
    return predict(named, model, ["doc_id", "held_out"])


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by a weighted fair mix of all sources."""
    return fair_mix.mix_report(read_table(spark, sf_dir, "documents"))


def op10_bsi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every 20th vector among all others."""
    return bsi_topk.bsi_topk(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op11_repeat_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier in the corpus, as digests."""
    return remove_repeats(read_table(spark, sf_dir, "documents"), length=100, digest=True)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two line ends and rearranged, as digests of the output and of the text rebuilt from it."""
    return fim.fill_in_middle(read_table(spark, sf_dir, "documents"), seed=7, rate=100, spm_share=50, digest=True)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the texts of ``benchmark``."""
    out = importance_resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), size=2, buckets=10_000,
                              least_words=20, percent=25, seed=7)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_lattice_lm, op3_gumbel_pieces, op4_token_blocks, op5_secret_scan, op6_rule_ledger, op7_language_id,
    op8_html_text, op9_fair_mix, op10_bsi_topk, op11_repeat_spans, op12_fill_in_middle, op13_importance)}

ORACLE_SQL: dict[str, str] = {
    "op6_rule_ledger": rule_ledger.ORACLE_SQL,
    "op9_fair_mix": fair_mix.ORACLE_SQL,
    "op10_bsi_topk": bsi_topk.ORACLE_SQL,
    "op12_fill_in_middle": fim.ORACLE_SQL,
}
