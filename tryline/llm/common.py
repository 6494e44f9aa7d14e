"""Scratch tables in the shared folder and small column helpers."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.session import shared_path
from tryline.sinks.writers import drop_materialized

#: A word is a maximal run of characters that are not ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def worker_cache() -> dict:
    """Objects that outlive a task in a reused Python worker.

    Task functions travel by value, so a module's own globals begin anew with
    every task. What is kept here must be bounded and must not change results.
    """
    holder = sys.modules.setdefault("_tryline_worker", types.ModuleType("_tryline_worker"))
    return holder.__dict__.setdefault("cache", {})


def with_row_key(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with ``__file`` and ``__at``, the name of each row's file and its place in it.

    Unlike a running number they are the same whenever the rows are read.
    Rows that don't come straight from files are written first.
    """
    def keyed(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.select("*", meta["file_name"].alias("__file"), meta["row_index"].alias("__at"))

    try:
        return keyed(docs)
    except AnalysisException:
        return keyed(scratch.table(docs, "rows"))


@contextmanager
def shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go as soon as it ends.

    Otherwise they stay until the driver's memory is next collected, so the
    shuffles of all tables of a run pile up on the executors' disks. While the
    query runs they are kept, so a lost task finds its input as ever.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Scratch:
    """Tables of one operator run, written below ``spark.checkpoint.dir``.

    A written table cuts lineage: a lost executor costs the re-reading of
    files, never the recomputation of what came before. ``drop`` removes
    tables that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
        self.paths: dict[str, str] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = f"{self.root}/{name}"
        with shuffles_end_with_query(self.spark):
            df.write.mode("overwrite").parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        drop_materialized(self.spark, [self.paths.pop(n) for n in names])


def doc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written in decimal, modulo ``modulus`` (the contract's split of documents)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
