"""Sinks: full-refresh tables, snapshots, exports, materialisation.

Writers act; everything upstream stays lazy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.session import shared_path


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """B1: truncate-and-load full refresh."""
    df.write.mode("overwrite").format(fmt).save(path)


def dated_snapshot(df: DataFrame, root: str, name: str, run_date: str, mode: str = "overwrite") -> str:
    """Write ``{root}/{name}_{run_date}`` (a new snapshot per run)."""
    path = f"{root.rstrip('/')}/{name}_{run_date}"
    df.write.mode(mode).parquet(path)
    return path


def export_json(df: DataFrame, path: str, order_by: Sequence[str] = (), limit: int | None = None) -> None:
    """Named query result as JSON lines, optionally the first ``limit`` rows
    of a total order (``limit`` is the feature here: a sample export)."""
    out = df.orderBy(*order_by) if order_by else df
    if limit is not None:
        # a bounded sample: one file is fine
        out = out.limit(limit).coalesce(1)
    out.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """B9 (table materialisation): write ``df`` as parquet into the shared
    checkpoint folder and return a DataFrame reading it back.

    This cuts lineage (a lost executor recomputes only from the written
    files), lets several consumers share one computation, and keeps parquet
    pruning and pushdown for the readers.
    """
    path = shared_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    MATERIALIZED.append(path)
    return spark.read.parquet(path)


MATERIALIZED: list[str] = []


def drop_materialized(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables once nothing reads them any more (end of a run)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        if p in MATERIALIZED:
            MATERIALIZED.remove(p)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """B9 (view materialisation): a lazy temp view."""
    df.createOrReplaceTempView(name)
    return df


def run_summary(counts: dict[str, DataFrame], spark: SparkSession, run_date: str) -> DataFrame:
    """B6 helper: one-row metrics frame from named DataFrames' row counts,
    computed in a single job per input (no driver-side loops over rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("metric"), "n")
             for k, df in counts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("run_date", F.lit(run_date))
