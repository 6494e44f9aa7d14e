"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.llm.common import Scratch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges (u, v)``; component is its smallest node.

    Every round hangs each node below the smallest node it sees (large star:
    its larger neighbours; small star: its smaller ones), until the edges are
    stars around the smallest nodes. A node's neighbours are never gathered
    into one row: the minimum is a partial aggregate, joined back on the node,
    and a node with very many neighbours is split by the skew join.
    """
    cur = scratch.table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), f"{tag}-edges0")
    state, step = _state(cur), 0
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        step += 1
        nxt = scratch.table(small, f"{tag}-edges{step}")
        after = _state(nxt)
        scratch.drop(f"{tag}-edges{step - 1}")
        cur = nxt
        if after == state:
            break
        state = after
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
