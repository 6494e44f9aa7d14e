"""Dataset builders shared by registered queries and pipelines.

Dashboard tiles and exports (C23, G4, G7), provider-style detail rows (C15),
detail snapshots (H3/H4), a run summary (B6), drifting file groups (A3/E16)
and nested event records (A9).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.functions.leagues import tile_filter
from tryline.operators import incremental
from tryline.operators.staging import keep_first
from tryline.session import shared_path
from tryline.sinks.partitioned import write_bounded
from tryline.sources.fixtures import RawTables, competition_columns, read_table

TILE_COLUMNS = ("game_date", "team_name", "score_difference", "competition_id", "competition_name")


def tile(fct: DataFrame, league: str) -> DataFrame:
    """C23 + G2: one dashboard tile's rows, ordered by (game_date, team_name)."""
    return fct.where(tile_filter(league)).select(*TILE_COLUMNS).orderBy("game_date", "team_name")


def sample(df: DataFrame, order: Sequence[str], n: int = 200) -> DataFrame:
    """The first ``n`` rows under a total order (the sample export)."""
    return df.orderBy(*order).limit(n)


def latest_rows(ts: DataFrame, n: int = 20) -> DataFrame:
    """Latest ``n`` rows of the time series (date desc, then match, team)."""
    return ts.orderBy(F.col("game_date").desc(), F.col("match_id"), F.col("team_name")).limit(n)


def match_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C15 over provider-style detail frames: one frame row per line of an
    order (so a match has several rows with differing dates); the first row
    per match by line number gives the 5 kept columns, renamed."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    cid, cname = competition_columns()
    frames = (o.join(li, o.o_orderkey == li.l_orderkey)
               .select(F.col("o_orderkey").cast("string").alias("match_id"),
                       F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
                       F.year("o_orderdate").cast("bigint").alias("season"),
                       cid.alias("competition_id"), cname.alias("competition"), "l_linenumber"))
    first = keep_first(frames, ["match_id"], [F.col("l_linenumber")])
    return first.select("match_id", F.to_date("date", "yyyyMMdd").alias("game_date"), "season",
                        "competition_id", F.col("competition").alias("competition_name"))


def detail_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two dated match-detail snapshots cut from orders by date, overlapping in
    1996; the later one carries corrected (upper-cased) names."""
    o = read_table(spark, sf_dir, "orders")
    cid, cname = competition_columns()
    details = o.select(F.col("o_orderkey").cast("string").alias("match_id"),
                       F.col("o_orderdate").cast("date").alias("game_date"),
                       F.year("o_orderdate").cast("bigint").alias("season"),
                       cid.alias("competition_id"), cname.alias("competition_name"))
    # an order without a date is in the later snapshot
    a = (details.where(F.col("game_date") < F.lit("1997-01-01").cast("date"))
                .withColumn("snapshot", F.lit("match_details_20240101")))
    b = (details.where(F.coalesce(F.col("game_date") >= F.lit("1996-01-01").cast("date"), F.lit(True)))
                .withColumn("competition_name", F.upper("competition_name"))
                .withColumn("snapshot", F.lit("match_details_20240201")))
    return a, b


def details_run_summary(raw: RawTables) -> DataFrame:
    """Run metrics of a match-details refresh, one (metric, value) row each."""
    stats, details = raw.team_stats, raw.match_details
    missing = incremental.missing_ids(stats, details)

    def long(df: DataFrame, **metrics: F.Column) -> DataFrame:
        # one aggregate pass per input, unpivoted to (metric, value) rows
        wide = df.agg(*[c.alias(k) for k, c in metrics.items()])
        return wide.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("metric"), F.col(k).cast("bigint").alias("value")) for k in metrics])).alias("m")
        ).select("m.*")

    return (long(stats, match_ids_total=F.count_distinct("match_id"), team_stats_rows=F.count(F.lit(1)))
            .unionByName(long(details, match_ids_preexisting=F.count_distinct(F.nullif("match_id", F.lit("")))))
            .unionByName(long(missing, match_ids_to_fetch=F.count(F.lit(1)))))


def drift_groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two file groups of lineitem with drifted schemas, split by line status:
    finished lines lack the discount and tax columns; all others have them
    (zero discounts landed as NULL)."""
    li = read_table(spark, sf_dir, "lineitem")
    base = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate"]
    finished = F.col("l_linestatus").eqNullSafe("F")
    old = li.where(finished).select(*base)
    new = li.where(~finished).select(
        *base[:4], F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax", "l_shipdate")
    return old, new


def drift_files(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder with the two file groups of ``drift_groups``, in the shared folder; returns its path."""
    root = shared_path(spark, f"landing/{uuid.uuid4().hex}")
    for df in drift_groups(spark, sf_dir):
        # the groups' files lie beside one another, as they land
        df.write.mode("append").parquet(root)
    return root


#: Bytes per file of the laid-out copy of the lines, so that several files make a year.
LAYOUT_BYTES = 4 << 20


def laid_out_lines(spark: SparkSession, sf_dir: str) -> str:
    """All lines in folders by ship year, ordered by supplier in size-bounded files; returns the path."""
    root = shared_path(spark, f"layout/{uuid.uuid4().hex}")
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"), "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    write_bounded(lines, root, ["ship_year"], ["l_suppkey", "l_orderkey", "l_linenumber"], LAYOUT_BYTES)
    return root


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON record per event: ``{"name": ..., "types": [{"type": {"name": ...}}, ...]}``
    with the event type and the ``k`` value of its props as the two types."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    types = F.array(F.struct(F.struct(F.col("event_type").alias("name")).alias("type")),
                    F.struct(F.struct(F.concat(F.lit("k"), k).alias("name")).alias("type")))
    doc = F.to_json(F.struct(F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("name"),
                             types.alias("types")))
    return ev.select("event_id", doc.alias("doc"))
