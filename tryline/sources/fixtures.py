"""Adapter from the driver's test tables to the raw match-statistics tables.

A match is an order, a team is a supplier (FIXTURES.md §2). Everything is a
lazy DataFrame over the given parquet files, so the raw tables -- and every
query built on them -- grow with the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tryline.operators.staging import keep_first

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# ---------------------------------------------------------------------------
# Competition assigned to each order priority (fixture rule),
# ids and names as listed by the data provider.
PRIORITY_COMPETITION = (
    ("1-URGENT", "83d92007", "European Rugby Challenge Cup"),
    ("2-HIGH", "ee0c6883", "European Rugby Champions Cup"),
    ("3-MEDIUM", "877aa127", "Super Rugby"),
    ("4-NOT SPECIFIED", "bc5d9ec5", "Pacific Nations Cup"),
    ("5-LOW", "0ab9177f", "Major League Rugby"),
)
# the details of every 50th order landed without a match id, NULL and '' in
# turn: the null-key filter drops them, and their matches stay unmatched
DETAILS_GAP = 50
# lines of this number landed a second time, without a date (null-key filter)
UNDATED_LINE = 7
# team name of the extra null-id row in raw.teams
NULL_TEAM_NAME = "Unattached"
# F1 tie-break columns carried through staging
TIE_BREAKS = ("l_linenumber", "l_partkey", "l_extendedprice")
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def team_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem line (line 7 twice), as scanned: nothing is moved yet."""
    shipped = F.col("l_shipdate").cast("date")
    dates = F.when(F.col("l_linenumber") == UNDATED_LINE, F.array(shipped, F.lit(None).cast("date"))).otherwise(F.array(shipped))
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("team_id"), F.col("l_orderkey").cast("string").alias("match_id"),
        F.explode(dates).alias("game_date"), "l_quantity", "l_discount", "l_tax", *TIE_BREAKS)


def latest_team_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest line of every team in every match; an undated one only where there is no other.

    The limit of one row per team and match is applied in each map task before
    the shuffle and again behind it, so however many lines a match or a pair
    has, each map task sends one per pair.
    """
    order = [F.col("game_date").desc(), *[F.col(c).asc() for c in TIE_BREAKS]]
    return keep_first(team_lines(spark, sf_dir), ["match_id", "team_id"], order)


def _named(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines under the names of raw.team_stats (AQE broadcasts the suppliers only when they measure small)."""
    sup = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("_team"), "s_name")
    return lines.join(sup, lines.team_id == F.col("_team")).select(
        "team_id", F.col("s_name").alias("team"), "match_id", "game_date",
        F.col("l_quantity").alias("tries"),
        F.col("l_linenumber").cast("double").alias("line_breaks"),
        F.round(F.col("l_tax") * 100, 0).alias("22m_entries"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("territory"),
        F.nullif(F.col("l_quantity"), F.lit(13.0)).alias("score"),
        *TIE_BREAKS)


def _with_opponent(lines: DataFrame, low: str, high: str, n: str) -> DataFrame:
    """The other side's id, name and score where a match has two sides."""
    other = F.when(F.col(n) == 2, F.when(F.col("team_id") == F.col(f"{low}.team_id"), F.col(high)).otherwise(F.col(low)))
    kept = [c for c in lines.columns if c not in (low, high, n)]
    return lines.select(*kept, other["team_id"].alias("team_vs_id"), other["team"].alias("team_vs"), other["score"].alias("team_vs_score"))


_SIDE = ("team_id", "team", "score")


def latest_team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of raw.team_stats that the keep-latest dedupe leaves (and undated rows of pairs without a date).

    The reduced lines are shuffled by match once; the sides of a match are
    windows over it (at most one row per team), and what follows -- the
    completeness filter, the details join -- reuses that partitioning.
    """
    w = Window.partitionBy("match_id")
    side = F.struct(*_SIDE)
    rows = _named(latest_team_lines(spark, sf_dir), spark, sf_dir).select(
        "*", F.min(side).over(w).alias("_lo"), F.max(side).over(w).alias("_hi"), F.count(F.lit(1)).over(w).alias("_n"))
    return _with_opponent(rows, "_lo", "_hi", "_n")


def raw_team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.team_stats: every line, plus the other team's id, name and score
    when the match has exactly two teams after the keep-latest dedupe.

    The sides come from the reduced lines, aggregated per match, and are
    joined to all lines; lines of one match are never gathered in one task (a
    hot match is split by the skew join).
    """
    latest = _named(latest_team_lines(spark, sf_dir), spark, sf_dir)
    side = F.struct(*_SIDE)
    sides = (latest.groupBy(F.col("match_id").alias("_match")).agg(F.min(side).alias("_lo"), F.max(side).alias("_hi"), F.count(F.lit(1)).alias("_n"))
             .where("_n = 2"))
    lines = _named(team_lines(spark, sf_dir), spark, sf_dir)
    joined = lines.join(sides, lines.match_id == F.col("_match"), "left").drop("_match")
    return _with_opponent(joined, "_lo", "_hi", "_n")


def raw_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.teams: suppliers twice (duplicates) plus one row without an id."""
    sup = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("team_id"), F.col("s_name").alias("team_name"))
    null_row = spark.range(1).select(F.lit(None).cast("string").alias("team_id"),
                                     F.lit(NULL_TEAM_NAME).alias("team_name"))
    return sup.unionByName(sup).unionByName(null_row)


def competition_columns(priority: str = "o_orderpriority") -> tuple:
    cid, cname = None, None
    for prio, comp_id, comp_name in PRIORITY_COMPETITION:
        cond = F.col(priority) == prio
        cid = F.when(cond, comp_id) if cid is None else cid.when(cond, comp_id)
        cname = F.when(cond, comp_name) if cname is None else cname.when(cond, comp_name)
    return cid, cname


def raw_match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.match_details: one row per order; some landed without a match id."""
    o = read_table(spark, sf_dir, "orders")
    cid, cname = competition_columns()
    key = F.col("o_orderkey")
    match_id = (F.when(key % (2 * DETAILS_GAP) == 0, None).when(key % DETAILS_GAP == 0, "")
                 .otherwise(key.cast("string")))
    return (o.select(match_id.alias("match_id"),
                     F.col("o_orderdate").cast("date").alias("game_date"),
                     F.year("o_orderdate").cast("bigint").alias("season"),
                     cid.alias("competition_id"),
                     F.when(F.col("o_orderstatus") == "P", F.upper(cname)).otherwise(cname)
                      .alias("competition_name")))


class RawTables:
    """Lazy raw.* tables for one scale-factor directory (the source registry, A5)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def team_stats(self) -> DataFrame:
        return raw_team_stats(self.spark, self.sf_dir)

    @property
    def latest_team_stats(self) -> DataFrame:
        """Rows that the F1 dedupe would leave, reduced before their first shuffle."""
        return latest_team_stats(self.spark, self.sf_dir)

    @property
    def teams(self) -> DataFrame:
        return raw_teams(self.spark, self.sf_dir)

    @property
    def match_details(self) -> DataFrame:
        return raw_match_details(self.spark, self.sf_dir)
