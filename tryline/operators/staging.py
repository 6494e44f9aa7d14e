"""Staging layer: typed projections, null-key filters and dedupe.

C1-C5, F1, H2. Every function is ``DataFrame -> DataFrame`` and lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tryline.functions.columns import season_of, team_game_key


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (F1, H3).

    ``row_number() = 1`` is planned by Catalyst as a partial WindowGroupLimit
    before the shuffle and a final one after it, so even a key holding a large
    share of all rows is cut to one row per map task before it moves.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def stg_team_stats_projection(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """C1 + C4: 13 typed columns with the staging names (+ pass-through ``keep``)."""
    gd = F.col("game_date").cast("date")
    return raw.select(
        F.col("team_id").cast("string").alias("team_id"),
        F.col("team").cast("string").alias("team_name"),
        F.col("match_id").cast("string").alias("match_id"),
        F.col("team_vs_id").cast("string").alias("opponent_team_id"),
        F.col("team_vs").cast("string").alias("opponent_team_name"),
        gd.alias("game_date"),
        season_of(gd).alias("season"),
        F.col("tries").cast("double").alias("tries"),
        F.col("line_breaks").cast("double").alias("line_breaks"),
        F.col("`22m_entries`").cast("double").alias("entries_22m"),
        F.col("territory").cast("double").alias("territory"),
        F.col("score").cast("double").alias("score"),
        F.col("team_vs_score").cast("double").alias("opponent_score"),
        *keep,
    )


def null_key_filter(df: DataFrame, keys: Sequence[str] = ("game_date", "team_id", "match_id")) -> DataFrame:
    """Drop rows with a NULL in any key column (pushed to the scan).

    An empty id (an absent key in landed data, SURVEY S10) counts as missing.
    Keys are filtered, not rewritten, so an existing hash partitioning on them
    still satisfies the dedupe and the per-match steps downstream.
    """
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        if dict(df.dtypes).get(k) == "string":
            c = c & (F.col(k) != "")
        cond = c if cond is None else cond & c
    return df.where(cond)


STG_TEAM_STATS_OUT = (
    "team_game_key", "team_id", "team_name", "match_id", "opponent_team_id",
    "opponent_team_name", "game_date", "season", "tries", "line_breaks",
    "entries_22m", "territory", "score", "opponent_score",
)


def stg_team_stats(raw: DataFrame, tie_breaks: Sequence[str] = (), latest: bool = False) -> DataFrame:
    """F1 model: typed, null-key-filtered, latest row per (team_id, match_id).

    The reference orders by ``game_date desc`` only; ``tie_breaks`` (ascending)
    make the pick deterministic when dates tie (SURVEY S3/S4). ``latest`` says
    that ``raw`` was reduced to those rows when it was read.
    """
    staged = null_key_filter(stg_team_stats_projection(raw, keep=tie_breaks))
    if latest:
        return staged.select(team_game_key().alias("team_game_key"), *STG_TEAM_STATS_OUT[1:])
    order = [F.col("game_date").desc()] + [F.col(c).asc() for c in tie_breaks]
    return keep_first(staged, ["match_id", "team_id"], order).select(team_game_key().alias("team_game_key"), *STG_TEAM_STATS_OUT[1:])


def stg_match_details(raw: DataFrame) -> DataFrame:
    """Five typed columns, rows without a match id dropped."""
    typed = raw.select(
        F.col("match_id").cast("string").alias("match_id"),
        F.col("game_date").cast("date").alias("game_date"),
        F.col("season").cast("bigint").alias("season"),
        F.col("competition_id").cast("string").alias("competition_id"),
        F.col("competition_name").cast("string").alias("competition_name"),
    )
    return null_key_filter(typed, ("match_id",))


def stg_teams(raw: DataFrame) -> DataFrame:
    """H2: distinct (team_id, team_name) with a non-null id."""
    return (raw.select(F.col("team_id").cast("string").alias("team_id"),
                       F.col("team_name").cast("string").alias("team_name"))
               .where(F.col("team_id").isNotNull() & (F.col("team_id") != ""))
               .distinct())
