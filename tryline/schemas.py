"""Declared schemas for the raw, staging and fact layers."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, L = T.StringType(), T.DoubleType(), T.DateType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_TEAMS = _struct(("team_id", S), ("team_name", S))

# Modelled columns of raw.team_stats. The full source has ~59 drifting columns;
# the reader keeps any extra column it finds (union by name).
RAW_TEAM_STATS = _struct(
    ("team_id", S), ("team", S), ("team_vs_id", S), ("team_vs", S), ("match_id", S),
    ("game_date", DT), ("tries", D), ("line_breaks", D), ("22m_entries", D),
    ("territory", D), ("score", D), ("team_vs_score", D),
)

RUCK_COLUMNS = (
    "ruck_speed_0_3_pct", "ruck_speed_3_6_pct", "ruck_speed_6_plus_pct",
    "rucks_won", "rucks_total",
)

RAW_MATCH_DETAILS = _struct(
    ("match_id", S), ("game_date", DT), ("season", L),
    ("competition_id", S), ("competition_name", S),
)

STG_TEAM_STATS = _struct(
    ("team_game_key", S), ("team_id", S), ("team_name", S), ("match_id", S),
    ("opponent_team_id", S), ("opponent_team_name", S), ("game_date", DT),
    ("season", L), ("tries", D), ("line_breaks", D), ("entries_22m", D),
    ("territory", D), ("score", D), ("opponent_score", D),
)

FCT_COLUMNS = (
    "team_game_key", "team_id", "team_name", "match_id", "game_date", "season",
    "competition_id", "competition_name", "opponent_team_id", "opponent_team_name",
    "tries", "line_breaks", "entries_22m", "territory", "score", "opponent_score",
    "score_difference", "winner_flag",
    "tries_rolling_5", "line_breaks_rolling_5", "territory_rolling_5",
)

TIMESERIES_COLUMNS = (
    "match_id", "match_label", "game_date", "team_name", "opponent_team_name",
    "score_difference", "competition_id", "competition_name", "league_name",
)
