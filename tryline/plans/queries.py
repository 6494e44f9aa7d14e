"""Query registry, part 1: the mart models and their building blocks.

Keys are ``<operator id>_<name>`` (SURVEY §2). Every query reads the whole
driver tables through the fixture adapter.
"""

from __future__ import annotations

from tryline.catalog import marts_for, register
from tryline.functions.leagues import league_expr
from tryline.operators import marts, metrics, staging
from tryline.oracle import with_models
from tryline.sources.fixtures import RawTables

# --- staging -----------------------------------------------------------------


@register("c1_stg_team_stats_projection", with_models("""
SELECT team_id, team_name, match_id, opponent_team_id, opponent_team_name, game_date, season,
       tries, line_breaks, entries_22m, territory, score, opponent_score
FROM typed_rows"""))
def c1(spark, sf):
    return staging.stg_team_stats_projection(RawTables(spark, sf).team_stats)


@register("c2_null_key_filter", with_models("""
SELECT team_id, match_id, game_date, opponent_team_id FROM keyed_rows"""))
def c2(spark, sf):
    proj = staging.stg_team_stats_projection(RawTables(spark, sf).team_stats)
    return staging.null_key_filter(proj).select("team_id", "match_id", "game_date", "opponent_team_id")


@register("c3_team_game_key", with_models("""
SELECT team_game_key, team_id, match_id FROM stg_team_stats"""))
def c3(spark, sf):
    return marts_for(spark, sf).stg_team_stats.select("team_game_key", "team_id", "match_id")


@register("c4_season", with_models("""
SELECT team_game_key, game_date, season FROM stg_team_stats"""))
def c4(spark, sf):
    return marts_for(spark, sf).stg_team_stats.select("team_game_key", "game_date", "season")


@register("c5_stg_match_details", with_models("SELECT * FROM stg_match_details"))
def c5(spark, sf):
    return marts_for(spark, sf).stg_match_details


@register("f1_stg_team_stats", with_models("SELECT * FROM stg_team_stats"))
def f1(spark, sf):
    return marts_for(spark, sf).stg_team_stats


@register("h2_stg_teams", with_models("SELECT * FROM stg_teams"))
def h2(spark, sf):
    return marts_for(spark, sf).stg_teams


# --- intermediate --------------------------------------------------------------


@register("c6_scored_rows", with_models("SELECT * FROM both_scores"))
def c6(spark, sf):
    return metrics.scored_rows(marts_for(spark, sf).stg_team_stats)


@register("c7_score_difference", with_models("""
SELECT team_game_key, score, opponent_score, score - opponent_score AS score_difference
FROM both_scores"""))
def c7(spark, sf):
    return (metrics.scored_rows(marts_for(spark, sf).stg_team_stats)
            .select("team_game_key", "score", "opponent_score",
                    metrics.score_difference().alias("score_difference")))


@register("c8_winner_flag", with_models("""
SELECT team_game_key, score, opponent_score,
       coalesce(substr('LDW', 2 + CAST(sign(score - opponent_score) AS INTEGER), 1), 'D') AS winner_flag
FROM stg_team_stats"""))
def c8(spark, sf):
    return marts_for(spark, sf).stg_team_stats.select(
        "team_game_key", "score", "opponent_score", metrics.winner_flag().alias("winner_flag"))


@register("e2_complete_matches", with_models("SELECT match_id FROM full_matches"))
def e2(spark, sf):
    return metrics.complete_matches(metrics.scored_rows(marts_for(spark, sf).stg_team_stats))


@register("d1_complete_matches_semi", with_models("""
SELECT s.* FROM both_scores s WHERE s.match_id IN (SELECT match_id FROM full_matches)"""))
def d1(spark, sf):
    return metrics.complete_scored_rows(marts_for(spark, sf).stg_team_stats)


@register("d2_int_team_game_metrics", with_models("SELECT * FROM int_team_game_metrics"))
def d2(spark, sf):
    return marts_for(spark, sf).int_team_game_metrics


# --- marts ---------------------------------------------------------------------


@register("f2_fct_team_performance", with_models("SELECT * FROM fct_team_performance"))
def f2(spark, sf):
    # as published: the intermediate model is written in range pieces below the rolling windows
    return marts_for(spark, sf).fct_team_performance


@register("e1_dim_teams", with_models("SELECT * FROM dim_teams"))
def e1(spark, sf):
    return marts_for(spark, sf).dim_teams


@register("e3_match_name_pair", with_models("""
SELECT match_id, min(team_name) AS team_name_a, max(team_name) AS team_name_b
FROM fct_team_performance GROUP BY match_id"""))
def e3(spark, sf):
    return marts.match_name_pairs(marts_for(spark, sf).fct_core)


@register("d3_vw_timeseries", with_models("SELECT * FROM vw_league_score_difference_timeseries"))
def d3(spark, sf):
    return marts_for(spark, sf).vw_league_score_difference_timeseries


@register("e4_vw_league_margin", with_models("SELECT * FROM vw_league_margin_categorical"))
def e4(spark, sf):
    return marts_for(spark, sf).vw_league_margin_categorical


@register("c21_match_label", with_models("""
SELECT DISTINCT match_id, match_label FROM vw_league_score_difference_timeseries"""))
def c21(spark, sf):
    return marts_for(spark, sf).vw_league_score_difference_timeseries.select("match_id", "match_label").distinct()


# --- league mapping rules --------------------------------------------------------

def _league_query(variant):
    def q(spark, sf):
        return (marts_for(spark, sf).stg_match_details
                .select("match_id", "competition_id", "competition_name",
                        league_expr(variant).alias("league_name")))
    return q


for _key, _variant in (("c17_league_map_timeseries", "timeseries"),
                       ("c18_league_map_categorical", "categorical"),
                       ("c19_league_map_chart", "chart")):
    register(_key, with_models(f"""
SELECT d.match_id, d.competition_id, d.competition_name, l.league AS league_name
FROM stg_match_details d LEFT JOIN leagues l
  ON l.variant = '{_variant}' AND l.competition_id = d.competition_id AND l.competition_name = d.competition_name"""))(_league_query(_variant))


from tryline.plans import queries_more  # noqa: E402,F401  (registers the rest)
