"""Oracle SQL (DuckDB dialect) for the correctness gate.

Each query is written independently of the Spark code, straight from the
model definitions: the fixture adapter as CTEs, then the model SQL. Spark
column names are matched exactly; ties are broken the same way in both.
"""

from __future__ import annotations

# --- fixture adapter: driver tables -> raw.* -------------------------------
RAW_CTES = """
lines AS MATERIALIZED (
  SELECT CAST(l.l_suppkey AS VARCHAR) AS team_id, s.s_name AS team,
         CAST(l.l_orderkey AS VARCHAR) AS match_id, CAST(l.shipped AS DATE) AS game_date,
         l.l_quantity AS tries, CAST(l.l_linenumber AS DOUBLE) AS line_breaks,
         ROUND(l.l_tax * 100, 0) AS "22m_entries", NULLIF(l.l_discount, 0) AS territory,
         NULLIF(l.l_quantity, 13) AS score, l.l_linenumber, l.l_partkey, l.l_extendedprice
  FROM (SELECT *, l_shipdate AS shipped FROM lineitem
        UNION ALL SELECT *, NULL FROM lineitem WHERE l_linenumber = 7) l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
lines_latest AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY team_id, match_id
              ORDER BY game_date DESC, l_linenumber, l_partkey, l_extendedprice) AS rn
    FROM lines) t WHERE rn = 1
),
two_team AS (SELECT match_id FROM lines_latest GROUP BY match_id HAVING count(*) = 2),
opp AS MATERIALIZED (
  SELECT a.match_id, a.team_id, b.team_id AS team_vs_id, b.team AS team_vs, b.score AS team_vs_score
  FROM lines_latest a
  JOIN lines_latest b ON a.match_id = b.match_id AND a.team_id <> b.team_id
  WHERE a.match_id IN (SELECT match_id FROM two_team)
),
raw_team_stats AS MATERIALIZED (
  SELECT l.*, o.team_vs_id, o.team_vs, o.team_vs_score
  FROM lines l LEFT JOIN opp o ON l.match_id = o.match_id AND l.team_id = o.team_id
),
raw_match_details AS (
  SELECT CASE WHEN o_orderkey % 100 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN ''
              ELSE CAST(o_orderkey AS VARCHAR) END AS match_id, CAST(o_orderdate AS DATE) AS game_date,
         CAST(year(o_orderdate) AS BIGINT) AS season,
         CASE o_orderpriority WHEN '1-URGENT' THEN '83d92007' WHEN '2-HIGH' THEN 'ee0c6883'
              WHEN '3-MEDIUM' THEN '877aa127' WHEN '4-NOT SPECIFIED' THEN 'bc5d9ec5'
              WHEN '5-LOW' THEN '0ab9177f' END AS competition_id,
         CASE WHEN o_orderstatus = 'P' THEN upper(cn) ELSE cn END AS competition_name
  FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'European Rugby Challenge Cup'
              WHEN '2-HIGH' THEN 'European Rugby Champions Cup' WHEN '3-MEDIUM' THEN 'Super Rugby'
              WHEN '4-NOT SPECIFIED' THEN 'Pacific Nations Cup' WHEN '5-LOW' THEN 'Major League Rugby'
              END AS cn FROM orders) o
),
raw_teams AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS team_id, s_name AS team_name FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier
  UNION ALL SELECT NULL, 'Unattached'
)"""

# --- models ------------------------------------------------------------------
LEAGUE_RULES = """
league_rules(variant, place, part, value, league) AS (VALUES
  ('timeseries', 1, 'id', '83d92007', 'European Rugby Challenge Cup'),
  ('timeseries', 2, 'id', 'ee0c6883', 'European Rugby Champions Cup'),
  ('timeseries', 3, 'any case', 'major league rugby', 'Major League Rugby'),
  ('timeseries', 4, 'any case', 'super rugby pacific', 'Super Rugby Pacific'),
  ('timeseries', 4, 'any case', 'super rugby', 'Super Rugby Pacific'),
  ('timeseries', 4, 'id', '877aa127', 'Super Rugby Pacific'),
  ('categorical', 1, 'id', '83d92007', 'European Rugby Challenge Cup'),
  ('categorical', 2, 'id', 'ee0c6883', 'European Rugby Champions Cup'),
  ('categorical', 3, 'as is', 'Super Rugby Pacific', 'Super Rugby Pacific'),
  ('categorical', 3, 'as is', 'Super Rugby', 'Super Rugby Pacific'),
  ('categorical', 3, 'id', 'bc5d9ec5', 'Super Rugby Pacific'),
  ('chart', 1, 'id', '83d92007', 'European Rugby Challenge Cup'),
  ('chart', 2, 'id', 'ee0c6883', 'European Rugby Champions Cup'),
  ('chart', 3, 'any case', 'major league rugby', 'Major League Rugby'),
  ('chart', 4, 'any case', 'super rugby pacific', 'Super Rugby Pacific'),
  ('chart', 4, 'any case', 'super rugby', 'Super Rugby Pacific'),
  ('chart', 4, 'id', '877aa127', 'Super Rugby Pacific'),
  ('chart', 4, 'id', 'bc5d9ec5', 'Super Rugby Pacific')),
leagues AS (
  -- the first rule that fits each competition met, per variant
  SELECT variant, competition_id, competition_name, arg_min(league, place) AS league
  FROM (SELECT DISTINCT competition_id, competition_name FROM raw_match_details) c
  JOIN league_rules r ON (part = 'id' AND value = competition_id)
    OR (part = 'as is' AND value = competition_name) OR (part = 'any case' AND value = lower(competition_name))
  GROUP BY ALL
)"""

MODEL_CTES = f"""
typed_rows AS (
  SELECT team_id, team AS team_name, match_id, team_vs_id AS opponent_team_id, team_vs AS opponent_team_name,
         game_date, CAST(date_part('year', game_date) AS BIGINT) AS season, tries::DOUBLE AS tries,
         line_breaks::DOUBLE AS line_breaks, "22m_entries"::DOUBLE AS entries_22m, territory::DOUBLE AS territory,
         score::DOUBLE AS score, team_vs_score::DOUBLE AS opponent_score, l_linenumber, l_partkey, l_extendedprice
  FROM raw_team_stats
),
keyed_rows AS (
  SELECT * FROM typed_rows
  WHERE nullif(team_id, '') IS NOT NULL AND nullif(match_id, '') IS NOT NULL AND game_date IS NOT NULL
),
stg_team_stats AS (
  SELECT concat_ws('-', team_id, match_id) AS team_game_key,
         * EXCLUDE (l_linenumber, l_partkey, l_extendedprice)
  FROM keyed_rows
  QUALIFY row_number() OVER (PARTITION BY match_id, team_id
                             ORDER BY game_date DESC, l_linenumber, l_partkey, l_extendedprice) = 1
),
stg_match_details AS (SELECT * FROM raw_match_details WHERE nullif(match_id, '') IS NOT NULL),
stg_teams AS (SELECT team_id, team_name FROM raw_teams WHERE nullif(team_id, '') IS NOT NULL GROUP BY ALL),
dim_teams AS (SELECT team_id, min(team_name) AS team_name FROM stg_teams GROUP BY team_id),
both_scores AS (SELECT * FROM stg_team_stats WHERE score + opponent_score IS NOT NULL),
full_matches AS (SELECT match_id FROM both_scores GROUP BY match_id HAVING min(team_id) <> max(team_id) AND count(*) = 2),
int_team_game_metrics AS (
  SELECT g.team_game_key, g.team_id, g.team_name, g.opponent_team_id, g.opponent_team_name, g.match_id,
         g.game_date, g.season, md.competition_id, md.competition_name, g.tries, g.line_breaks, g.entries_22m,
         g.territory, g.score, g.opponent_score, g.score - g.opponent_score AS score_difference,
         substr('LDW', 2 + CAST(sign(g.score - g.opponent_score) AS INTEGER), 1) AS winner_flag
  FROM both_scores g SEMI JOIN full_matches USING (match_id)
  LEFT JOIN stg_match_details md ON md.match_id = g.match_id
),
fct_team_performance AS (
  SELECT *, avg(tries) OVER last_five AS tries_rolling_5, avg(line_breaks) OVER last_five AS line_breaks_rolling_5,
         avg(territory) OVER last_five AS territory_rolling_5
  FROM int_team_game_metrics
  WINDOW last_five AS (PARTITION BY team_id ORDER BY game_date, match_id ROWS 4 PRECEDING)
),
labelled AS (
  SELECT *, strftime(game_date, '%Y-%m-%d') || ' | ' || first_value(team_name) OVER pair || ' vs '
              || last_value(team_name) OVER pair AS match_label
  FROM fct_team_performance
  WINDOW pair AS (PARTITION BY match_id ORDER BY team_name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
vw_league_score_difference_timeseries AS (
  SELECT match_id, match_label, game_date, team_name, opponent_team_name, score_difference,
         f.competition_id, f.competition_name, l.league AS league_name
  FROM labelled f JOIN leagues l ON l.variant = 'timeseries'
    AND l.competition_id = f.competition_id AND l.competition_name = f.competition_name
),
vw_league_margin_categorical AS (
  SELECT l.league AS league_name, count(DISTINCT match_id) AS matches,
         avg(abs(score_difference)) AS avg_match_margin,
         CAST(quantile_disc(abs(score_difference), 0.5) AS DOUBLE) AS median_match_margin
  FROM fct_team_performance f JOIN leagues l ON l.variant = 'categorical'
    AND l.competition_id = f.competition_id AND l.competition_name = f.competition_name
  WHERE score_difference IS NOT NULL
  GROUP BY l.league
)"""


def with_models(body: str, extra_ctes: str = "") -> str:
    """Wrap a final SELECT with the adapter and model CTEs (+ ``extra_ctes``)."""
    extra = f",{extra_ctes}" if extra_ctes else ""
    return f"WITH {RAW_CTES},{LEAGUE_RULES},{MODEL_CTES}{extra}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH {RAW_CTES},{LEAGUE_RULES}\n{body}"
