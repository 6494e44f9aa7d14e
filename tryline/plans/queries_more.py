"""Query registry, part 2: quality, chart datasets, profiling, landing, documents.

Inputs are the whole driver tables. Where an operator needs two snapshots or
two file groups, they are cut from a table along a natural column (line
status, order date), never by sampling.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tryline.catalog import marts_for, register
from tryline.functions import columns as C
from tryline.functions.leagues import tile_filter
from tryline.operators import charts, documents, extras, incremental, profile, quality
from tryline.oracle import with_models, with_raw
from tryline.plans import datasets as DS
from tryline.sinks.writers import drop_materialized, materialize
from tryline.sources import files
from tryline.sources.fixtures import RawTables, read_table

RUN_DATE = "20260420"

# --- data quality ----------------------------------------------------------------


@register("j1_not_null", with_models("""
SELECT * FROM stg_team_stats WHERE opponent_team_id IS NULL"""))
def j1(spark, sf):
    return quality.not_null(marts_for(spark, sf).stg_team_stats, "opponent_team_id")


@register("j2_unique", with_models("""
SELECT team_id || '-' || match_id AS team_game_key, count(*) AS n_records
FROM keyed_rows GROUP BY 1 HAVING count(*) > 1"""))
def j2(spark, sf):
    from tryline.operators.staging import null_key_filter, stg_team_stats_projection
    proj = null_key_filter(stg_team_stats_projection(RawTables(spark, sf).team_stats))
    return quality.unique(proj.select(C.team_game_key().alias("team_game_key")), "team_game_key")


@register("j3_accepted_values", with_models("""
SELECT * FROM stg_match_details
WHERE competition_name IS NOT NULL AND competition_name NOT IN
  ('European Rugby Challenge Cup', 'European Rugby Champions Cup', 'Super Rugby',
   'Pacific Nations Cup', 'Major League Rugby')"""))
def j3(spark, sf):
    from tryline.sources.fixtures import PRIORITY_COMPETITION
    names = [n for _, _, n in PRIORITY_COMPETITION]
    return quality.accepted_values(marts_for(spark, sf).stg_match_details, "competition_name", names)


@register("d6_relationship_violations", with_models("""
SELECT s.* FROM stg_team_stats s
WHERE s.match_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_match_details d WHERE d.match_id = s.match_id)"""))
def d6(spark, sf):
    m = marts_for(spark, sf)
    return quality.relationships(m.stg_team_stats, "match_id", m.stg_match_details, "match_id")


@register("j5_score_symmetry", with_models("""
SELECT match_id, count(*) AS team_rows, sum(score_difference) AS score_diff_sum
FROM (SELECT match_id, score - opponent_score AS score_difference FROM keyed_rows
      WHERE score IS NOT NULL AND opponent_score IS NOT NULL) t
GROUP BY match_id HAVING count(*) <> 2 OR abs(sum(score_difference)) > 0.000001"""))
def j5(spark, sf):
    from tryline.operators.metrics import score_difference, scored_rows
    from tryline.operators.staging import null_key_filter, stg_team_stats_projection
    # all landed rows, before the dedupe: repeated lines break the symmetry
    typed = null_key_filter(stg_team_stats_projection(RawTables(spark, sf).team_stats))
    return quality.score_symmetry(scored_rows(typed).withColumn("score_difference", score_difference()))


def _report_sql() -> str:
    parts = []
    for t in quality.declared_tests():
        head = f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.kind}' AS test, count(*) AS failures"
        if t.kind == "not_null":
            parts.append(f"{head} FROM {t.model} WHERE {t.column} IS NULL")
        elif t.kind == "unique":
            parts.append(f"{head} FROM (SELECT {t.column} FROM {t.model} WHERE {t.column} IS NOT NULL "
                         f"GROUP BY {t.column} HAVING count(*) > 1) u")
        elif t.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in t.values)
            parts.append(f"{head} FROM {t.model} WHERE {t.column} IS NOT NULL AND {t.column} NOT IN ({vals})")
        elif t.kind == "relationships":
            pm, pc = t.to
            parts.append(f"{head} FROM {t.model} c WHERE c.{t.column} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {pm} p WHERE p.{pc} = c.{t.column})")
        elif t.kind == "score_symmetry":
            parts.append(f"{head} FROM (SELECT match_id FROM {t.model} WHERE match_id IS NOT NULL "
                         f"GROUP BY match_id HAVING count(*) <> 2 OR abs(sum(score_difference)) > 0.000001) s")
    body = "\nUNION ALL\n".join(parts)
    return with_models(f"""
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
{body}) r""")


@register("j6_quality_report", _report_sql())
def j6(spark, sf):
    # the report needs the models written and tested; they are dropped with the build
    with marts_for(spark, sf) as build:
        return build.build_and_test(rolling=False)[1]


@register("e17_teams_per_match", with_models("""
SELECT teams_per_match, count(*) AS matches FROM (
  SELECT match_id, count(DISTINCT team_id) AS teams_per_match FROM stg_team_stats GROUP BY match_id) t
GROUP BY teams_per_match"""))
def e17(spark, sf):
    return quality.teams_per_match(marts_for(spark, sf).stg_team_stats)


@register("e18_inverse_violations", with_models("""
SELECT count(*) AS two_team_matches,
       count(*) FILTER (WHERE abs(diff_sum) > 0.000001) AS inverse_violations
FROM (SELECT match_id, count(*) AS n, sum(score - opponent_score) AS diff_sum
      FROM stg_team_stats GROUP BY match_id) t
WHERE n = 2"""))
def e18(spark, sf):
    return quality.inverse_violations(marts_for(spark, sf).stg_team_stats)


# --- dashboard tiles (C23, E19, G7) -----------------------------------------------

_TILES = {
    "c23_tile_challenge_cup": ("European Rugby Challenge Cup", "competition_id = '83d92007'"),
    "c23_tile_champions_cup": ("European Rugby Champions Cup", "competition_id = 'ee0c6883'"),
    "c23_tile_mlr": ("Major League Rugby", "competition_name = 'Major League Rugby'"),
    "c23_tile_super_rugby": ("Super Rugby Pacific", "competition_name IN ('Super Rugby Pacific', 'Super Rugby')"),
}
_TILE_COLS = "game_date, team_name, score_difference, competition_id, competition_name"


def _tile_query(league):
    def q(spark, sf):
        return DS.tile(marts_for(spark, sf).fct_core, league)
    return q


for _k, (_league, _pred) in _TILES.items():
    register(_k, with_models(f"SELECT {_TILE_COLS} FROM fct_team_performance WHERE {_pred}"))(_tile_query(_league))


@register("e19_tile_row_counts", with_models("SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {p}) AS {k.removeprefix('c23_tile_')}_rows" for k, (_, p) in _TILES.items())
    + " FROM fct_team_performance"))
def e19(spark, sf):
    fct = marts_for(spark, sf).fct_core
    return fct.agg(*[F.count_if(F.coalesce(tile_filter(league), F.lit(False))).alias(f"{k.removeprefix('c23_tile_')}_rows")
                     for k, (league, _) in _TILES.items()])


@register("g7_sample_200", with_models(f"""
SELECT {_TILE_COLS}, match_id FROM fct_team_performance
WHERE competition_name IN ('Super Rugby Pacific', 'Super Rugby')
ORDER BY game_date, team_name, match_id LIMIT 200"""))
def g7(spark, sf):
    fct = marts_for(spark, sf).fct_core
    return DS.sample(fct.where(tile_filter("Super Rugby Pacific")).select(*_TILE_COLS.split(", "), "match_id"),
                     ["game_date", "team_name", "match_id"], 200)


# --- mart-side chart datasets (E12, E13, E20, F5, G1, G3, G4) -----------------------

_TS = "vw_league_score_difference_timeseries"


@register("e12_team_game_counts", with_models(f"""
SELECT league_name, team_name, count(match_id) AS games FROM {_TS}
WHERE game_date IS NOT NULL AND team_name IS NOT NULL AND league_name IS NOT NULL
  AND score_difference IS NOT NULL
GROUP BY league_name, team_name"""))
def e12(spark, sf):
    return charts.team_game_counts(marts_for(spark, sf).vw_league_score_difference_timeseries)


@register("f5_top_teams_per_league", with_models(f"""
SELECT * FROM (
  SELECT league_name, team_name, count(match_id) AS games,
         row_number() OVER (PARTITION BY league_name ORDER BY count(match_id) DESC, team_name) AS team_rank
  FROM {_TS} GROUP BY league_name, team_name) t
WHERE team_rank <= 5"""))
def f5(spark, sf):
    return charts.top_teams_per_league(marts_for(spark, sf).vw_league_score_difference_timeseries, 5)


@register("g3_chart_series", with_models(f"""
SELECT league_name, team_name, game_date, match_id, score_difference FROM {_TS}"""))
def g3(spark, sf):
    return charts.chart_series(marts_for(spark, sf).vw_league_score_difference_timeseries)


@register("e13_axis_bounds", with_models(f"""
SELECT y_min, y_max, pad, least(y_min - pad, -pad) AS y_lower, greatest(y_max + pad, pad) AS y_upper
FROM (SELECT y_min, y_max, CASE WHEN y_max - y_min = 0 THEN 1.0 ELSE (y_max - y_min) * 0.08 END AS pad
      FROM (SELECT CAST(min(score_difference) AS DOUBLE) AS y_min, CAST(max(score_difference) AS DOUBLE) AS y_max
            FROM {_TS}) a) b"""))
def e13(spark, sf):
    return charts.axis_bounds(charts.chart_series(marts_for(spark, sf).vw_league_score_difference_timeseries))


@register("e20_distinct_leagues", with_models(f"SELECT DISTINCT league_name FROM {_TS}"))
def e20(spark, sf):
    return charts.distinct_leagues(marts_for(spark, sf).vw_league_score_difference_timeseries)


@register("g1_margin_ranked", with_models("SELECT * FROM vw_league_margin_categorical"))
def g1(spark, sf):
    return charts.margin_ranked(marts_for(spark, sf).vw_league_margin_categorical)


@register("g5_leagues_by_name", with_models("SELECT * FROM vw_league_margin_categorical"))
def g5(spark, sf):
    return charts.margins_by_name(marts_for(spark, sf).vw_league_margin_categorical)


@register("g9_exploratory_rows", with_models("""
SELECT * FROM stg_team_stats ORDER BY team_game_key LIMIT 50"""))
def g9(spark, sf):
    return DS.sample(marts_for(spark, sf).stg_team_stats, ["team_game_key"], 50)


@register("g4_latest_20", with_models(f"""
SELECT game_date, match_id, match_label, team_name, score_difference, league_name FROM {_TS}
ORDER BY game_date DESC, match_id, team_name LIMIT 20"""))
def g4(spark, sf):
    ts = marts_for(spark, sf).vw_league_score_difference_timeseries
    return DS.latest_rows(ts.select("game_date", "match_id", "match_label", "team_name", "score_difference",
                                    "league_name"), 20)


# --- local chart path (C13/C14, D4, C9/C10, C19, C24, C22, E6) -------------------------

_LOCAL = """
SELECT * FROM (
  SELECT b.*, b.team AS team_name, b.team_vs AS opponent_team_name,
         TRY_CAST(CAST(b.score AS VARCHAR) AS DOUBLE) - TRY_CAST(CAST(b.team_vs_score AS VARCHAR) AS DOUBLE)
           AS score_difference,
         d.competition_id, d.competition_name,
         l.league AS league_name
  FROM raw_team_stats b LEFT JOIN raw_match_details d ON b.match_id = d.match_id
  LEFT JOIN leagues l ON l.variant = 'chart' AND l.competition_id = d.competition_id
    AND l.competition_name = d.competition_name) x
WHERE game_date IS NOT NULL AND score_difference IS NOT NULL AND league_name IS NOT NULL
  AND team_name IS NOT NULL"""


def _local_rows(spark, sf):
    raw = RawTables(spark, sf)
    return charts.local_chart_rows(raw.team_stats, raw.match_details)


@register("d4_local_enrichment", with_raw("""
SELECT b.team_id, b.match_id, d.competition_id, d.competition_name
FROM raw_team_stats b LEFT JOIN raw_match_details d ON b.match_id = d.match_id"""))
def d4(spark, sf):
    raw = RawTables(spark, sf)
    return (charts.enrich_competition(charts.backfill_columns(raw.team_stats), raw.match_details)
            .select("team_id", "match_id", "competition_id", "competition_name"))


@register("c24_drop_incomplete", with_raw(f"""
SELECT team_id, match_id, game_date, team_name, score_difference, league_name FROM ({_LOCAL}) r"""))
def c24(spark, sf):
    return _local_rows(spark, sf).select("team_id", "match_id", "game_date", "team_name", "score_difference",
                                        "league_name")


@register("c22_match_label_local", with_raw(f"""
SELECT match_id, array_to_string(list_slice(list_sort(list_distinct(list(team_name))), 1, 2), ' vs ')
  AS pair_label
FROM ({_LOCAL}) r GROUP BY match_id"""))
def c22(spark, sf):
    return charts.local_match_labels(_local_rows(spark, sf))


@register("e6_local_league_margin", with_raw(f"""
SELECT league_name, count(DISTINCT match_id) AS matches, avg(abs(score_difference)) AS avg_match_margin,
       median(abs(score_difference)) AS median_match_margin
FROM ({_LOCAL}) r GROUP BY league_name"""))
def e6(spark, sf):
    return charts.local_league_margin(_local_rows(spark, sf))


@register("c19_local_timeseries", with_raw(f"""
SELECT r.match_id, trim(CAST(r.game_date AS VARCHAR) || ' | ' || l.pair_label) AS match_label, r.game_date,
       r.team_name, r.opponent_team_name, r.score_difference, r.league_name
FROM ({_LOCAL}) r
JOIN (SELECT match_id, array_to_string(list_slice(list_sort(list_distinct(list(team_name))), 1, 2), ' vs ')
        AS pair_label FROM ({_LOCAL}) r2 GROUP BY match_id) l ON r.match_id = l.match_id"""))
def c19_local(spark, sf):
    return charts.local_timeseries(_local_rows(spark, sf))


@register("c14_surrogate_match_id", with_raw("""
SELECT team_id, match_id,
       coalesce(CAST(game_date AS VARCHAR), '') || '|' || coalesce(team, '') || '|' || coalesce(team_vs, '')
         AS surrogate_match_id
FROM raw_team_stats"""))
def c14(spark, sf):
    raw = RawTables(spark, sf).team_stats
    return raw.select("team_id", "match_id",
                      C.surrogate_match_id("game_date", "team", "team_vs").alias("surrogate_match_id"))


# --- scalar coercions (C9, C10, C12, C25) -------------------------------------------

_DATE_TEXT_SQL = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'n/a' END"""


@register("c9_try_date", f"""
SELECT o_orderkey, date_text,
       coalesce(CAST(try_strptime(date_text, '%Y%m%d') AS DATE),
                CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE)) AS parsed_date
FROM (SELECT o_orderkey, {_DATE_TEXT_SQL} AS date_text FROM orders) o""")
def c9(spark, sf):
    o = read_table(spark, sf, "orders")
    text = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd"))
             .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
             .otherwise(F.lit("n/a")))
    return (o.select("o_orderkey", text.alias("date_text"))
             .withColumn("parsed_date", C.try_date("date_text")))


@register("c10_try_double", """
SELECT event_id, value_text, TRY_CAST(value_text AS DOUBLE) AS value_num
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text
      FROM events) e""")
def c10(spark, sf):
    ev = read_table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return ev.select("event_id", text.alias("value_text")).withColumn("value_num", C.try_double("value_text"))


@register("c12_strip_dot_zero", r"""
SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_quantity AS VARCHAR), '\.0$', '') AS label
FROM lineitem""")
def c12(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.strip_dot_zero("l_quantity").alias("label"))


@register("c25_slugify", """
SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_') AS text_slug,
       trim(regexp_replace(lower(lang || ' / ' || source), '[^a-z0-9]+', '_', 'g'), '_') AS source_slug
FROM documents""")
def c25(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", C.slugify("text").alias("text_slug"),
                    C.slugify(F.concat_ws(" / ", "lang", "source")).alias("source_slug"))


# --- match-detail extraction and landing (C15, D5, G6, H3, H4, B5, B6, M3) ------------

_PRIO_ID = """CASE o_orderpriority WHEN '1-URGENT' THEN '83d92007' WHEN '2-HIGH' THEN 'ee0c6883'
  WHEN '3-MEDIUM' THEN '877aa127' WHEN '4-NOT SPECIFIED' THEN 'bc5d9ec5' WHEN '5-LOW' THEN '0ab9177f' END"""
_PRIO_NAME = """CASE o_orderpriority WHEN '1-URGENT' THEN 'European Rugby Challenge Cup'
  WHEN '2-HIGH' THEN 'European Rugby Champions Cup' WHEN '3-MEDIUM' THEN 'Super Rugby'
  WHEN '4-NOT SPECIFIED' THEN 'Pacific Nations Cup' WHEN '5-LOW' THEN 'Major League Rugby' END"""


@register("c15_match_detail_row", f"""
SELECT match_id, CAST(strptime(date, '%Y%m%d') AS DATE) AS game_date, season, competition_id,
       competition AS competition_name
FROM (SELECT CAST(o.o_orderkey AS VARCHAR) AS match_id, strftime(l.l_shipdate, '%Y%m%d') AS date,
             CAST(year(o.o_orderdate) AS BIGINT) AS season, {_PRIO_ID} AS competition_id,
             {_PRIO_NAME} AS competition,
             row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber) AS rn
      FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) t
WHERE rn = 1""")
def c15(spark, sf):
    return DS.match_detail_rows(spark, sf)


_SNAP_CTES = f"""
details AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, CAST(o_orderdate AS DATE) AS game_date,
         CAST(year(o_orderdate) AS BIGINT) AS season, {_PRIO_ID} AS competition_id,
         {_PRIO_NAME} AS competition_name
  FROM orders),
snap_a AS (SELECT *, 'match_details_20240101' AS snapshot FROM details WHERE game_date < DATE '1997-01-01'),
snap_b AS (SELECT match_id, game_date, season, competition_id, upper(competition_name) AS competition_name,
                  'match_details_20240201' AS snapshot FROM details WHERE game_date >= DATE '1996-01-01')"""


@register("h3_first_snapshot_wins", f"""
WITH {_SNAP_CTES}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY snapshot) AS rn
  FROM (SELECT * FROM snap_a UNION ALL SELECT * FROM snap_b) u) t WHERE rn = 1""")
def h3(spark, sf):
    a, b = DS.detail_snapshots(spark, sf)
    return incremental.first_snapshot_wins(a.unionByName(b))


@register("h4_snapshot_upsert", f"""
WITH {_SNAP_CTES}
SELECT match_id, game_date, season, competition_id, competition_name FROM snap_a
UNION ALL
SELECT match_id, game_date, season, competition_id, competition_name FROM snap_b
WHERE match_id NOT IN (SELECT match_id FROM snap_a)""")
def h4(spark, sf):
    a, b = DS.detail_snapshots(spark, sf)
    return incremental.snapshot_upsert(a.drop("snapshot"), b.drop("snapshot"))


@register("d5_missing_match_ids", with_models("""
SELECT DISTINCT match_id FROM raw_team_stats
WHERE match_id IS NOT NULL AND match_id NOT IN (SELECT match_id FROM stg_match_details)"""))
def d5(spark, sf):
    raw = RawTables(spark, sf)
    return incremental.missing_ids(raw.team_stats, raw.match_details)


@register("g6_capped_ids", with_models("""
SELECT DISTINCT match_id FROM raw_team_stats
WHERE match_id IS NOT NULL AND match_id NOT IN (SELECT match_id FROM stg_match_details)
ORDER BY match_id LIMIT 100"""))
def g6(spark, sf):
    raw = RawTables(spark, sf)
    return incremental.capped_ids(incremental.missing_ids(raw.team_stats, raw.match_details), 100)


@register("b5_latest_date_per_team", with_raw(f"""
SELECT team_id, coalesce(strftime(max(game_date), '%Y%m%d'), '{RUN_DATE}') AS latest_date, count(*) AS rows
FROM raw_team_stats GROUP BY team_id"""))
def b5(spark, sf):
    return incremental.latest_date_label(RawTables(spark, sf).team_stats, RUN_DATE)


@register("b6_run_summary", with_models("""
SELECT 'match_ids_total' AS metric, count(DISTINCT match_id) AS value FROM raw_team_stats
UNION ALL SELECT 'match_ids_preexisting', count(DISTINCT nullif(match_id, '')) FROM raw_match_details
UNION ALL SELECT 'match_ids_to_fetch', count(*) FROM (
  SELECT DISTINCT match_id FROM raw_team_stats WHERE match_id IS NOT NULL
    AND match_id NOT IN (SELECT match_id FROM stg_match_details)) m
UNION ALL SELECT 'team_stats_rows', count(*) FROM raw_team_stats"""))
def b6(spark, sf):
    return DS.details_run_summary(RawTables(spark, sf))


_M3_CTES = """
m3_old AS (SELECT * FROM stg_team_stats WHERE game_date < DATE '1999-01-01'),
m3_new AS (SELECT team_game_key, team_id, team_name, match_id, opponent_team_id, opponent_team_name, game_date,
                  season, CASE WHEN line_breaks = 1 THEN tries + 1 ELSE tries END AS tries, line_breaks,
                  entries_22m, territory, score, opponent_score
           FROM stg_team_stats WHERE game_date >= DATE '1998-01-01')"""


@register("m3_incremental_upsert", with_models(f"""
SELECT coalesce(n.team_game_key, o.team_game_key) AS team_game_key,
       CASE WHEN n.team_game_key IS NOT NULL THEN n.tries ELSE o.tries END AS tries,
       CASE WHEN n.team_game_key IS NOT NULL THEN n.game_date ELSE o.game_date END AS game_date,
       CASE WHEN o.team_game_key IS NULL THEN 'inserted' WHEN n.team_game_key IS NULL THEN 'kept'
            WHEN o.tries IS DISTINCT FROM n.tries THEN 'updated' ELSE 'unchanged' END AS change_type
FROM m3_old o FULL OUTER JOIN m3_new n ON o.team_game_key = n.team_game_key""", _M3_CTES))
def m3(spark, sf):
    stg = marts_for(spark, sf).stg_team_stats
    old = stg.where(F.col("game_date") < F.lit("1999-01-01").cast("date"))
    new = (stg.where(F.col("game_date") >= F.lit("1998-01-01").cast("date"))
              .withColumn("tries", F.when(F.col("line_breaks") == 1, F.col("tries") + 1).otherwise(F.col("tries"))))
    return incremental.incremental_upsert(old, new, "team_game_key").select(
        "team_game_key", "tries", "game_date", "change_type")


# --- profiling and validation (A3, E7, E8, E10, E16) ----------------------------------

_GROUPS_SQL = """
old_files AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_shipdate FROM lineitem
              WHERE l_linestatus = 'F'),
new_files AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, NULLIF(l_discount, 0) AS l_discount,
                     l_tax, l_shipdate FROM lineitem WHERE l_linestatus IS DISTINCT FROM 'F')"""


@register("a3_union_by_name", f"""
WITH {_GROUPS_SQL}
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_shipdate, NULL::DOUBLE AS l_discount,
       NULL::DOUBLE AS l_tax FROM old_files
UNION ALL
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_shipdate, l_discount, l_tax FROM new_files""")
def a3(spark, sf):
    # both groups as files of one landing folder, read back by their footers
    from pyspark.sql.types import StructType
    return files.read_drifting(spark, DS.drift_files(spark, sf), StructType([])).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate", "l_discount", "l_tax")


@register("e16_column_profile", f"""
WITH {_GROUPS_SQL},
per_source AS (
  SELECT 'l_quantity' AS column_name, count(*) AS rows, count(l_quantity) AS non_null FROM old_files
  UNION ALL SELECT 'l_quantity', count(*), count(l_quantity) FROM new_files
  UNION ALL SELECT 'l_discount', count(*), count(l_discount) FROM new_files
  UNION ALL SELECT 'l_tax', count(*), count(l_tax) FROM new_files)
SELECT column_name, count(*) AS sources_with_column, sum(rows) AS rows_where_present,
       sum(non_null) AS non_null_rows, CAST(2 AS BIGINT) AS total_sources,
       round(sum(non_null) * 100.0 / sum(rows), 1) AS non_null_pct
FROM per_source GROUP BY column_name""")
def e16(spark, sf):
    # from the footers of landed files alone; a source is a group of files with one schema
    root = DS.drift_files(spark, sf)
    listing = files.footers(spark, root).select(F.col("path").alias("_path"), "schema")
    stats = materialize(spark, profile.row_group_stats(spark, root).join(listing, F.col("path") == F.col("_path")), "row_groups")
    drop_materialized(spark, [root])
    groups = stats.select("column_name", "rows", "nulls", F.col("schema").alias("path"))
    out = profile.footer_column_profile(spark, root, ["l_quantity", "l_discount", "l_tax"], stats=groups)
    return out.select("column_name", F.col("files_with_column").alias("sources_with_column"), "rows_where_present", "non_null_rows",
                      F.col("total_files").alias("total_sources"), "non_null_pct")


@register("m5_available_means", f"""
WITH {_GROUPS_SQL},
landed AS (
  SELECT l_suppkey, l_discount, l_tax, TRUE AS there FROM new_files
  UNION ALL SELECT l_suppkey, NULL, NULL, FALSE FROM old_files)
SELECT l_suppkey, count(*) AS rows,
       count(*) FILTER (WHERE NOT there) AS l_discount_absent, count(*) FILTER (WHERE there AND l_discount IS NULL) AS l_discount_null,
       round(avg(l_discount), 6) AS l_discount_mean,
       count(*) FILTER (WHERE NOT there) AS l_tax_absent, count(*) FILTER (WHERE there AND l_tax IS NULL) AS l_tax_null,
       round(avg(l_tax), 6) AS l_tax_mean
FROM landed GROUP BY l_suppkey""")
def m5(spark, sf):
    from pyspark.sql.types import StructType
    metrics = ["l_discount", "l_tax"]
    rows = files.read_drifting(spark, DS.drift_files(spark, sf), StructType([]), available=metrics)
    out = extras.available_means(rows, ["l_suppkey"], metrics)
    return out.withColumns({f"{m}_mean": F.round(f"{m}_mean", 6) for m in metrics})


@register("e10_layout_from_footers", """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS partition_value, count(*) AS rows, count(*) - count(l_suppkey) AS nulls,
       min(l_suppkey) AS min_value, max(l_suppkey) AS max_value, TRUE AS ordered
FROM lineitem GROUP BY 1""")
def e10_layout(spark, sf):
    # a size-bounded copy of the lines, described from its footers; the files of a year follow one another,
    # so at most two of them share a supplier
    root = DS.laid_out_lines(spark, sf)
    stats = materialize(spark, profile.row_group_stats(spark, root), "row_groups")
    drop_materialized(spark, [root])
    return profile.layout_summary(stats, "ship_year", "l_suppkey").select(
        "partition_value", "rows", "nulls", "min_value", "max_value", (F.col("depth") <= 2).alias("ordered"))


@register("e7_row_counts", with_raw("""
SELECT 'teams' AS table_name, count(*) AS row_count FROM raw_teams
UNION ALL SELECT 'team_stats', count(*) FROM raw_team_stats
UNION ALL SELECT 'match_details', count(*) FROM raw_match_details"""))
def e7(spark, sf):
    raw = RawTables(spark, sf)
    return profile.row_counts({"teams": raw.teams, "team_stats": raw.team_stats, "match_details": raw.match_details})


@register("e8_date_bounds", with_raw("""
SELECT min(game_date) AS min_game_date, max(game_date) AS max_game_date, count(DISTINCT team_id) AS distinct_teams
FROM raw_team_stats"""))
def e8(spark, sf):
    return profile.date_bounds(RawTables(spark, sf).team_stats)


@register("e10_conditional_agg_ordered_array", with_models("""
SELECT match_id, max(CASE WHEN line_breaks = 1 THEN team_id END) AS flagged_value,
       list(team_id ORDER BY line_breaks, team_id) FILTER (WHERE territory IS NOT NULL) AS ordered_values
FROM stg_team_stats GROUP BY match_id"""))
def e10(spark, sf):
    # over staged rows (one per team and match), so an array holds at most the
    # teams of one match however many copies the raw data has
    stg = marts_for(spark, sf).stg_team_stats
    return profile.conditional_first_and_ordered_list(stg, "match_id", F.col("line_breaks") == 1, "team_id",
                                                      "line_breaks", F.col("territory").isNotNull())


# --- documents (A9, C11, C16, E14) --------------------------------------------------


@register("a9_json_array_join", """
SELECT event_id, 'Name: event-' || event_id || chr(10) || 'Types: ' || event_type || ', k'
       || json_extract_string(props, '$.k') AS details
FROM events""")
def a9(spark, sf):
    return DS.event_records(spark, sf).select("event_id", documents.json_array_join("doc").alias("details"))


@register("c16_keep_columns_default", """
SELECT event_id,
       CASE WHEN json_exists(props, '$.k') THEN json_extract_string(props, '$.k') ELSE 'N/A' END AS k,
       CASE WHEN json_exists(props, '$.brand') THEN json_extract_string(props, '$.brand') ELSE 'N/A' END AS brand
FROM events""")
def c16(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", *documents.keep_columns_default("props", ["k", "brand"]))


@register("c11_serialize_nested", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) e""")
def c11(spark, sf):
    # engines print floats differently: the text is compared by the values it holds
    text = documents.serialize_nested(read_table(spark, sf, "embeddings"))
    back = text.select("vec_id", F.posexplode(F.from_json("embedding", "array<float>")).alias("pos", "value"))
    return back.withColumn("value", F.col("value").cast("double"))


@register("e14_avg_by_brand", """
SELECT p_brand, round(avg(p_retailprice), 2) AS avg_price FROM part GROUP BY p_brand""")
def e14(spark, sf):
    return documents.avg_by_group(read_table(spark, sf, "part"), "p_brand", "p_retailprice")


# --- planned extras (M1, M2, M4) ------------------------------------------------------


@register("m1_monthly_averages", with_models("""
SELECT team_id, team_name, CAST(date_trunc('month', game_date) AS DATE) AS month, avg(tries) AS avg_tries,
       avg(line_breaks) AS avg_line_breaks, count(*) AS games
FROM fct_team_performance GROUP BY ALL"""))
def m1(spark, sf):
    return extras.monthly_averages(marts_for(spark, sf).fct_core)


@register("m2_team_season_averages", with_models("""
SELECT team_id, team_name, season, avg(territory) AS avg_territory, avg(entries_22m) AS avg_entries_22m,
       count(*) AS games
FROM fct_team_performance GROUP BY ALL"""))
def m2(spark, sf):
    return extras.team_season_averages(marts_for(spark, sf).fct_core)


@register("m4_freshness", with_models(f"""
SELECT max_game_date, row_count, age_days, coalesce(age_days <= 4000, false) AS is_fresh,
       row_count >= 1000 AS has_min_rows
FROM (SELECT max(game_date) AS max_game_date, count(*) AS row_count,
             date_diff('day', max(game_date), DATE '{RUN_DATE[:4]}-{RUN_DATE[4:6]}-{RUN_DATE[6:]}') AS age_days
      FROM fct_team_performance) t"""))
def m4(spark, sf):
    run = f"{RUN_DATE[:4]}-{RUN_DATE[4:6]}-{RUN_DATE[6:]}"
    return extras.freshness(marts_for(spark, sf).fct_core, run, max_age_days=4000, min_rows=1000)

