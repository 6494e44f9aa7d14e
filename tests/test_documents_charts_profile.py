"""Documents (A6-A9, C11, C16, E14), chart datasets (C13-C24, D4, E6, E12, E13, F5, G*),
profiles (E7-E11, E16)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tryline.operators import charts, documents, profile


def test_serialize_nested_cells(spark):
    df = spark.createDataFrame([("a", [1, 2], {"k": "v"}, 10)], "plain string, list_col array<int>, "
                               "dict_col map<string,string>, num int")
    r = documents.serialize_nested(df).first()
    assert r["plain"] == "a" and r["num"] == 10
    assert json.loads(r["list_col"]) == [1, 2] and json.loads(r["dict_col"]) == {"k": "v"}


def test_serialize_embeddings_round_trip(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = documents.serialize_nested(emb)
    assert dict(out.dtypes)["embedding"] == "string"
    back = out.select("vec_id", F.from_json("embedding", "array<float>").alias("e"))
    diff = back.join(emb, "vec_id").where(F.col("e") != F.col("embedding")).count()
    assert diff == 0


def test_json_document_scans_and_defaults(spark, tmp_path):
    doc = {"products": [{"brand": "A", "price": 10.0, "title": "x"}, {"brand": "A", "price": 20.0},
                        {"price": 5.0}, {"brand": "B", "price": None}]}
    (tmp_path / "data.json").write_text(json.dumps(doc))
    products = documents.read_json_document(spark, str(tmp_path / "data.json"), "products")
    assert products.count() == 4
    as_text = products.select(F.to_json(F.struct(*[F.col(c) for c in products.columns])).alias("j"))
    kept = as_text.select(*documents.keep_columns_default("j", ["brand", "price"]))
    rows = kept.collect()
    assert [r["brand"] for r in rows] == ["A", "A", "N/A", "B"]
    (tmp_path / "products.json").write_text(json.dumps([{"brand": r["brand"], "price": r["price"]} for r in rows]))
    inferred = documents.read_json_records(spark, str(tmp_path / "products.json"))
    assert set(inferred.columns) == {"brand", "price"}


def test_inline_rows_text_order(spark):
    rows = [("Row filters", "0.10"), ("Column masks", "0.17"), ("Audit log", "0.16")]
    df = documents.inline_rows(spark, rows, "name string, release_version string", ["release_version"])
    assert [r[1] for r in df.collect()] == ["0.10", "0.16", "0.17"]


def test_json_array_join(spark):
    rec = {"name": "falcon", "types": [{"type": {"name": "air"}}, {"type": {"name": "fast"}}]}
    df = spark.createDataFrame([(json.dumps(rec),)], "j string")
    assert df.select(documents.json_array_join("j")).first()[0] == "Name: falcon\nTypes: air, fast"


def test_avg_by_group(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("B", 4.0)], "brand string, price double")
    assert [tuple(r) for r in documents.avg_by_group(df, "brand", "price").collect()] == [("B", 4.0), ("A", 1.5)]


def test_local_chart_path_backfills_and_enriches(spark):
    base = spark.createDataFrame(
        [("t1", "Alpha", "Beta", "2024-01-01", "10", "3"), ("t2", "Beta", "Alpha", "2024-01-01", "3", "10"),
         ("t3", "Gamma", None, "junk", "1", "2")],
        "team_id string, team string, team_vs string, game_date string, score string, team_vs_score string")
    details = spark.createDataFrame([("2024-01-01|Alpha|Beta", "83d92007", "x"), ("2024-01-01|Alpha|Beta", "83d92007", "dup")],
                                    "match_id string, competition_id string, competition_name string")
    filled = charts.backfill_columns(base)
    assert {"team_name", "opponent_team_name", "score_difference", "match_id"} <= set(filled.columns)
    rows = charts.local_chart_rows(base, details)
    got = {r["team_id"]: (r["league_name"], r["score_difference"]) for r in rows.collect()}
    assert got == {"t1": ("European Rugby Challenge Cup", 7.0)}  # t2 has another surrogate id, t3 bad date
    ts = charts.local_timeseries(rows).first()
    assert ts["match_label"] == "2024-01-01 | Alpha"
    margin = charts.local_league_margin(rows).first()
    assert (margin["matches"], margin["avg_match_margin"], margin["median_match_margin"]) == (1, 7.0, 7.0)


def test_chart_series_topn_and_bounds(marts):
    ts = marts.vw_league_score_difference_timeseries
    top = charts.top_teams_per_league(ts, 2)
    assert top.groupBy("league_name").count().where("count > 2").count() == 0
    all_teams = charts.top_teams_per_league(ts, None).count()
    assert all_teams == charts.top_teams_per_league(ts, 0).count() == charts.team_game_counts(ts).count()
    series = charts.chart_series(ts, 2)
    assert series.join(top.select("league_name", "team_name"), ["league_name", "team_name"], "left_anti").count() == 0
    b = charts.axis_bounds(series).first()
    assert b["y_lower"] <= min(-b["pad"], b["y_min"] - b["pad"]) + 1e-9 and b["y_upper"] >= b["pad"]
    assert [r[0] for r in charts.distinct_leagues(ts).collect()] == sorted(r[0] for r in charts.distinct_leagues(ts).collect())


def test_profiles(spark, marts):
    raw = marts.raw
    counts = {r["table_name"]: r["row_count"] for r in profile.row_counts({"teams": raw.teams, "team_stats": raw.team_stats}).collect()}
    n_sup = raw.table("supplier").count()
    assert counts == {"teams": 2 * n_sup + 1, "team_stats": raw.table("lineitem").selectExpr("sum(if(l_linenumber = 7, 2, 1))").first()[0]}
    b = profile.date_bounds(raw.team_stats).first()
    assert b["min_game_date"] <= b["max_game_date"]
    a = spark.createDataFrame([(1.0, None), (None, None)], "x double, y double")
    c = spark.createDataFrame([(2.0,)], "x double")
    prof = {r["column_name"]: r for r in profile.column_profile({"a": a, "c": c}, ["x", "y"]).collect()}
    assert (prof["x"]["sources_with_column"], prof["x"]["rows_where_present"], prof["x"]["non_null_rows"]) == (2, 3, 2)
    assert (prof["y"]["sources_with_column"], prof["y"]["non_null_rows"], prof["y"]["non_null_pct"]) == (1, 0, 0.0)
    meta = profile.column_metadata(spark, marts.fct_team_performance).collect()
    assert len(meta) == 21 and meta[0]["column_name"] == "team_game_key"
    marts.fct_team_performance.limit(1).createOrReplaceTempView("fct_team_performance")
    inv = profile.table_inventory(spark, ["fct_team_performance", "dim_teams"]).collect()
    assert [r["table_name"] for r in inv] == ["fct_team_performance"]


@pytest.mark.parametrize("key", ["e4_vw_league_margin"])
def test_entry_smoke(spark, key):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["league_name", "matches", "avg_match_margin", "median_match_margin"]
    assert df.count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_daily_run(spark, tmp_path):
    from tryline.plans.daily import run_daily
    from tryline.sinks import writers
    from tryline.sources.fixtures import RawTables
    before = list(writers.MATERIALIZED)
    res = run_daily(spark, RawTables(spark, "/root/testdata/sf0.001"), str(tmp_path / "marts"),
                    str(tmp_path / "charts"), "20260420", source="auto", max_teams=3)
    assert res.source == "mart"
    assert writers.MATERIALIZED == before  # this run's intermediate tables are gone
    from tryline.sinks.publication import current
    published = current(spark, str(tmp_path / "marts"))
    assert published.version.startswith("20260420-0001-") and published.read("fct_team_performance").count() == 564
    assert res.report.where("failures > 0").count() == 0
    assert res.charts.read("league_margin_categorical").count() == 3
    assert current(spark, str(tmp_path / "charts")).version == res.charts.version
    summary = {r["metric"]: r["n"] for r in res.summary.collect()}
    assert summary["categorical_rows"] == 3 and summary["timeseries_rows"] == 428
    local = run_daily(spark, RawTables(spark, "/root/testdata/sf0.001"), str(tmp_path / "marts2"),
                      str(tmp_path / "charts2"), "20260420", source="local")
    assert local.source == "local" and local.categorical.count() == 4
    # the local source opens and publishes no mart
    assert local.report is None and not (tmp_path / "marts2").exists()


def test_auto_falls_back_without_fresh_marts(spark, tmp_path):
    from tryline.plans.daily import build_marts, chart_datasets
    from tryline.sources.fixtures import RawTables
    raw = RawTables(spark, "/root/testdata/sf0.001")
    marts_root, out = str(tmp_path / "marts"), str(tmp_path / "charts")
    assert chart_datasets(spark, raw, marts_root, out, "20260420").source == "local"      # nothing published yet
    build_marts(spark, raw, marts_root, "20260420")
    assert chart_datasets(spark, raw, marts_root, out, "20260420").source == "mart"
    # the newest match is decades old by then
    assert chart_datasets(spark, raw, marts_root, out, "20260420", max_age_days=30).source == "local"
    with pytest.raises(FileNotFoundError):
        chart_datasets(spark, raw, marts_root, out, "20260420", source="mart", max_age_days=30)
