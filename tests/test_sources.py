"""File-level sources (A1-A4, A10) on temp dirs, like the reference's smoke tests."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tryline.schemas import RAW_MATCH_DETAILS, RAW_TEAM_STATS
from tryline.sources import files


def test_latest_snapshot_is_lexicographically_greatest(spark, tmp_path):
    for name in ["teams_20240101", "teams_20240201", "teams_20240115"]:
        pd.DataFrame({"team_id": [name[-2:]], "team_name": ["x"]}).to_parquet(tmp_path / f"{name}.parquet")
    path = files.latest_snapshot_path(spark, str(tmp_path), "teams_*.parquet")
    assert path.endswith("teams_20240201.parquet")
    assert files.latest_snapshot(spark, str(tmp_path), "teams_*.parquet").first()["team_id"] == "01"


def test_latest_snapshot_missing_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.latest_snapshot(spark, str(tmp_path), "teams_*.parquet")


def test_optional_snapshot_gives_typed_empty_frame(spark, tmp_path):
    df = files.optional_latest_snapshot(spark, str(tmp_path), "match_details_*.parquet", RAW_MATCH_DETAILS)
    assert df.count() == 0
    assert df.schema == RAW_MATCH_DETAILS


def _drifting_files(folder):
    # bigint score vs double score, an all-null column, a file without scores,
    # a players array, and a ruck column present in one file only
    pd.DataFrame({"team_id": ["a", "a"], "match_id": ["m1", "m2"], "game_date": ["20240101", "20240108"],
                  "score": [10, 12], "team_vs_score": [3, 12], "territory": [None, None],
                  "players": [["p1", "p2"], ["p3"]]}).to_parquet(folder / "a_20240108.parquet")
    pd.DataFrame({"team_id": ["b"], "match_id": ["m1"], "game_date": ["20240101"],
                  "score": [3.0], "team_vs_score": [10.0], "territory": [0.4],
                  "rucks_won": [12.0]}).to_parquet(folder / "b_20240101.parquet")
    pd.DataFrame({"team_id": ["c"], "match_id": ["m3"], "game_date": ["20240102"],
                  "tries": [2.0]}).to_parquet(folder / "c_20240102.parquet")


def test_read_drifting_schemas_unions_by_name(spark, tmp_path):
    _drifting_files(tmp_path)
    df = files.read_drifting(spark, str(tmp_path), RAW_TEAM_STATS)
    rows = {(r["team_id"], r["match_id"]): r for r in df.collect()}
    assert len(rows) == 4
    assert rows[("a", "m1")]["game_date"] == dt.date(2024, 1, 1)
    assert rows[("a", "m1")]["score"] == 10.0 and isinstance(rows[("a", "m1")]["score"], float)
    assert rows[("c", "m3")]["score"] is None and rows[("c", "m3")]["tries"] == 2.0
    assert rows[("b", "m1")]["rucks_won"] == 12.0 and rows[("a", "m1")]["rucks_won"] is None
    assert rows[("a", "m1")]["players"] == ["p1", "p2"]
    assert dict(df.dtypes)["territory"] == "double"


def test_footer_schemas_groups_files(spark, tmp_path):
    _drifting_files(tmp_path)
    listing = files.footers(spark, str(tmp_path))
    assert listing.count() == 3
    groups = files.schema_groups(listing)
    assert len(groups) == 3 and [g["files"] for g in groups] == [1, 1, 1] and all(g["rows"] and g["bytes"] for g in groups)


def test_large_files_are_read_by_spark_with_the_same_rows(spark, tmp_path, monkeypatch):
    _drifting_files(tmp_path)
    small = files.read_drifting(spark, str(tmp_path), RAW_TEAM_STATS, origin=True)
    want = sorted(map(str, small.select(sorted(small.columns)).collect()))
    biggest = max(p.stat().st_size for p in tmp_path.glob("*.parquet"))
    for bound in (0, biggest - 1):        # all files large, all but the biggest small
        monkeypatch.setattr(files, "SMALL_FILE", bound)
        got = files.read_drifting(spark, str(tmp_path), RAW_TEAM_STATS, origin=True)
        assert sorted(map(str, got.select(sorted(got.columns)).collect())) == want


def test_many_files_reach_the_driver_as_one_row_per_schema(spark, tmp_path):
    """A listing of 100,000 made-up paths in 3 schemas: grouped in tasks, no list of paths."""
    listing = spark.range(100_000).select(
        F.concat(F.lit("file:/landing/team_stats_"), F.col("id").cast("string")).alias("path"), F.lit(1000).cast("long").alias("length"),
        F.lit(7).cast("long").alias("rows"), F.concat(F.lit("schema "), (F.col("id") % 3).cast("string")).alias("schema"))
    groups = files.schema_groups(listing)
    assert [(g["files"], g["rows"]) for g in groups] == [(33334, 7 * 33334), (33333, 7 * 33333), (33333, 7 * 33333)]


def test_broken_landing_leaves_the_load_before(spark, tmp_path):
    """A4 before publication: an unreadable file, no usable row, a missing column -- the last good raw tables stay."""
    from tryline.plans.landing import load_raw, open_raw
    good, root = tmp_path / "good", str(tmp_path / "raw")
    good.mkdir()
    pd.DataFrame({"team_id": ["a"], "match_id": ["m"], "game_date": ["20250101"]}).to_parquet(good / "team_stats_1.parquet")
    pd.DataFrame({"team_id": ["a"], "team_name": ["A"]}).to_parquet(good / "teams_1.parquet")
    first = load_raw(spark, str(good), root, run_date="20250101")
    for name, stats in (("empty", {"team_id": ["a"], "match_id": ["m"], "game_date": ["no date"]}),
                        ("column", {"team_id": ["a"], "game_date": ["20250101"]})):
        bad = tmp_path / name
        bad.mkdir()
        pd.DataFrame(stats).to_parquet(bad / "team_stats_1.parquet")
        pd.DataFrame({"team_id": ["b"], "team_name": ["B"]}).to_parquet(bad / "teams_1.parquet")
        with pytest.raises((ValueError, KeyError)):
            load_raw(spark, str(bad), root, run_date="20250101")
        assert open_raw(spark, root).load.version == first.load.version
        assert [r["team_id"] for r in open_raw(spark, root).teams.collect()] == ["a"]
    again = load_raw(spark, str(good), root, run_date="20250101")       # the same day once more
    assert again.load.version > first.load.version
    assert open_raw(spark, root).team_stats.count() == 1


def test_union_by_name_fills_missing_with_null(spark):
    a = spark.createDataFrame([(1, 2.0)], "k long, x double")
    b = spark.createDataFrame([(2, "t")], "k long, y string")
    out = {r["k"]: r for r in files.union_by_name([a, b]).collect()}
    assert out[1]["y"] is None and out[2]["x"] is None


def test_guards(spark):
    df = spark.createDataFrame([], "match_id string")
    with pytest.raises(ValueError):
        files.require_rows(df, "team_stats")
    with pytest.raises(KeyError):
        files.require_columns(df, ["match_id", "game_date"])
    with pytest.raises(FileNotFoundError):
        files.require_files([], "/nowhere")


def test_source_registry_and_selection(spark):
    reg = files.SourceRegistry()
    reg.register("raw.teams", lambda: spark.createDataFrame([("1", "A")], "team_id string, team_name string"))
    assert reg.table("raw.teams").count() == 1
    with pytest.raises(KeyError):
        reg.table("raw.nope")

    local = lambda: (spark.createDataFrame([(1,)], "x int"),)
    missing = lambda: (spark.table("no_such_mart_view"),)
    used, frames = files.select_source("auto", missing, local)
    assert used == "local" and frames[0].count() == 1
    with pytest.raises(Exception):
        files.select_source("mart", missing, local)
    spark.createDataFrame([(2,)], "x int").createOrReplaceTempView("some_mart_view")
    used, frames = files.select_source("auto", lambda: (spark.table("some_mart_view"),), local)
    assert used == "mart"
    with pytest.raises(ValueError):
        files.select_source("bigquery", missing, local)


def test_footer_profile_matches_data_profile(spark, tmp_path):
    from tryline.operators import profile
    _drifting_files(tmp_path)
    prof = {r["column_name"]: r for r in profile.footer_column_profile(
        spark, str(tmp_path), ["score", "territory", "rucks_won", "tries"]).collect()}
    assert (prof["score"]["files_with_column"], prof["score"]["rows_where_present"],
            prof["score"]["non_null_rows"]) == (2, 3, 3)
    assert (prof["territory"]["rows_where_present"], prof["territory"]["non_null_rows"]) == (3, 1)
    assert prof["rucks_won"]["files_with_column"] == 1 and prof["tries"]["non_null_rows"] == 1
    assert all(r["total_files"] == 3 and r["stats_complete"] for r in prof.values())


def test_per_entity_snapshots(spark, tmp_path):
    import datetime as dt
    from tryline.operators.incremental import latest_date_label
    from tryline.sinks.partitioned import per_entity_snapshots
    df = spark.createDataFrame([("t1", dt.date(2024, 1, 5), 1.0), ("t1", dt.date(2024, 2, 1), 2.0),
                                ("t2", dt.date(2023, 5, 1), 3.0)], "team_id string, game_date date, score double")
    per_entity_snapshots(df, str(tmp_path / "out"), latest_date_label(df, "20260420"))
    dirs = sorted(p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").glob("*/*"))
    assert dirs == ["team_id=t1/latest_date=20240201", "team_id=t2/latest_date=20230501"]


def test_landing_run_keeps_every_row(spark, tmp_path):
    """Drifting files with dates as text, number and float text, and an undeclared column of two types."""
    from tryline.plans.landing import load_raw
    from tryline.plans.marts import MartBuild
    land = tmp_path / "landing"
    land.mkdir()
    common = {"team": ["A", "B"], "team_vs_id": ["b", "a"], "team_vs": ["B", "A"], "match_id": ["m1", "m1"]}
    pd.DataFrame({"team_id": ["a", "b"], **common, "game_date": ["20250103", "2025-01-03"], "score": ["10", "7.5"],
                  "team_vs_score": ["7.5", "10"], "rucks_won": ["12", "n/a"], "players": [["p1"], ["p2"]]}
                 ).to_parquet(land / "team_stats_1.parquet")
    pd.DataFrame({"team_id": ["a", "b"], **{**common, "match_id": ["m2", "m2"]}, "game_date": [20250110, 20250110],
                  "score": [3, 4], "team_vs_score": [4, 3], "rucks_won": [5, 6]}).to_parquet(land / "team_stats_2.parquet")
    pd.DataFrame({"team_id": ["a", "b"], **{**common, "match_id": ["m3", "m3"]}, "game_date": ["20250117.0", "20250117.0"],
                  "score": [1.0, 2.0], "team_vs_score": [2.0, 1.0]}).to_parquet(land / "team_stats_3.parquet")
    pd.DataFrame({"team_id": ["a", "b", ""], "team_name": ["A", "B", "nobody"]}).to_parquet(land / "teams_20250101.parquet")
    raw = load_raw(spark, str(land), str(tmp_path / "raw"))
    rows = raw.team_stats.collect()
    assert len(rows) == 6 and {r["game_date"] for r in rows} == {dt.date(2025, 1, 3), dt.date(2025, 1, 10), dt.date(2025, 1, 17)}
    assert sorted(str(r["rucks_won"]) for r in rows) == ["12", "5", "6", "None", "None", "n/a"]
    fact = MartBuild(raw, cut=False).fct_team_performance.collect()
    assert sorted((r["match_id"], r["team_id"], r["score_difference"]) for r in fact) == [
        ("m1", "a", 2.5), ("m1", "b", -2.5), ("m2", "a", -1.0), ("m2", "b", 1.0), ("m3", "a", -1.0), ("m3", "b", 1.0)]
    assert MartBuild(raw, cut=False).dim_teams.count() == 2


def test_landing_run_without_usable_rows_raises(spark, tmp_path):
    from tryline.plans.landing import load_raw
    pd.DataFrame({"team_id": ["a"], "match_id": ["m"], "game_date": ["not a date"]}).to_parquet(tmp_path / "team_stats_1.parquet")
    pd.DataFrame({"team_id": ["a"], "team_name": ["A"]}).to_parquet(tmp_path / "teams_1.parquet")
    with pytest.raises(ValueError):
        load_raw(spark, str(tmp_path), str(tmp_path / "raw"))
