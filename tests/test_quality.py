"""Data tests J1-J6 with a negative case each, plus E17/E18."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tryline.operators import quality


def test_all_declared_tests_pass_on_marts(marts):
    tests = quality.declared_tests()
    assert len(tests) == 29
    report = quality.quality_report(marts.models())
    assert report.count() == 29
    quality.gate(report)  # raises on any failure


def test_not_null_unique_accepted_relationship_negatives(spark):
    df = spark.createDataFrame([("a", "W"), ("a", "X"), (None, "D")], "k string, flag string")
    assert quality.not_null(df, "k").count() == 1
    assert quality.unique(df, "k").first()["n_records"] == 2
    assert quality.accepted_values(df, "flag", ["W", "L", "D"]).count() == 1
    parent = spark.createDataFrame([("b",)], "k string")
    assert quality.relationships(df, "k", parent, "k").count() == 2  # nulls are ignored


def test_symmetry_negative_after_removing_a_row(marts):
    fct = marts.fct_team_performance
    one = fct.select("team_game_key").orderBy("team_game_key").first()[0]
    broken = fct.where(F.col("team_game_key") != one)
    assert quality.score_symmetry(fct).count() == 0
    assert quality.score_symmetry(broken).count() == 1


def test_gate_raises(spark, marts):
    models = marts.models()
    models["dim_teams"] = models["dim_teams"].unionByName(models["dim_teams"].limit(1))
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.quality_report(models))


def test_completeness_profiles(marts):
    dist = {r["teams_per_match"]: r["matches"] for r in quality.teams_per_match(marts.stg_team_stats).collect()}
    assert dist[1] == 126 and dist[2] == 294 and dist[3] == 399
    inv = quality.inverse_violations(marts.stg_team_stats).first()
    assert inv["inverse_violations"] == 0


def test_report_by_observation_equals_the_lazy_report(spark, marts):
    """One build with the row tests counted by its writes, the same 29 rows, and no folder left."""
    import glob

    from tryline.plans.marts import MartBuild
    with MartBuild(marts.raw) as build:
        _, report = build.build_and_test(rolling=False)
        kept = [p.removeprefix("file:") for p in build.written]
        assert kept and all(glob.glob(f"{p}/*.parquet") for p in kept)
    assert not any(glob.glob(p) for p in kept)
    lazy = quality.quality_report(marts.models())
    assert sorted(map(tuple, report.select(lazy.columns).collect())) == sorted(map(tuple, lazy.collect()))


def test_observed_and_remaining_tests_count_violations(spark, tmp_path):
    T = quality.Test
    tests = [T("m", "k", "not_null"), T("m", "flag", "accepted_values", values=("W", "L")), T("m", "k", "unique"),
             T("m", "k", "relationships", to=("p", "id"))]
    df = spark.createDataFrame([("a", "W"), ("a", "X"), (None, None), ("b", "D"), ("c", "L"), ("c", "L"), ("c", "L")], "k string, flag string")
    observed, seen = quality.observe_row_tests(df, tests[:2])
    observed.write.parquet(str(tmp_path / "m"))
    assert quality.observed_failures(seen, tests[:2]) == {tests[0]: 1, tests[1]: 2}
    models = {"m": spark.read.parquet(str(tmp_path / "m")), "p": spark.createDataFrame([("a",), ("b",)], "id string")}
    assert quality.remaining_failures(models, tests) == {tests[0]: 1, tests[1]: 2, tests[2]: 2, tests[3]: 3}
    empty = {n: d.limit(0) for n, d in models.items()}
    assert set(quality.remaining_failures(empty, tests).values()) == {0}
    nothing, seen = quality.observe_row_tests(models["m"].where("k = 'none'"), tests[:2])
    nothing.write.parquet(str(tmp_path / "none"))
    assert set(quality.observed_failures(seen, tests[:2]).values()) == {0}
