"""The details refresh (D5, G6, H4, C15, B6) and post-load validation (E7-E11, B7) as whole runs over files."""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tryline.plans.landing import load_raw
from tryline.plans.refresh import Refresh, refresh_details
from tryline.plans.validation import validate_load
from tryline.sinks import publication
from tryline.sinks.publication import current
from tryline.sinks.writers import MATERIALIZED

ANSWER = "match_id string, date string, season long, competition_id string, competition string, error string, row int"


def _provider(spark, broken=(), silent=(), log=None):
    """Two rows per id, the first of which counts; some ids fail."""
    def fetch(ids):
        asked = sorted(r["match_id"] for r in ids.collect())
        if log is not None:
            log.append(asked)
        rows = []
        for m in asked:
            if m in silent:
                continue
            if m in broken:
                rows.append((m, None, None, None, None, "HTTP 500", 1))
                continue
            rows += [(m, "2024-02-01", 2024, "c1", "Cup late", None, 2), (m, "2024-01-01", None, "c1", "Cup", None, 1)]
        return spark.createDataFrame(rows, ANSWER)
    return fetch


def _known(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "match_id string")


def test_refresh_takes_up_what_failed(spark, tmp_path):
    root, log, before = str(tmp_path / "details"), [], list(MATERIALIZED)
    known = _known(spark, "m1", "m2", "m2", "m3", "m4", None, "")
    first = refresh_details(spark, known, _provider(spark, broken={"m2"}, silent={"m3"}, log=log), root, "20240101")
    assert log == [["m1", "m2", "m3", "m4"]]
    rows = {r["match_id"]: r for r in first.details.collect()}
    assert sorted(rows) == ["m1", "m4"] and rows["m1"]["game_date"] == dt.date(2024, 1, 1)
    assert rows["m1"]["season"] is None and rows["m1"]["competition_name"] == "Cup"      # a null season stays null
    assert sorted(map(tuple, first.failures.collect())) == [("m2", "HTTP 500", 1), ("m3", "not returned", 1)]
    s = first.summary.first()
    assert (s["match_ids_total"], s["team_stats_rows"], s["match_ids_preexisting"], s["processed"], s["succeeded"], s["failed"]) == (4, 7, 0, 4, 2, 2)
    assert [tuple(f) for f in s["failures"]] == [("m2", "HTTP 500"), ("m3", "not returned")]
    # a cap: a new id goes before ids that failed already, and those wait in the ledger
    second = refresh_details(spark, _known(spark, "m1", "m2", "m3", "m4", "m9"), _provider(spark, log=log), root, "20240101", max_ids=2)
    assert log[1] == ["m2", "m9"]
    assert sorted(map(tuple, second.failures.collect())) == [("m3", "not returned", 1)]
    third = refresh_details(spark, known, _provider(spark, broken={"m3"}, log=log), root, "20240102")
    assert log[2] == ["m3"] and [tuple(f) for f in third.failures.collect()] == [("m3", "HTTP 500", 2)]
    assert third.details.count() == 4 and third.summary.first()["match_ids_preexisting"] == 4
    assert MATERIALIZED == before


def test_refresh_that_dies_asks_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "details")
    first = refresh_details(spark, _known(spark, "m1"), _provider(spark), root, "20240101")

    def die(*args):
        raise RuntimeError("killed")
    monkeypatch.setattr(publication, "_put", die)
    with pytest.raises(RuntimeError):
        refresh_details(spark, _known(spark, "m1", "m2"), _provider(spark), root, "20240101")
    monkeypatch.undo()
    assert current(spark, root).version == first.run.version
    log = []
    last = refresh_details(spark, _known(spark, "m1", "m2"), _provider(spark, log=log), root, "20240101")
    assert log == [["m2"]] and Refresh(current(spark, root)).details.count() == 2 == last.details.count()


def test_summary_lists_the_first_failures_and_the_ledger_all(spark, tmp_path):
    known = spark.range(300).select(F.format_string("m%03d", "id").alias("match_id"))
    silent = {f"m{i:03d}" for i in range(300)}
    run = refresh_details(spark, known, _provider(spark, silent=silent), str(tmp_path / "d"), "20240101")
    s = run.summary.first()
    assert s["failed"] == 300 == run.failures.count() and [f["match_id"] for f in s["failures"]] == [f"m{i:03d}" for i in range(200)]
    assert run.details.count() == 0


def test_validation_of_a_load(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    for k in range(3):
        pd.DataFrame({"team_id": [f"t{k}", "t9"], "match_id": [f"m{k}", f"m{k}"], "game_date": [f"2024010{k + 1}"] * 2, "score": [1.0, 2.0]}
                     ).to_parquet(land / f"team_stats_{k}.parquet")
    pd.DataFrame({"team_id": ["t0", "t9"], "team_name": ["A", "B"]}).to_parquet(land / "teams_20240101.parquet")
    raw = load_raw(spark, str(land), str(tmp_path / "raw"), run_date="20240105")
    done = validate_load(spark, raw.load, str(tmp_path / "checks"))
    assert {r["table_name"]: r["row_count"] for r in done.results["row_counts"].collect()} == {"team_stats": 6, "teams": 2, "match_details": 0}
    assert done.problems == ["match_details is empty"]
    bounds = done.results["date_bounds"].first()
    assert (str(bounds["min_game_date"]), str(bounds["max_game_date"]), bounds["distinct_teams"]) == ("2024-01-01", "2024-01-03", 4)
    layout = {r["partition_value"]: (r["files"], r["rows"], r["min_value"], r["max_value"], r["depth"])
              for r in done.results["layout"].where("table_name = 'team_stats'").collect()}
    assert layout == {f"2024-01-0{k + 1}": (1, 2, f"t{k}", "t9", 1) for k in range(3)}
    out = [json.loads(line) for f in sorted((tmp_path / "checks" / "inventory").glob("part-*")) for line in f.read_text().splitlines()]
    assert {r["table_name"] for r in out} == {"team_stats", "teams", "match_details"}
    assert [r["column_name"] for r in out if r["table_name"] == "teams"][:2] == ["team_id", "team_name"]
