"""Incremental landing (D5, G6, H3, H4, B5, M3), sinks (B1-B9) and the availableNow wrapper."""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
from pyspark.sql import functions as F

from tryline.operators import incremental
from tryline.schemas import RAW_MATCH_DETAILS
from tryline.sinks import writers


def _details(spark, rows):
    return spark.createDataFrame(rows, "match_id string, competition_name string")


def test_missing_ids_and_cap(spark):
    known = spark.createDataFrame([("m1",), ("m2",), ("m3",), ("m3",), (None,)], "match_id string")
    landed = _details(spark, [("m2", "x")])
    missing = incremental.missing_ids(known, landed)
    assert sorted(r[0] for r in missing.collect()) == ["m1", "m3"]
    assert [r[0] for r in incremental.capped_ids(missing, 1).collect()] == ["m1"]
    assert incremental.capped_ids(missing, 0).count() == 2


def test_first_snapshot_wins_and_upsert(spark):
    a = _details(spark, [("m1", "old"), ("m2", "old")]).withColumn("snapshot", F.lit("s_20240101"))
    b = _details(spark, [("m2", "new"), ("m3", "new")]).withColumn("snapshot", F.lit("s_20240201"))
    first = {r["match_id"]: r["competition_name"] for r in incremental.first_snapshot_wins(b.unionByName(a)).collect()}
    assert first == {"m1": "old", "m2": "old", "m3": "new"}
    up = incremental.snapshot_upsert(a.drop("snapshot"), b.drop("snapshot"))
    assert {r[0]: r[1] for r in up.collect()} == {"m1": "old", "m2": "old", "m3": "new"}
    up_new = incremental.snapshot_upsert(a.drop("snapshot"), b.drop("snapshot"), prefer="new")
    assert {r[0]: r[1] for r in up_new.collect()}["m2"] == "new"
    # idempotent: upserting the same new rows again changes nothing
    again = incremental.snapshot_upsert(up, b.drop("snapshot"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, up.collect()))


def test_latest_date_label(spark):
    df = spark.createDataFrame([("t1", dt.date(2024, 1, 5)), ("t1", dt.date(2024, 2, 1)), ("t2", None)],
                               "team_id string, game_date date")
    got = {r["team_id"]: r["latest_date"] for r in incremental.latest_date_label(df, "20260420").collect()}
    assert got == {"t1": "20240201", "t2": "20260420"}


def test_incremental_upsert_tags_and_idempotence(spark):
    old = spark.createDataFrame([("k1", 1.0), ("k2", 2.0)], "key string, v double")
    new = spark.createDataFrame([("k2", 5.0), ("k3", 3.0)], "key string, v double")
    out = {r["key"]: (r["v"], r["change_type"]) for r in incremental.incremental_upsert(old, new, "key").collect()}
    assert out == {"k1": (1.0, "kept"), "k2": (5.0, "updated"), "k3": (3.0, "inserted")}
    table = incremental.incremental_upsert(old, new, "key").drop("change_type")
    again = {r["key"]: r["change_type"] for r in incremental.incremental_upsert(table, new, "key").collect()}
    assert again == {"k1": "kept", "k2": "unchanged", "k3": "unchanged"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("m1", dt.date(2024, 1, 1), "c1"), ("m2", dt.date(2024, 1, 2), "c2")],
                               "match_id string, game_date date, competition_id string")
    writers.overwrite_table(df, str(tmp_path / "t"))
    writers.overwrite_table(df.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    path = writers.dated_snapshot(df, str(tmp_path), "match_details", "20240101")
    assert path.endswith("match_details_20240101")
    writers.export_json(df, str(tmp_path / "j"), order_by=["match_id"], limit=1)
    lines = [json.loads(x) for f in (tmp_path / "j").glob("part-*.json") for x in f.read_text().splitlines()]
    assert [x["match_id"] for x in lines] == ["m1"]
    writers.export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    back = writers.materialize(spark, df, "unit")
    assert back.count() == 2
    writers.register_view(df, "unit_view")
    assert spark.table("unit_view").count() == 2
    summary = writers.run_summary({"a": df, "b": df.limit(1)}, spark, "20240101")
    assert {r["metric"]: r["n"] for r in summary.collect()} == {"a": 2, "b": 1}


def test_available_now_incremental_upsert(spark, tmp_path):
    from tryline.streaming.incremental import incremental_details_run
    landing, table = tmp_path / "landing", tmp_path / "table"
    landing.mkdir()
    cols = [f.name for f in RAW_MATCH_DETAILS.fields]

    def land(name, rows):
        pdf = pd.DataFrame(rows, columns=cols)
        pdf["game_date"] = pd.to_datetime(pdf["game_date"]).dt.date
        pdf["season"] = pdf["season"].astype("int64")
        pdf.to_parquet(landing / name)

    land("match_details_20240101.parquet", [("m1", "2024-01-01", 2024, "c1", "A"), ("m2", "2024-01-02", 2024, "c1", "A")])
    assert incremental_details_run(spark, str(landing), RAW_MATCH_DETAILS, str(table)).count() == 2
    land("match_details_20240201.parquet", [("m2", "2024-01-02", 2024, "c1", "CHANGED"), ("m3", "2024-02-01", 2024, "c2", "B")])
    now = incremental_details_run(spark, str(landing), RAW_MATCH_DETAILS, str(table))
    assert {r["match_id"]: r["competition_name"] for r in now.collect()} == {"m1": "A", "m2": "A", "m3": "B"}  # existing wins (S15)
    # nothing new: the run processes no batch and the table's files stay
    before = sorted((str(p), p.stat().st_mtime_ns) for p in table.rglob("*.parquet"))
    assert incremental_details_run(spark, str(landing), RAW_MATCH_DETAILS, str(table)).count() == 3
    assert sorted((str(p), p.stat().st_mtime_ns) for p in table.rglob("*.parquet")) == before


def test_moved_nulls_are_an_update(spark):
    kind = "key string, a int, b int"
    old = spark.createDataFrame([("k", None, 5), ("s", 1, None)], kind)
    new = spark.createDataFrame([("k", 5, None), ("s", 1, None)], kind)
    got = {r["key"]: r["change_type"] for r in incremental.incremental_upsert(old, new, "key").collect()}
    assert got == {"k": "updated", "s": "unchanged"}


def test_lost_stream_checkpoint_loses_no_row(spark, tmp_path):
    """A new checkpoint restarts the batch numbers; the table goes on, and the first snapshot wins in a batch."""
    import shutil

    from tryline.streaming.incremental import incremental_details_run
    land, table = tmp_path / "landing", tmp_path / "table"
    land.mkdir()

    def put(name, rows):
        spark.createDataFrame(rows, RAW_MATCH_DETAILS).coalesce(1).write.parquet(str(tmp_path / "w" / name))
        part = next((tmp_path / "w" / name).glob("part-*.parquet"))
        shutil.copy(part, land / name)

    row = lambda m, name: (m, dt.date(2024, 1, 1), 2024, "c", name)
    put("match_details_20240102.parquet", [row("m1", "late"), row("m2", "x")])
    put("match_details_20240101.parquet", [row("m1", "early")])
    got = incremental_details_run(spark, str(land), RAW_MATCH_DETAILS, str(table)).collect()
    assert {r["match_id"]: r["competition_name"] for r in got} == {"m1": "early", "m2": "x"}
    (tmp_path / "table_stream").rename(tmp_path / "lost")
    put("match_details_20240103.parquet", [row("m3", "new"), row("m1", "again")])
    got = incremental_details_run(spark, str(land), RAW_MATCH_DETAILS, str(table)).collect()
    assert {r["match_id"]: r["competition_name"] for r in got} == {"m1": "early", "m2": "x", "m3": "new"}
