"""Scalar helpers (C3, C4, C9, C10, C12, C14, C21, C25) and league rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tryline.functions import columns as C
from tryline.functions.leagues import league_expr, tile_filter


def test_strip_dot_zero_labels(spark):
    df = spark.createDataFrame([(None,), ("20240101.0",), ("2024-01-02 00:00:00",), ("7",)], "x string")
    got = [r[0] for r in df.select(C.strip_dot_zero("x")).collect()]
    assert got == ["", "20240101", "2024-01-02 00:00:00", "7"]


def test_try_date_and_double(spark):
    df = spark.createDataFrame([("20240103",), ("20240103.0",), ("2024-01-04",), ("junk",), (None,)], "x string")
    got = [r[0] for r in df.select(C.try_date("x")).collect()]
    assert got == [dt.date(2024, 1, 3), dt.date(2024, 1, 3), dt.date(2024, 1, 4), None, None]
    nums = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "x string")
    assert [r[0] for r in nums.select(C.try_double("x")).collect()] == [1.5, None, None]


def test_keys_labels_and_slugs(spark):
    df = spark.createDataFrame([("t1", "m1", dt.date(2024, 1, 2), "A", None)],
                               "team_id string, match_id string, d date, a string, b string")
    r = df.select(C.team_game_key().alias("k"), C.season_of("d").alias("s"),
                  C.match_label("d", "a", "a").alias("same"), C.match_label("d", "a", "b").alias("null_label"),
                  C.surrogate_match_id("d", "a", "b").alias("sid"),
                  C.slugify(F.lit("  European Rugby -- Champions Cup!! ")).alias("slug")).first()
    assert r["k"] == "t1-m1" and r["s"] == 2024
    assert r["same"] == "2024-01-02 | A vs A" and r["null_label"] is None
    assert r["sid"] == "2024-01-02|A|"
    assert r["slug"] == "european_rugby_champions_cup"


def test_league_rule_variants(spark):
    rows = [("83d92007", None), ("ee0c6883", "x"), (None, "Major League Rugby"), (None, "SUPER RUGBY"),
            ("877aa127", "y"), ("bc5d9ec5", "Pacific Nations Cup"), (None, "Super Rugby"), (None, None)]
    df = spark.createDataFrame(rows, "competition_id string, competition_name string")
    out = df.select(*[league_expr(v).alias(v) for v in ("timeseries", "categorical", "chart")]).collect()
    ts = [r["timeseries"] for r in out]
    cat = [r["categorical"] for r in out]
    chart = [r["chart"] for r in out]
    assert ts == ["European Rugby Challenge Cup", "European Rugby Champions Cup", "Major League Rugby",
                  "Super Rugby Pacific", "Super Rugby Pacific", None, "Super Rugby Pacific", None]
    # categorical: exact-case names, no MLR, and the Pacific Nations Cup id mapped to Super Rugby
    assert cat == ["European Rugby Challenge Cup", "European Rugby Champions Cup", None, None, None,
                   "Super Rugby Pacific", "Super Rugby Pacific", None]
    assert chart[5] == "Super Rugby Pacific" and chart[4] == "Super Rugby Pacific" and chart[7] is None
    tiles = df.where(tile_filter("Super Rugby Pacific")).count()
    assert tiles == 1  # exact names only
