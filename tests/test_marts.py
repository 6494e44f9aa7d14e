"""Mart chain properties (F1, D1, C7, F2-F4, E4) and FIXTURES checkpoint counts at sf0.001."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tryline.operators import marts


def test_checkpoint_counts(marts):
    # every line, and line 7 of an order once more without a date
    twice = marts.raw.table("lineitem").where("l_linenumber = 7").count()
    assert marts.raw.team_stats.count() == 6000 + twice
    assert marts.stg_team_stats.count() == 4951
    assert marts.int_team_game_metrics.count() == 564
    assert marts.fct_team_performance.where(F.col("competition_id").isNull()).count() == 20
    assert marts.fct_team_performance.where(F.col("winner_flag") == "D").count() == 14


def test_f1_one_row_per_key(marts):
    stg = marts.stg_team_stats
    assert stg.groupBy("team_id", "match_id").count().where("count > 1").count() == 0


def test_d1_two_rows_per_match_and_symmetry(marts):
    fct = marts.fct_team_performance
    per = fct.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.sum("score_difference").alias("s"))
    assert per.where("n != 2").count() == 0
    assert per.where(F.abs("s") > 1e-9).count() == 0


def test_rolling_first_row_equals_value(marts):
    fct = marts.fct_team_performance
    w = F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window
                            .partitionBy("team_id").orderBy("game_date", "match_id"))
    first = fct.withColumn("rn", w).where("rn = 1")
    assert first.where(F.col("tries_rolling_5") != F.col("tries")).count() == 0


def test_margin_view_values(marts):
    rows = {r["league_name"]: r for r in marts.vw_league_margin_categorical.collect()}
    assert {k: r["matches"] for k, r in rows.items()} == {
        "European Rugby Challenge Cup": 45, "European Rugby Champions Cup": 51, "Super Rugby Pacific": 106}
    assert rows["European Rugby Challenge Cup"]["avg_match_margin"] == pytest.approx(17.5556, abs=1e-4)
    exact = {r["league_name"]: r["median_match_margin"]
             for r in marts_exact(marts).collect()}
    assert exact == {"European Rugby Challenge Cup": 14.0, "European Rugby Champions Cup": 19.0,
                     "Super Rugby Pacific": 17.0}


def marts_exact(m):
    return marts.vw_league_margin_categorical(m.fct_team_performance, exact=True)


def test_timeseries_counts(marts):
    got = {r["league_name"]: r["count"] for r in
           marts.vw_league_score_difference_timeseries.groupBy("league_name").count().collect()}
    assert got == {"European Rugby Challenge Cup": 90, "European Rugby Champions Cup": 102,
                   "Major League Rugby": 110, "Super Rugby Pacific": 126}


def _team_rows():
    """One team holds most rows, thousands of them in one month and hundreds on one day; others are sparse."""
    rows, start = [], dt.date(2020, 1, 1)
    for i in range(4000):
        day = dt.date(2021, 5, 1) + dt.timedelta(days=i % 28 if i % 10 else 13)
        rows.append(("hot", f"m{i:05d}", day, float(i % 7) / 3, float(i), None if i % 5 == 0 else 0.1 * i))
    for i in range(300):
        rows.append(("hot", f"s{i:04d}", start + dt.timedelta(days=i * 3), float(i % 7), 0.1 * i, None))
    for t in range(9):
        for i in range(t):
            rows.append((f"cold{t}", f"c{i}", start + dt.timedelta(days=i * 90), float(i), 1.0, 0.5))
    return rows


SCHEMA = "team_id string, match_id string, game_date date, tries double, line_breaks double, territory double"


@pytest.mark.parametrize("pieces", [1, 8, 40])
def test_pieces_equal_the_single_window_bit_by_bit(spark, tmp_path, pieces):
    df = spark.createDataFrame(_team_rows(), SCHEMA).repartition(6)
    marts.range_pieces(df, pieces=pieces).write.parquet(str(tmp_path / "p"))
    table = spark.read.parquet(str(tmp_path / "p"))
    order = ("team_id", "game_date", "match_id")
    plain = marts.rolling_means(df).orderBy(*order).collect()
    split = marts.rolling_means_of_pieces(table).orderBy(*order).collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in split]
    if pieces > 1:
        # the hot month is spread: its largest window is about one piece, not the month
        month = table.where("team_id = 'hot' and game_date >= '2021-05-01'").groupBy(marts.PIECE).count()
        sizes = [r["count"] for r in month.collect()]
        assert len(sizes) > pieces // 2 and max(sizes) < 2.5 * 4340 / pieces


def test_pieces_smaller_than_the_frame(spark, tmp_path):
    """Thirty pieces of one or two rows of one key: the halo comes from several pieces before."""
    rows = [("t" if i % 9 else None, f"m{i:02d}", dt.date(2024, 1, 1), float(i), 1.0 / (i + 1), None) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    marts.range_pieces(df, pieces=30).write.parquet(str(tmp_path / "p"))
    table = spark.read.parquet(str(tmp_path / "p"))
    assert table.select(marts.PIECE).distinct().count() > 20
    plain = marts.rolling_means(df).orderBy("match_id").collect()
    split = marts.rolling_means_of_pieces(table).orderBy("match_id").collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in split]


def test_build_drops_what_it_wrote(spark, tmp_path):
    import glob

    from tryline.plans.marts import MartBuild
    from tryline.sources.fixtures import RawTables
    with MartBuild(RawTables(spark, "/root/testdata/sf0.001"), pieces=4) as build:
        assert build.fct_team_performance.count() == 564
        kept = list(build.written)
        assert len(kept) == 1 and glob.glob(kept[0].removeprefix("file:") + "/part-*")
    assert not glob.glob(kept[0].removeprefix("file:"))
