"""Planned analytics from the design notes (M1, M2, M4, M5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_averages(fct: DataFrame) -> DataFrame:
    """M1: average tries and line breaks per team and month."""
    return (fct.groupBy("team_id", "team_name", F.trunc("game_date", "month").alias("month"))
               .agg(F.avg("tries").alias("avg_tries"), F.avg("line_breaks").alias("avg_line_breaks"),
                    F.count(F.lit(1)).alias("games")))


def team_season_averages(fct: DataFrame) -> DataFrame:
    """M2: average territory and 22m entries per team and season."""
    return (fct.groupBy("team_id", "team_name", "season")
               .agg(F.avg("territory").alias("avg_territory"), F.avg("entries_22m").alias("avg_entries_22m"),
                    F.count(F.lit(1)).alias("games")))


def freshness(df: DataFrame, run_date: str, max_age_days: int, min_rows: int,
              date_col: str = "game_date") -> DataFrame:
    """M4: latest date, row count, age in days against ``run_date`` and the
    two pass/fail flags, in one aggregate."""
    agg = df.agg(F.max(date_col).alias("max_game_date"), F.count(F.lit(1)).alias("row_count"))
    age = F.datediff(F.to_date(F.lit(run_date)), F.col("max_game_date"))
    return (agg.withColumn("age_days", age)
               .withColumn("is_fresh", F.coalesce(F.col("age_days") <= max_age_days, F.lit(False)))
               .withColumn("has_min_rows", F.col("row_count") >= min_rows))


def available_means(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """M5: per ``keys`` and metric, rows whose file lacks the column (``_absent``), rows where it is NULL
    (``_null``), and the mean of the rest; NULL means that no file had a value, not zero.

    ``df`` comes from ``read_drifting(..., available=metrics)``.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for m in metrics:
        there = F.col(f"{m}_available")
        aggs += [F.count_if(~there).alias(f"{m}_absent"), F.count_if(there & F.col(m).isNull()).alias(f"{m}_null"), F.avg(m).alias(f"{m}_mean")]
    return df.groupBy(*keys).agg(*aggs)
