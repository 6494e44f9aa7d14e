"""The daily batch as one driver program.

``build_marts``: models, quality gate, publication. ``chart_datasets``: the
dashboards' data from the published marts or from the raw tables, and the run
summary. Each step is a DataFrame job; the driver only sees the one-row-per-
test quality report and the small run summary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.functions.leagues import LEAGUE_RULES
from tryline.operators import charts, extras, marts, quality
from tryline.plans.datasets import tile
from tryline.plans.landing import LandedRaw
from tryline.plans.marts import MartBuild
from tryline.sinks import writers
from tryline.sinks.partitioned import partitioned_clustered
from tryline.sinks.publication import Publication, Published, current
from tryline.sources.files import select_source
from tryline.sources.fixtures import RawTables

#: Table models, and how the fact is laid out.
FACT, FACT_PARTITION, FACT_CLUSTER = "fct_team_performance", "season", ("team_id", "game_date", "match_id")
#: The dashboard's tiles and the folders of their samples.
TILE_FOLDERS = {name: "_".join(name.lower().split()) for name, _ in LEAGUE_RULES["tile"]}
TILE_SAMPLE = 200


class StaleMartsError(FileNotFoundError):
    """The published marts are older than the caller accepts."""


@dataclass
class DailyResult:
    report: DataFrame | None
    source: str
    categorical: DataFrame
    timeseries: DataFrame
    summary: DataFrame
    charts: Published


def build_marts(spark: SparkSession, raw: RawTables | LandedRaw, mart_root: str, run_date: str) -> tuple[Published, DataFrame]:
    """Build all models, test them, and publish the table models; returns the published version and the report.

    The tables are written once, into the run's own version. Only when every
    test passed does the marker make them current; a failing test, or a run
    that dies, leaves what was published before.
    """
    version = Publication(spark, mart_root, run_date)

    def write(df: DataFrame, name: str) -> DataFrame:
        if name != FACT:
            return version.write(df, name)
        return version.write(df, name, lambda d, path: partitioned_clustered(d, path, FACT_PARTITION, FACT_CLUSTER))

    with MartBuild(raw) as build:
        report = quality.gate(build.build_and_test(write)[1])
    return version.publish(), report


def open_marts(spark: SparkSession, mart_root: str, run_date: str, max_age_days: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact and the two views of the published marts, registered as views; raises if there are none or they are too old (M4)."""
    fact = current(spark, mart_root).read(FACT)
    if max_age_days is not None:
        state = extras.freshness(fact, f"{run_date[:4]}-{run_date[4:6]}-{run_date[6:8]}", max_age_days, min_rows=1).first()
        if not (state["is_fresh"] and state["has_min_rows"]):
            raise StaleMartsError(f"marts under {mart_root} end at {state['max_game_date']}")
    views = {FACT: fact,
             "vw_league_margin_categorical": marts.vw_league_margin_categorical(fact),
             "vw_league_score_difference_timeseries": marts.vw_league_score_difference_timeseries(fact)}
    for name, df in views.items():
        writers.register_view(df, name)
    return fact, views["vw_league_margin_categorical"], views["vw_league_score_difference_timeseries"]


def chart_datasets(spark: SparkSession, raw: RawTables | LandedRaw, mart_root: str, out_dir: str, run_date: str, source: str = "auto",
                   max_teams: int | None = None, max_age_days: int | None = None, report: DataFrame | None = None) -> DailyResult:
    """Datasets of all charts and the run summary, published together below ``out_dir``.

    ``mart`` reads the published marts, ``local`` builds from the raw tables
    and opens no mart, ``auto`` takes the marts if they are published and
    fresh (``max_age_days``) and the raw tables otherwise (A10). ``run_date`` is ``yyyyMMdd``.
    """
    fact = None

    def from_marts():
        nonlocal fact
        fact, categorical, timeseries = open_marts(spark, mart_root, run_date, max_age_days)
        return categorical, timeseries

    def from_local():
        rows = charts.local_chart_rows(raw.team_stats, raw.match_details)
        return charts.local_league_margin(rows), charts.local_timeseries(rows)

    used, (categorical, timeseries) = select_source(source, from_marts, from_local)
    version = Publication(spark, out_dir, run_date)
    categorical = version.write(charts.margin_ranked(categorical), "league_margin_categorical")
    timeseries = version.write(timeseries, "league_score_difference")
    series = version.write(charts.chart_series(timeseries, max_teams), "league_score_difference_series")
    version.write(charts.axis_bounds(series), "axis_bounds")
    teams = version.write(charts.top_teams_per_league(timeseries, max_teams), "teams_by_league")
    summary = writers.run_summary({"categorical_rows": categorical, "timeseries_rows": timeseries, "series_rows": series}, spark, run_date)
    per_league = teams.groupBy("league_name").agg(F.count(F.lit(1)).alias("n"))
    rendered = per_league.select(F.concat(F.lit("teams_rendered: "), "league_name").alias("metric"), "n", F.lit(run_date).alias("run_date"))
    summary = version.write(summary.unionByName(rendered).withColumn("data_source", F.lit(used)), "run_summary")
    if fact is not None:
        for league, folder in TILE_FOLDERS.items():
            # the dashboard's tiles: a sample of each under its own order
            writers.export_json(tile(fact, league), f"{version.path('tiles')}/{folder}", order_by=("game_date", "team_name"), limit=TILE_SAMPLE)
    return DailyResult(report, used, categorical, timeseries, summary, version.publish())


def run_daily(spark: SparkSession, raw: RawTables | LandedRaw, mart_root: str, out_dir: str, run_date: str, source: str = "auto",
              max_teams: int | None = None, max_age_days: int | None = None) -> DailyResult:
    """One daily run over any source of the three raw tables. With source ``local`` no mart is built or published."""
    report = None
    if source.strip().lower() != "local":
        report = build_marts(spark, raw, mart_root, run_date)[1]
    return chart_datasets(spark, raw, mart_root, out_dir, run_date, source, max_teams, max_age_days, report)
