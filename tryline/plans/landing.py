"""From landed files to the three raw tables (the first step of a run on real data).

Reads the latest teams snapshot, every team-stats file whatever its schema and
the latest match details if there are any, turns nested values into text,
coerces dates and numbers, writes the raw tables that the models read, checks
that what a run needs is there and publishes them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tryline.operators.documents import serialize_nested
from tryline.schemas import RAW_MATCH_DETAILS, RAW_TEAM_STATS, RAW_TEAMS
from tryline.sinks.partitioned import partitioned_clustered
from tryline.sinks.publication import Publication, Published, current
from tryline.sinks.writers import MATERIALIZED, drop_materialized, materialize
from tryline.sources import files

#: Columns that a run can't do without, and their table.
NEEDED = {"team_stats": ("team_id", "match_id", "game_date"), "teams": ("team_id",)}
#: Day folders and the order of rows in them.
LAYOUT = {"team_stats": ("game_date", ("team_id", "match_id")), "match_details": ("game_date", ("competition_id", "match_id"))}


@dataclass
class LandedRaw:
    """The raw tables of one published load; a source for ``MartBuild`` and ``run_daily``."""

    spark: SparkSession
    load: Published
    #: landed rows of equal date are taken in the order of their files
    tie_breaks: tuple[str, ...] = files.ORIGIN

    @property
    def team_stats(self) -> DataFrame:
        return self.load.read("team_stats")

    @property
    def teams(self) -> DataFrame:
        return self.load.read("teams")

    @property
    def match_details(self) -> DataFrame:
        return self.load.read("match_details")


def open_raw(spark: SparkSession, raw_root: str) -> LandedRaw:
    """The raw tables that were loaded last."""
    return LandedRaw(spark, current(spark, raw_root))


def _require(df: DataFrame, name: str, landed: set[str]) -> None:
    """A4, on what was landed and written but not yet published: needed columns, and a row that has them all."""
    needed = NEEDED[name]
    missing = [c for c in needed if c not in landed]
    if missing:
        raise KeyError(f"raw.{name}: {', '.join(missing)} column missing")
    files.require_rows(df.dropna(subset=list(needed)), f"raw.{name}")


def load_raw(spark: SparkSession, landing: str, raw_root: str, teams: str = "teams_*.parquet",
             team_stats: str = "team_stats_*.parquet", details: str = "match_details_*.parquet", run_date: str = "load") -> LandedRaw:
    """Land everything below ``landing`` into new raw tables below ``raw_root`` (full refresh).

    The tables are written as a version of their own, team stats and details
    in day folders ordered by their cluster key, checked, and only then
    published: a landing that is broken, empty or cut off leaves the raw
    tables of the load before.
    """
    listing = materialize(spark, files.footers(spark, landing, team_stats), "footers")
    listing_path = MATERIALIZED[-1]
    try:
        return _load_raw(spark, landing, raw_root, teams, team_stats, details, run_date, listing)
    finally:
        drop_materialized(spark, [listing_path])


def _load_raw(spark: SparkSession, landing: str, raw_root: str, teams: str, team_stats: str, details: str, run_date: str,
              listing: DataFrame) -> LandedRaw:
    stats = files.read_drifting(spark, landing, RAW_TEAM_STATS, team_stats, origin=True, listing=listing)
    landed_teams = files.latest_snapshot(spark, landing, teams)
    found = files.conform(files.optional_latest_snapshot(spark, landing, details, RAW_MATCH_DETAILS), RAW_MATCH_DETAILS)
    version = Publication(spark, raw_root, run_date)
    tables = {"team_stats": stats, "teams": files.conform(landed_teams, RAW_TEAMS), "match_details": found}
    landed = {"team_stats": {c for g in files.schema_groups(listing) for c in spark.read.parquet(g["sample"]).columns}, "teams": set(landed_teams.columns)}
    for name, df in tables.items():
        day = LAYOUT.get(name)
        written = version.write(serialize_nested(df), name, day and (lambda d, path, day=day: partitioned_clustered(d, path, *day)))
        if name in NEEDED:
            _require(written, name, landed[name])
    return LandedRaw(spark, version.publish())
