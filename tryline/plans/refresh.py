"""The match-details refresh as one run: ask for what is missing, upsert what came, remember what failed.

Known ids come from all team stats, landed ones from the last published
snapshot. The provider is a function from a frame of ids to a frame of
detail rows, so the fetch itself is partition parallelism of whoever supplies
it; an id that comes back with an error, or not at all, has failed. The next
run finds failed ids still missing and takes them up again, those tried least
first, so that a cap on ids is never used up by hopeless ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.operators.incremental import missing_ids, snapshot_upsert
from tryline.operators.staging import keep_first
from tryline.schemas import RAW_MATCH_DETAILS
from tryline.sinks.publication import Publication, Published, current
from tryline.sinks.writers import MATERIALIZED, drop_materialized, materialize

#: Fixed value: failures listed in a run's summary.
LISTED_FAILURES = 200
LEDGER = "match_id string, error string, attempts long"
NOT_RETURNED = "not returned"


@dataclass
class Refresh:
    """Tables ``match_details``, ``failures`` (the ledger) and ``run_summary`` (one row) of one published run."""

    run: Published

    @property
    def details(self) -> DataFrame:
        return self.run.read("match_details")

    @property
    def failures(self) -> DataFrame:
        return self.run.read("failures")

    @property
    def summary(self) -> DataFrame:
        return self.run.read("run_summary")


def last_state(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Details and ledger of the last run; empty frames before the first one (A2)."""
    try:
        last = Refresh(current(spark, root))
    except FileNotFoundError:
        return spark.createDataFrame([], RAW_MATCH_DETAILS), spark.createDataFrame([], LEDGER)
    return last.details, last.failures


def ids_to_ask(known: DataFrame, details: DataFrame, ledger: DataFrame, max_ids: int = 0) -> DataFrame:
    """D5 + G6: ``(match_id, attempts)`` of missing ids, least tried first, then by id; ``max_ids`` of them if above 0."""
    tried = ledger.select(F.col("match_id").alias("_id"), F.col("attempts").alias("_n"))
    ids = missing_ids(known, details)
    ids = ids.join(tried, ids.match_id == F.col("_id"), "left").select("match_id", F.coalesce("_n", F.lit(0)).cast("long").alias("attempts"))
    return ids.orderBy("attempts", "match_id").limit(max_ids) if max_ids > 0 else ids


def detail_rows(answers: DataFrame, order: str) -> DataFrame:
    """Of each match's rows without an error the first by ``order``, five columns under our names."""
    good = answers.where(F.col("error").isNull() & F.col("match_id").isNotNull() & (F.col("match_id") != ""))
    first = keep_first(good, ["match_id"], [F.col(order)])
    return first.select("match_id", F.col("date").try_cast("date").alias("game_date"), F.col("season").try_cast("bigint").alias("season"),
                        "competition_id", F.col("competition").alias("competition_name"))


def refresh_details(spark: SparkSession, known: DataFrame, fetch: Callable[[DataFrame], DataFrame], root: str, run_date: str,
                    max_ids: int = 0, prefer: str = "existing", order: str = "row") -> Refresh:
    """One run. ``known`` has a ``match_id`` per landed team row; ``fetch`` gets ``(match_id)`` and returns
    ``match_id, date, season, competition_id, competition, error`` and ``order``, any number of rows per id.

    Details, ledger and summary are published together, last of all: a run
    that dies leaves the state before it, and the next one asks again.
    """
    mark = len(MATERIALIZED)
    try:
        details, ledger = last_state(spark, root)
        asked = materialize(spark, ids_to_ask(known, details, ledger, max_ids), "asked")
        # the provider is asked once: what it said is written before anything reads it
        answers = materialize(spark, fetch(asked.select("match_id")), "answers")
        rows = materialize(spark, detail_rows(answers, order), "rows")
        got = rows.select(F.col("match_id").alias("_got"))
        errors = answers.where(F.col("error").isNotNull()).groupBy(F.col("match_id").alias("_bad")).agg(F.min("error").alias("_error"))
        outcomes = (asked.join(got, asked.match_id == F.col("_got"), "left").join(errors, F.col("match_id") == F.col("_bad"), "left")
                    .select("match_id", F.col("_got").isNotNull().alias("ok"),
                            F.coalesce("_error", F.lit(NOT_RETURNED)).alias("error"), (F.col("attempts") + 1).alias("attempts")))
        outcomes = materialize(spark, outcomes, "outcomes")
        failed = outcomes.where("not ok").select("match_id", "error", "attempts")
        # ids that failed before and were not asked this time stay in the ledger while they are missing
        waiting = ledger.join(outcomes.select("match_id"), "match_id", "left_anti").join(details.select("match_id"), "match_id", "left_anti")
        version = Publication(spark, root, run_date)
        # only what was asked for is taken
        new = rows.join(asked.select("match_id"), "match_id", "left_semi")
        version.write(snapshot_upsert(details, new, prefer=prefer), "match_details")
        version.write(failed.unionByName(waiting), "failures")
        version.write(_summary(spark, known, details, outcomes, failed, run_date), "run_summary")
        return Refresh(version.publish())
    finally:
        drop_materialized(spark, MATERIALIZED[mark:])


def _summary(spark: SparkSession, known: DataFrame, details: DataFrame, outcomes: DataFrame, failed: DataFrame, run_date: str) -> DataFrame:
    """One row; the failures listed are the first ``LISTED_FAILURES`` by id, all are in the ledger."""
    listed = failed.orderBy("match_id").limit(LISTED_FAILURES)
    parts = (
        known.agg(F.count_distinct(F.nullif(F.col("match_id"), F.lit(""))).alias("match_ids_total"), F.count(F.lit(1)).alias("team_stats_rows")),
        details.agg(F.count_distinct("match_id").alias("match_ids_preexisting")),
        outcomes.agg(F.count(F.lit(1)).alias("processed"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed")),
        listed.agg(F.array_sort(F.collect_list(F.struct("match_id", "error"))).alias("failures")))
    out = spark.range(1).select(F.lit(run_date).alias("run_date"))
    for one_row in parts:
        out = out.crossJoin(one_row)
    return out
