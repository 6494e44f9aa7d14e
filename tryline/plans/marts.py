"""The mart DAG as lazily composed DataFrames.

raw.team_stats -> stg_team_stats (F1) -> int_team_game_metrics (C6, E2, D1,
D2, C7, C8) -> fct_team_performance (F2-F4) -> the two dashboard views;
raw.match_details -> stg_match_details; raw.teams -> stg_teams -> dim_teams.

Models are lazy but for the cut before the rolling windows: with ``cut`` the
intermediate model is written in range pieces (B9) and re-read, so a lost
executor only recomputes from the written table. ``close`` (or leaving the
``with`` block) drops what a build wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from tryline.operators import marts, metrics, quality, staging
from tryline.schemas import FCT_COLUMNS
from tryline.session import ensure_checkpoint_dir
from tryline.sinks.writers import MATERIALIZED, drop_materialized, materialize
from tryline.sources.fixtures import TIE_BREAKS, RawTables


class MartBuild:
    def __init__(self, raw: RawTables, tie_breaks: tuple[str, ...] | None = None, cut: bool = True, pieces: int | None = None):
        # any source with team_stats, teams and match_details will do
        tie_breaks = getattr(raw, "tie_breaks", TIE_BREAKS) if tie_breaks is None else tie_breaks
        self.raw = raw
        self.cut = cut
        self.pieces = pieces
        self.written: list[str] = []
        if cut:
            ensure_checkpoint_dir(raw.spark)
        self.tie_breaks = tie_breaks

    def __enter__(self) -> MartBuild:
        return self

    def __exit__(self, *failure) -> None:
        self.close()

    def close(self) -> None:
        """Drop the tables this build wrote on the way; its models can't be read any more."""
        drop_materialized(self.raw.spark, self.written)
        self.written = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written on the way and read back, dropped by ``close``."""
        out = materialize(self.raw.spark, df, name)
        self.written.append(MATERIALIZED[-1])
        return out

    @cached_property
    def stg_team_stats(self) -> DataFrame:
        reduced = getattr(self.raw, "latest_team_stats", None)
        if reduced is not None:
            return staging.stg_team_stats(reduced, latest=True)
        return staging.stg_team_stats(self.raw.team_stats, tie_breaks=self.tie_breaks)

    @cached_property
    def stg_match_details(self) -> DataFrame:
        return staging.stg_match_details(self.raw.match_details)

    @cached_property
    def stg_teams(self) -> DataFrame:
        return staging.stg_teams(self.raw.teams)

    @cached_property
    def dim_teams(self) -> DataFrame:
        return marts.dim_teams(self.stg_teams)

    @cached_property
    def int_team_game_metrics(self) -> DataFrame:
        return metrics.int_team_game_metrics(self.stg_team_stats, self.stg_match_details)

    @cached_property
    def fct_team_performance(self) -> DataFrame:
        if not self.cut:
            return marts.fct_team_performance(self.int_team_game_metrics)
        ranged = marts.range_pieces(self.int_team_game_metrics, pieces=self.pieces)
        return marts.fct_team_performance(self.keep(ranged, "int_team_game_metrics"))

    @cached_property
    def fct_core(self) -> DataFrame:
        """The fact without its three rolling means: same rows, same other
        columns, still hash-partitioned by match_id. Consumers that never read
        the rolling means (the views, tiles, tests) use it, so they skip the
        rolling windows and the written pieces below them."""
        return self.int_team_game_metrics.select(*[c for c in FCT_COLUMNS if not c.endswith("_rolling_5")])

    @cached_property
    def vw_league_score_difference_timeseries(self) -> DataFrame:
        return marts.vw_league_score_difference_timeseries(self.fct_core)

    @cached_property
    def vw_league_margin_categorical(self) -> DataFrame:
        return marts.vw_league_margin_categorical(self.fct_core)

    def models(self, core_fact: bool = True) -> dict[str, DataFrame]:
        """Every model by name; with ``core_fact`` the fact entry is the core
        (enough for all declared tests, which never read rolling means)."""
        names = ("stg_teams", "stg_team_stats", "stg_match_details", "int_team_game_metrics",
                 "dim_teams", "fct_team_performance", "vw_league_score_difference_timeseries",
                 "vw_league_margin_categorical")
        out = {n: getattr(self, n) for n in names if not (core_fact and n == "fct_team_performance")}
        if core_fact:
            out["fct_team_performance"] = self.fct_core
        return out

    def build_and_test(self, write: Callable[[DataFrame, str], DataFrame] | None = None,
                       rolling: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
        """Every model built once, in the order of the DAG, and all declared tests; returns models and report.

        Row-level tests are counted by the very writes that build the models
        (an observation at the top of each). Uniqueness, references and
        symmetry run over the written tables in one job, the views' row tests
        in the same. Table models go through ``write(df, name)`` (say, into a
        publication), all others to tables that ``close`` drops. Without
        ``rolling`` the fact lacks its rolling means, which no test reads.
        """
        write = write or self.keep
        tests = quality.declared_tests()
        failures: dict[quality.Test, int | None] = dict.fromkeys(tests)
        models: dict[str, DataFrame] = {}

        def land(df: DataFrame, name: str, writer: Callable[[DataFrame, str], DataFrame], *also: str) -> DataFrame:
            mine = [t for t in tests if t.model in (name, *also) and t.kind in quality.ROW_KINDS]
            observed, seen = quality.observe_row_tests(df, mine)
            models[name] = writer(observed, name)
            failures.update(quality.observed_failures(seen, mine))
            return models[name]

        land(self.stg_teams, "stg_teams", self.keep)
        land(marts.dim_teams(models["stg_teams"]), "dim_teams", write)
        details = land(self.stg_match_details, "stg_match_details", self.keep)
        # the enrichment join below fans out if details repeat a match id
        repeats = [t for t in tests if t.model == "stg_match_details" and t.kind == "unique"]
        failures.update(quality.remaining_failures(models, repeats))
        quality.gate(quality.report_of(self.raw.spark, {t: failures[t] for t in repeats}))
        core = metrics.int_team_game_metrics(land(self.stg_team_stats, "stg_team_stats", self.keep), details)
        if rolling:
            pieces = land(marts.range_pieces(core, pieces=self.pieces), "int_team_game_metrics", self.keep)
            models["int_team_game_metrics"] = pieces.drop(marts.PIECE)
            fact = land(marts.fct_team_performance(pieces), "fct_team_performance", write)
        else:
            fact = land(core, "fct_team_performance", self.keep, "int_team_game_metrics")
            models["int_team_game_metrics"] = fact
        models["vw_league_score_difference_timeseries"] = marts.vw_league_score_difference_timeseries(fact)
        models["vw_league_margin_categorical"] = marts.vw_league_margin_categorical(fact)
        failures.update(quality.remaining_failures(models, [t for t in tests if failures[t] is None]))
        return models, quality.report_of(self.raw.spark, failures)
