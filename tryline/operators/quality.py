"""Data-quality operators (J1-J6, D6) and match-completeness profiles.

Every check returns a DataFrame of violating rows (0 rows = pass). The gate
builds one report of (model, column, test, failures) -- a row per declared
test, so the only thing that reaches the driver is that small report.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tryline.functions.leagues import CATEGORICAL_LEAGUES, TIMESERIES_LEAGUES


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` (non-null) occurring more than once, with counts.
    A partial count per value, so a hot value is combined map-side."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose non-null ``column`` is outside ``values``."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def repeated_hashes(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of 64-bit hashes that several non-null values of ``column`` share.

    Eight bytes a row are shuffled, not the values. 0 proves the column
    unique; otherwise ``unique`` tells which values repeat, if any.
    """
    keys = df.where(F.col(column).isNotNull()).select(F.xxhash64(column).alias("_h"))
    twice = keys.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return twice.agg(F.count(F.lit(1)).alias("failures"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent (left anti join;
    AQE broadcasts the parent keys only when they measure small)."""
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def score_symmetry(fct: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Matches without exactly two rows or whose differences don't cancel."""
    return (fct.where(F.col("match_id").isNotNull()).groupBy("match_id")
               .agg(F.count(F.lit(1)).alias("team_rows"),
                    F.sum("score_difference").alias("score_diff_sum"))
               .where((F.col("team_rows") != 2) | (F.abs(F.col("score_diff_sum")) > tolerance)))


def teams_per_match(stg: DataFrame) -> DataFrame:
    """Distribution of distinct teams per match (two partial aggregates)."""
    per_match = stg.groupBy("match_id").agg(F.count_distinct("team_id").alias("teams_per_match"))
    return per_match.groupBy("teams_per_match").agg(F.count(F.lit(1)).alias("matches"))


def inverse_violations(stg: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Among matches with exactly two rows, how many differences don't cancel."""
    diff = F.col("score") - F.col("opponent_score")
    per_match = (stg.groupBy("match_id")
                    .agg(F.count(F.lit(1)).alias("rows"), F.sum(diff).alias("diff_sum")))
    two = per_match.where(F.col("rows") == 2)
    return two.agg(F.count(F.lit(1)).alias("two_team_matches"),
                   F.count_if(F.abs(F.col("diff_sum")) > tolerance).alias("inverse_violations"))


# --- declared tests and the gate (J6) -------------------------------------------


@dataclass(frozen=True)
class Test:
    model: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships | score_symmetry
    values: tuple[str, ...] = ()
    to: tuple[str, str] | None = None  # (parent model, parent column)
    extra: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def declared_tests() -> list[Test]:
    """The 28 generic tests + 1 singular test of the reference's models."""
    t: list[Test] = []
    for col in ("team_id",):
        t += [Test("stg_teams", col, "not_null"), Test("stg_teams", col, "unique")]
    t += [Test("stg_team_stats", "team_game_key", "not_null"),
          Test("stg_team_stats", "team_game_key", "unique"),
          Test("stg_team_stats", "team_id", "not_null"),
          Test("stg_team_stats", "game_date", "not_null"),
          Test("stg_match_details", "match_id", "not_null"),
          Test("stg_match_details", "match_id", "unique"),
          Test("int_team_game_metrics", "team_game_key", "not_null"),
          Test("int_team_game_metrics", "winner_flag", "accepted_values", values=("W", "L", "D")),
          Test("dim_teams", "team_id", "not_null"),
          Test("dim_teams", "team_id", "unique"),
          Test("fct_team_performance", "team_game_key", "not_null"),
          Test("fct_team_performance", "team_game_key", "unique"),
          Test("fct_team_performance", "team_id", "not_null"),
          Test("fct_team_performance", "team_id", "relationships", to=("dim_teams", "team_id")),
          Test("fct_team_performance", "game_date", "not_null")]
    for col in ("match_id", "match_label", "game_date", "team_name", "score_difference", "league_name"):
        t.append(Test("vw_league_score_difference_timeseries", col, "not_null"))
    t.append(Test("vw_league_score_difference_timeseries", "league_name", "accepted_values",
                  values=TIMESERIES_LEAGUES))
    for col in ("league_name", "matches", "avg_match_margin"):
        t.append(Test("vw_league_margin_categorical", col, "not_null"))
    t.append(Test("vw_league_margin_categorical", "league_name", "accepted_values",
                  values=CATEGORICAL_LEAGUES))
    t.append(Test("fct_team_performance", "match_id", "score_symmetry"))
    return t


def violations(models: dict[str, DataFrame], test: Test) -> DataFrame:
    df = models[test.model]
    if test.kind == "not_null":
        return not_null(df, test.column)
    if test.kind == "unique":
        return unique(df, test.column)
    if test.kind == "accepted_values":
        return accepted_values(df, test.column, test.values)
    if test.kind == "relationships":
        parent, pcol = test.to
        return relationships(df, test.column, models[parent], pcol)
    if test.kind == "score_symmetry":
        return score_symmetry(df)
    raise ValueError(test.kind)


def _row_condition(t: Test):
    c = F.col(t.column)
    return c.isNull() if t.kind == "not_null" else (c.isNotNull() & ~c.isin(*t.values))


def _result(t: Test, failures: Column) -> Column:
    return F.struct(F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
                    F.lit(t.kind).alias("test"), failures.cast("bigint").alias("failures"))


def quality_report(models: dict[str, DataFrame], tests: Sequence[Test] | None = None) -> DataFrame:
    """J6 report: one row per test with its failure count.

    Per model, the row-level tests (not_null, accepted_values) ride along in
    one pass: a plain aggregate, or -- when the model has a unique test --
    the unique test's group-by, whose per-key partial counts also carry the
    row-level violation counts. Relationships and symmetry need their own
    shuffle each.
    """
    tests = list(tests if tests is not None else declared_tests())
    parts: list[DataFrame] = []
    row_tests: dict[str, list[Test]] = {}
    unique_tests: dict[str, list[Test]] = {}
    for t in tests:
        if t.kind in ("not_null", "accepted_values"):
            row_tests.setdefault(t.model, []).append(t)
        elif t.kind == "unique":
            unique_tests.setdefault(t.model, []).append(t)
        else:
            parts.append(violations(models, t).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
                                 F.lit(t.kind).alias("test"), "failures"))
    for model in dict.fromkeys(list(row_tests) + list(unique_tests)):
        rts, uts = row_tests.get(model, []), unique_tests.get(model, [])
        df = models[model]
        results = []
        if uts:
            key = uts[0].column
            per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                          *[F.count_if(_row_condition(t)).alias(f"_r{i}") for i, t in enumerate(rts)])
            aggs = [F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_u0")]
            aggs += [F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(rts))]
            wide = per_key.agg(*aggs)
            results.append(_result(uts[0], F.col("_u0")))
            for t in uts[1:]:  # further unique tests on other columns: own pass
                parts.append(violations(models, t).agg(F.count(F.lit(1)).alias("failures"))
                             .select(F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
                                     F.lit(t.kind).alias("test"), "failures"))
        else:
            wide = df.agg(*[F.count_if(_row_condition(t)).alias(f"_r{i}") for i, t in enumerate(rts)])
        results += [_result(t, F.coalesce(F.col(f"_r{i}"), F.lit(0))) for i, t in enumerate(rts)]
        parts.append(wide.select(F.explode(F.array(*results)).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


REPORT_SCHEMA = "model string, column_name string, test string, failures bigint, status string"
ROW_KINDS = ("not_null", "accepted_values")


def observe_row_tests(df: DataFrame, tests: Sequence[Test]) -> tuple[DataFrame, Observation]:
    """``df`` with the violations of row-level ``tests`` counted while it is next written or read to the end."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(_row_condition(t)).alias(f"r{i}") for i, t in enumerate(tests)]), seen


def observed_failures(seen: Observation, tests: Sequence[Test]) -> dict[Test, int]:
    """What ``observe_row_tests`` counted; call it after the action."""
    got = seen.get
    return {t: int(got.get(f"r{i}") or 0) for i, t in enumerate(tests)}


def _failing_rows(models: dict[str, DataFrame], t: Test) -> DataFrame:
    """One row with the number of failures of a test that needs a shuffle or a view."""
    df = models[t.model]
    if t.kind == "unique":
        return repeated_hashes(df, t.column)
    if t.kind == "relationships":
        # counted per key first: what is joined is one row per key
        parent, column = t.to
        per_key = df.groupBy(t.column).agg(F.count(F.lit(1)).alias("_n"))
        return relationships(per_key, t.column, models[parent], column).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
    return violations(models, t).agg(F.count(F.lit(1)).alias("failures"))


def remaining_failures(models: dict[str, DataFrame], tests: Sequence[Test]) -> dict[Test, int]:
    """Failures of tests that no write could count: one job over written models, one more if a hash repeats."""
    row_wise: dict[str, list[Test]] = {}
    parts = []
    for i, t in enumerate(tests):
        if t.kind in ROW_KINDS:
            row_wise.setdefault(t.model, []).append(t)
        else:
            parts.append(_failing_rows(models, t).select(F.lit(i).alias("test"), F.col("failures").cast("bigint").alias("failures")))
    for model, some in row_wise.items():
        wide = models[model].agg(*[F.count_if(_row_condition(t)).alias(f"r{k}") for k, t in enumerate(some)])
        pairs = F.array(*[F.struct(F.lit(tests.index(t)).alias("test"), F.col(f"r{k}").cast("bigint").alias("failures"))
                          for k, t in enumerate(some)])
        parts.append(wide.select(F.inline(pairs)))
    if not parts:
        return {}
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    out = {tests[r["test"]]: r["failures"] for r in every.collect()}
    for t, n in out.items():
        if t.kind == "unique" and n:
            out[t] = violations(models, t).count()
    return out


def report_of(spark: SparkSession, failures: dict[Test, int]) -> DataFrame:
    """The report: one row per test, in memory."""
    rows = [(t.model, t.column, t.kind, n, "fail" if n else "pass") for t, n in failures.items()]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """J6 gate: raise if any test failed (the report has one row per test, so
    collecting the failing rows is bounded by the number of tests)."""
    failed = report.where(F.col("failures") > 0).collect()
    if failed:
        names = ", ".join(f"{r['test']}:{r['model']}.{r['column_name']}={r['failures']}" for r in failed)
        raise QualityGateError(f"{len(failed)} data test(s) failed: {names}")
    return report

