"""Registered queries: one per operator id from SURVEY §2 (key prefix = id).

Each entry is ``(spark, sf_dir) -> DataFrame`` over the whole driver tables,
paired with its oracle SQL (``tryline.oracle`` has the shared parts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tryline.plans.marts import MartBuild
from tryline.sources.fixtures import RawTables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None = rows-only check)."""
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def marts_for(spark: SparkSession, sf_dir: str) -> MartBuild:
    return MartBuild(RawTables(spark, sf_dir))


def _load() -> None:
    # importing the query modules fills REGISTRY / ORACLE
    from tryline.plans import queries as _q  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
