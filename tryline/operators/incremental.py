"""Incremental landing: missing ids, snapshot dedupe and upserts, watermark labels.

D5, H3, H4, H5, B5/E15, G6, M3.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tryline.functions.columns import strip_dot_zero
from tryline.operators.staging import keep_first


def missing_ids(known: DataFrame, landed: DataFrame, key: str = "match_id") -> DataFrame:
    """Distinct ids in ``known`` (NULL and blank ones don't count) that ``landed`` lacks."""
    ids = known.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()
    have = landed.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull())
    return ids.join(have, key, "left_anti")


def capped_ids(ids: DataFrame, max_ids: int = 0, key: str = "match_id") -> DataFrame:
    """Ids in sorted order, the first ``max_ids`` when > 0 (0 = all).

    The cap is the feature (a bounded fetch batch): Spark plans it as a
    TakeOrderedAndProject, i.e. a per-task top-n before one small merge.
    """
    ordered = ids.orderBy(key)
    return ordered.limit(max_ids) if max_ids > 0 else ordered


def first_snapshot_wins(snapshots: DataFrame, key: str = "match_id", snapshot_col: str = "snapshot",
                        row_order: Sequence[str] = ()) -> DataFrame:
    """H3: across snapshots ordered by name, keep the first row per key."""
    order = [F.col(snapshot_col).asc()] + [F.col(c).asc() for c in row_order]
    return keep_first(snapshots, [key], order)


def snapshot_upsert(existing: DataFrame, new: DataFrame, key: str = "match_id", prefer: str = "existing",
                    order: Sequence[str] = ()) -> DataFrame:
    """H4: existing and new rows, one row per key; ``prefer`` decides overlaps (S15:
    the reference keeps the existing row, so corrections never land;
    ``prefer="new"`` lets them land). Within one side the first row by
    ``order`` stays (snapshot name and row number, say; a column one side
    lacks is NULL there), then by the row's own values, so reruns agree."""
    if prefer not in ("existing", "new"):
        raise ValueError(prefer)
    cols = [c for c in existing.columns if c not in order]
    pe, pn = (0, 1) if prefer == "existing" else (1, 0)

    def side(df: DataFrame, rank: int) -> DataFrame:
        own = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in order]
        return df.select(*cols, *own, F.lit(rank).alias("_prio"))

    both = side(existing, pe).unionByName(side(new, pn))
    return keep_first(both, [key], [F.col(c).asc() for c in ("_prio", *order, *cols)]).select(*cols)


def latest_date_label(stats: DataFrame, run_date: str, key: str = "team_id",
                      date_col: str = "game_date", fmt: str = "yyyyMMdd") -> DataFrame:
    """Per entity the latest date as ``yyyyMMdd`` text (C12 applied),
    or the run date when the entity has no dated row. Only entities with rows
    appear (entities without rows write nothing)."""
    latest = stats.groupBy(key).agg(F.max(date_col).alias("_latest"), F.count(F.lit(1)).alias("rows"))
    label = F.coalesce(strip_dot_zero(F.date_format("_latest", fmt), fallback=""), F.lit(""))
    return latest.select(key, F.when(label == "", F.lit(run_date)).otherwise(label).alias("latest_date"), "rows")


def incremental_upsert(existing: DataFrame, new: DataFrame, key: str,
                       compare: Sequence[str] | None = None) -> DataFrame:
    """M3: idempotent upsert on ``key`` where new rows win, with a
    reconciliation tag per key from a full outer join that compares the
    columns null-safely: ``inserted`` (only new), ``updated`` (a value
    differs), ``unchanged`` and ``kept`` (only existing). Running it again with the same ``new`` gives the
    same table and only ``unchanged`` / ``kept`` tags.
    """
    cols = existing.columns
    compare = list(compare or [c for c in cols if c != key])
    e = existing.select(F.col(key), F.struct(*cols).alias("e"))
    n = new.select(F.col(key), F.struct(*cols).alias("n"))
    j = e.join(n, key, "full_outer")
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"e.`{c}`").eqNullSafe(F.col(f"n.`{c}`"))
    change = (F.when(F.col("e").isNull(), F.lit("inserted"))
               .when(F.col("n").isNull(), F.lit("kept"))
               .when(~same, F.lit("updated"))
               .otherwise(F.lit("unchanged")))
    picked = F.when(F.col("n").isNotNull(), F.col("n")).otherwise(F.col("e"))
    return j.select(picked.alias("r"), change.alias("change_type")).select("r.*", "change_type")

