"""Scalar column helpers.

All are native Spark expressions: they stay inside whole-stage codegen and
never call back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def team_game_key(team_id: str | Column = "team_id", match_id: str | Column = "match_id") -> Column:
    """``team_id-match_id``; NULL if either part is NULL (SQL concat)."""
    return F.concat(_c(team_id), F.lit("-"), _c(match_id))


def season_of(date: str | Column = "game_date") -> Column:
    """C4: calendar year of the match date as bigint."""
    return F.year(_c(date)).cast("bigint")


def strip_dot_zero(x: str | Column, fallback: str = "") -> Column:
    """NULL -> fallback; a trailing ``.0`` (float-printed label) is dropped."""
    return F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit(fallback)), r"\.0$", "")


def try_date(x: str | Column) -> Column:
    """Parse ``yyyyMMdd`` or ISO text to DATE; unparsable -> NULL.

    The text is first normalised with C12 so ``20240101.0`` parses too. Plain
    ``cast``/``to_date`` would raise under ANSI mode; the ``try_`` forms don't.
    """
    text = F.trim(strip_dot_zero(x))
    return F.coalesce(
        F.try_to_date(text, "yyyyMMdd"),
        F.try_to_date(text, "yyyy-MM-dd"),
        F.to_date(F.try_to_timestamp(text)),
    )


def try_double(x: str | Column) -> Column:
    """Numeric coercion, bad value -> NULL."""
    return _c(x).cast("string").try_cast("double")


def slugify(x: str | Column) -> Column:
    """Lower-case, runs of non-alphanumerics -> ``_``, outer ``_`` trimmed."""
    return F.btrim(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "_"), F.lit("_"))


def match_label(date: str | Column, team_a: str | Column, team_b: str | Column) -> Column:
    """``yyyy-MM-dd | A vs B``; NULL if any part is NULL (SQL concat)."""
    return F.concat(_c(date).cast("string"), F.lit(" | "), _c(team_a), F.lit(" vs "), _c(team_b))


def surrogate_match_id(date: str | Column, team: str | Column, opponent: str | Column) -> Column:
    """C14: ``date|team|opponent`` with NULL parts as empty text."""
    return F.concat_ws("|", *[F.coalesce(_c(x).cast("string"), F.lit("")) for x in (date, team, opponent)])
