"""League mapping rules (C17, C18, C19, C23; SURVEY §2.N S1).

The reference maps competitions to dashboard leagues with four slightly
different rule sets. They are kept as data -- one ordered rule list per
variant -- and turned into a single native CASE expression, so mapping stays
inside whole-stage codegen and needs no join or UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results):
# competition ids and league / competition names used by the dashboards.
CHALLENGE_CUP_ID = "83d92007"
CHAMPIONS_CUP_ID = "ee0c6883"
SUPER_RUGBY_ID = "877aa127"
PACIFIC_NATIONS_CUP_ID = "bc5d9ec5"

CHALLENGE_CUP = "European Rugby Challenge Cup"
CHAMPIONS_CUP = "European Rugby Champions Cup"
MAJOR_LEAGUE_RUGBY = "Major League Rugby"
SUPER_RUGBY_PACIFIC = "Super Rugby Pacific"
SUPER_RUGBY = "Super Rugby"
# ---------------------------------------------------------------------------

# A rule is (league, matchers); matchers is a dict of
#   "id": ids compared exactly, "name": names compared exactly,
#   "name_lower": names compared after lower-casing the input.
# Rules are tried in order; a row matching none gets NULL.
LEAGUE_RULES: dict[str, list[tuple[str, dict[str, tuple[str, ...]]]]] = {
    # time-series view: lower-cased names, Super Rugby by its own id, MLR included
    "timeseries": [
        (CHALLENGE_CUP, {"id": (CHALLENGE_CUP_ID,)}),
        (CHAMPIONS_CUP, {"id": (CHAMPIONS_CUP_ID,)}),
        (MAJOR_LEAGUE_RUGBY, {"name_lower": ("major league rugby",)}),
        (SUPER_RUGBY_PACIFIC, {"name_lower": ("super rugby pacific", "super rugby"),
                               "id": (SUPER_RUGBY_ID,)}),
    ],
    # categorical view: exact-case names, no MLR. The id here belongs to the
    # Pacific Nations Cup in the provider's list; the mislabel is reproduced.
    "categorical": [
        (CHALLENGE_CUP, {"id": (CHALLENGE_CUP_ID,)}),
        (CHAMPIONS_CUP, {"id": (CHAMPIONS_CUP_ID,)}),
        (SUPER_RUGBY_PACIFIC, {"name": (SUPER_RUGBY_PACIFIC, SUPER_RUGBY),
                               "id": (PACIFIC_NATIONS_CUP_ID,)}),
    ],
    # local chart path: lower-cased names, both Super Rugby ids, null-safe
    "chart": [
        (CHALLENGE_CUP, {"id": (CHALLENGE_CUP_ID,)}),
        (CHAMPIONS_CUP, {"id": (CHAMPIONS_CUP_ID,)}),
        (MAJOR_LEAGUE_RUGBY, {"name_lower": ("major league rugby",)}),
        (SUPER_RUGBY_PACIFIC, {"name_lower": ("super rugby pacific", "super rugby"),
                               "id": (SUPER_RUGBY_ID, PACIFIC_NATIONS_CUP_ID)}),
    ],
    # dashboard tiles: two by id, two by exact name
    "tile": [
        (CHALLENGE_CUP, {"id": (CHALLENGE_CUP_ID,)}),
        (CHAMPIONS_CUP, {"id": (CHAMPIONS_CUP_ID,)}),
        (MAJOR_LEAGUE_RUGBY, {"name": (MAJOR_LEAGUE_RUGBY,)}),
        (SUPER_RUGBY_PACIFIC, {"name": (SUPER_RUGBY_PACIFIC, SUPER_RUGBY)}),
    ],
}

# Leagues each published dataset may contain (accepted-values tests, J3).
TIMESERIES_LEAGUES = (CHALLENGE_CUP, CHAMPIONS_CUP, MAJOR_LEAGUE_RUGBY, SUPER_RUGBY_PACIFIC)
CATEGORICAL_LEAGUES = (CHALLENGE_CUP, CHAMPIONS_CUP, SUPER_RUGBY_PACIFIC)


def _condition(matchers: dict[str, tuple[str, ...]], comp_id: Column, comp_name: Column) -> Column:
    parts = []
    for kind, values in matchers.items():
        if kind == "id":
            parts.append(comp_id.isin(*values))
        elif kind == "name":
            parts.append(comp_name.isin(*values))
        elif kind == "name_lower":
            parts.append(F.lower(comp_name).isin(*values))
        else:
            raise ValueError(f"unknown matcher kind {kind!r}")
    # name matchers are listed first in SQL; OR is commutative for the result
    return reduce(lambda a, b: a | b, parts)


def league_expr(variant: str, comp_id: str | Column = "competition_id",
                comp_name: str | Column = "competition_name") -> Column:
    """CASE expression mapping competition id/name to a league, or NULL."""
    rules = LEAGUE_RULES[variant]
    cid = F.col(comp_id) if isinstance(comp_id, str) else comp_id
    cname = F.col(comp_name) if isinstance(comp_name, str) else comp_name
    if variant == "chart":
        # the chart path compares str(x or ''): a NULL never matches
        cid, cname = F.coalesce(cid, F.lit("")), F.coalesce(cname, F.lit(""))
    expr = None
    for league, matchers in rules:
        cond = _condition(matchers, cid, cname)
        expr = F.when(cond, F.lit(league)) if expr is None else expr.when(cond, F.lit(league))
    return expr.otherwise(F.lit(None).cast("string"))


def tile_filter(league: str, comp_id: str = "competition_id",
                comp_name: str = "competition_name") -> Column:
    """Predicate of one dashboard tile."""
    for name, matchers in LEAGUE_RULES["tile"]:
        if name == league:
            return _condition(matchers, F.col(comp_id), F.col(comp_name))
    raise KeyError(league)
