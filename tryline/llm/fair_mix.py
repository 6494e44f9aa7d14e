"""Mixing sources to target weights by weighted fair queueing, DataFrame functions only (operator 9).

Every source's documents are put into a fixed shuffled order (by the md5 of
the id). A document's virtual finish time is its source's cumulative words up
to and including it, divided by the source's target; the second and third
pass over a source continue where the first ended. All occurrences are ranged
by virtual finish time and taken from the front as long as their running
total stays within the budget, so each source has delivered its share of the
budget at every point of the order, up to one document.

Running totals never gather a source in one task: keys (md5 or the fixed-point
finish time, both spread evenly) are summed by hexadecimal prefix, level by
level of 256, and only rows below one prefix, about ``ROWS_PER_BLOCK``, are
added up in a window.

Targets: the budget is shared by weight; a target stops at ``max_epochs``
times its source's size and the excess is shared again by weight until none
is above (water filling, from running sums over the sources ordered by size
over weight).

Defined cases: null and empty texts have size 0 and are never taken; sources
are ordered by code point, null last, and null is a source of its own. Equal
rows each count. With no words at all every target is 0. A document larger
than what is left of the budget ends the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tryline.llm.common import WORD_PATTERN, Scratch, with_row_key

MAX_EPOCHS = 3
ROWS_PER_BLOCK = 500
#: Finish times up to the horizon are spread over the keys 0 to TIME_UNITS, 15 hexadecimal digits.
TIME_UNITS = float((1 << 59) - 1)
#: Whole finish times told apart when the horizon is looked for.
HORIZONS = 64


def rank_weights(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating, by the source's rank from 0."""
    return rank % 3 + 1


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _levels(rows: int) -> int:
    """Hexadecimal digits of a block's prefix: 256 times more blocks per level."""
    digits = 0
    while 16 ** digits * ROWS_PER_BLOCK < rows:
        digits += 2
    return digits


def running_total(df: DataFrame, group: list[str], key: str, order: list[Column], value: str, rows: int, out: str) -> DataFrame:
    """``out``: sum of ``value`` up to and including each row, per ``group`` in the order of ``key``, then ``order``.

    ``key`` is a hexadecimal string of fixed length.
    """
    digits = _levels(rows)
    df = df.withColumn("__b", F.substring(key, 1, digits))
    if not digits:
        w = Window.partitionBy(*group, "__b").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w)).drop("__b")
    sums = df.groupBy(*group, "__b").agg(F.sum(value).alias("__s"))
    offsets = None
    for d in range(2, digits + 1, 2):
        level = (sums.withColumn("__p", F.substring("__b", 1, d)).groupBy(*group, "__p").agg(F.sum("__s").alias("__s"))
                 .withColumn("__up", F.substring("__p", 1, d - 2)))
        before = Window.partitionBy(*group, "__up").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("__o", F.coalesce(F.sum("__s").over(before), F.lit(0)))
        if offsets is not None:
            up = offsets.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__p").alias("__up2"), F.col("__o").alias("__o2"))
            same = F.col("__up") == F.col("__up2")
            for i, g in enumerate(group):
                same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
            level = level.join(up, same).withColumn("__o", F.col("__o") + F.col("__o2"))
        offsets = level.select(*group, "__p", "__o")
    offsets = offsets.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__p").alias("__q"), F.col("__o"))
    same = F.col("__b") == F.col("__q")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    w = Window.partitionBy(*group, "__b").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.withColumn("__in", F.sum(value).over(w))
    return (inner.join(offsets, same).withColumn(out, F.col("__in") + F.col("__o"))
            .drop("__b", "__in", "__o", "__q", *[f"__g{i}" for i in range(len(group))]))


def targets(sizes: DataFrame, weight: Callable[[Column], Column] = rank_weights, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_rank, source_size, n_docs, target, budget)`` from ``(source, size)``; one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # a window over the sources, not over documents
    per = per.withColumn("source_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    per = per.withColumn("w", weight(F.col("source_rank")).cast("long"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("budget", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    before = Window.orderBy((F.col("cap").cast("double") / F.col("w")), "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_w = F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / left_w)
    # while sources before are capped the level rises; behind the first that isn't it falls
    per = per.withColumn("level", F.max("level").over(everything))
    return per.select("source", "source_rank", "source_size", "n_docs",
                      F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"), "budget")


def _horizon(each: DataFrame) -> float:
    """A finish time by which the budget is spent, so that no later occurrence can be taken."""
    hist = each.groupBy(F.least(F.ceil("finish"), F.lit(HORIZONS)).alias("v")).agg(
        F.sum("size").alias("s"), F.max("finish").alias("m"), F.max("budget").alias("budget")).orderBy("v").collect()
    total = 0
    for row in hist:
        total += row["s"]
        if total >= row["budget"] and row["v"] < HORIZONS:
            return float(row["v"])
    return max([1.0, *(row["m"] for row in hist)])


def occurrences(sized: DataFrame, scratch: Scratch, weight: Callable[[Column], Column] = rank_weights,
                max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Every taken occurrence of ``sized (uid, id, source, size)``: ``(uid, id, size, epoch, position)``.

    ``position`` is the running total of words in the mix up to its end.
    """
    rows = sized.count()
    per = scratch.table(targets(sized, weight, max_epochs), "targets")
    keyed = sized.where("size > 0").withColumn("key", F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))))
    cum = running_total(keyed, ["source"], "key", [F.col("id"), F.col("uid")], "size", rows, "cum")
    t = per.select(F.col("source").alias("s2"), "source_rank", "source_size", "target", "budget")
    cum = scratch.table(cum.join(t, F.col("source").eqNullSafe(F.col("s2"))).where(F.col("target") > 0), "cum")
    each = cum.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    each = each.withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("cum")).cast("double") / F.col("target"))
    horizon = _horizon(each)
    each = each.where(F.col("finish") <= horizon).select(
        "uid", "id", "size", "epoch", "finish", "source_rank", "budget",
        F.lpad(F.hex((F.col("finish") * (TIME_UNITS / horizon)).cast("long")), 15, "0").alias("tkey"))
    order = [F.col("finish"), F.col("source_rank"), F.col("id"), F.col("uid"), F.col("epoch")]
    out = running_total(each, [], "tkey", order, "size", rows * max_epochs, "position")
    return out.where("position <= budget").select("uid", "id", "size", "epoch", "position")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                       F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *keep)


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weight: Callable[[Column], Column] = rank_weights, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per document: ``id_col, size, source_size, target, taken`` (words taken, repeats counted)."""
    scratch = Scratch(docs.sparkSession, "fair-mix")
    sized = scratch.table(_sized(docs, id_col, text_col, source_col), "sized")
    taken = occurrences(sized, scratch, weight, max_epochs).groupBy("uid").agg(F.sum("size").alias("taken"))
    per = docs.sparkSession.read.parquet(scratch.paths["targets"]).select(F.col("source").alias("s2"), "source_size", "target")
    return (sized.join(taken, "uid", "left").join(per, F.col("source").eqNullSafe(F.col("s2")))
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Callable[[Column], Column] = rank_weights, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed documents themselves: one row per taken occurrence, ranged by position, with ``docs``' columns."""
    scratch = Scratch(docs.sparkSession, "fair-mix")
    # texts are shuffled twice: beside the plan by their row, and into their order
    keyed = with_row_key(docs, scratch)
    sized = scratch.table(_sized(keyed, id_col, text_col, source_col, ("__file", "__at")), "sized")
    taken = occurrences(sized.drop("__file", "__at"), scratch, weight, max_epochs)
    plan = scratch.table(taken.select("uid", "position").join(sized.select("uid", "__file", "__at"), "uid").select(
        F.col("__file").alias("__file2"), F.col("__at").alias("__at2"), F.col("position").alias("__position")), "plan")
    scratch.drop(*[name for name in scratch.paths if name not in ("plan", "rows")])
    out = keyed.join(plan, (F.col("__file") == F.col("__file2")) & (F.col("__at") == F.col("__at2")))
    return out.repartitionByRange("__position").sortWithinPartitions("__position").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM per),
weighted AS (
  SELECT *, r % 3 + 1 AS w, CAST(3 * source_size AS BIGINT) AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS budget FROM ranked),
levels AS (
  SELECT a.source, CAST(any_value(a.budget) - coalesce(sum(b.cap), 0) AS DOUBLE)
           / CAST((SELECT sum(w) FROM weighted) - coalesce(sum(b.w), 0) AS DOUBLE) AS level
  FROM weighted a LEFT JOIN weighted b
    ON CAST(b.cap AS DOUBLE) / b.w < CAST(a.cap AS DOUBLE) / a.w
    OR (CAST(b.cap AS DOUBLE) / b.w = CAST(a.cap AS DOUBLE) / a.w AND b.r < a.r)
  GROUP BY a.source),
goals AS (
  SELECT source, source_size, r, budget, least(CAST(cap AS DOUBLE), (SELECT max(level) FROM levels) * w) AS target FROM weighted),
cum AS (
  SELECT s.doc_id, s.size, g.source_size, g.r, g.budget, g.target,
         sum(s.size) OVER (PARTITION BY g.r ORDER BY md5('mix:' || s.doc_id), s.doc_id ROWS UNBOUNDED PRECEDING) AS cum
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source WHERE s.size > 0),
timed AS (
  SELECT *, CAST(e * source_size + cum AS DOUBLE) / target AS finish FROM cum, (VALUES (0), (1), (2)) v(e)),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, r, doc_id, e ROWS UNBOUNDED PRECEDING) AS position FROM timed),
taken AS (SELECT doc_id, sum(size) AS taken FROM placed WHERE position <= budget GROUP BY doc_id)
SELECT s.doc_id, s.size, g.source_size, g.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN taken t USING (doc_id)
"""
