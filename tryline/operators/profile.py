"""Post-load validation and profiling.

Profiles are computed with one aggregate pass per input; metadata comes from
schemas and the catalog, never from collecting data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """E7 + H1: ``(table_name, row_count)`` per table, as a UNION ALL of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def date_bounds(df: DataFrame, date_col: str = "game_date", id_col: str = "team_id") -> DataFrame:
    """Global min/max date and number of distinct ids."""
    return df.agg(F.min(date_col).alias("min_game_date"), F.max(date_col).alias("max_game_date"),
                  F.count_distinct(id_col).alias("distinct_teams"))


def conditional_first_and_ordered_list(df: DataFrame, group: str, flag: F.Column, value: str,
                                       order: str, keep: F.Column) -> DataFrame:
    """E10 pattern: ``MAX(IF(flag, value))`` plus ``ARRAY_AGG(IF(keep, value)
    IGNORE NULLS ORDER BY order)`` per group.

    The ordered array is ``collect_list`` of (order, value) structs, sorted and
    projected: NULLs are skipped by ``collect_list`` itself.
    """
    picked = F.when(keep, F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    ordered = F.transform(F.array_sort(F.collect_list(picked)), lambda x: x["v"])
    return df.groupBy(group).agg(
        F.max(F.when(flag, F.col(value))).alias("flagged_value"),
        # like the warehouse's ARRAY_AGG, no qualifying row gives NULL, not []
        F.when(F.size(ordered) > 0, ordered).alias("ordered_values"))


def table_inventory(spark: SparkSession, names: Sequence[str], database: str | None = None) -> DataFrame:
    """``(table_name, table_type)`` for the named tables/views that exist."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database) if t.name in set(names)]
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("table_type", T.StringType())])
    return spark.createDataFrame(rows, schema).orderBy("table_name")


def column_metadata(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Ordinal, name, type, nullable of a DataFrame's columns."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = "ordinal_position int, column_name string, data_type string, is_nullable boolean"
    return spark.createDataFrame(rows, schema)


def column_profile(sources: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Per column, how many sources (files / file groups) have it, how many
    rows those sources hold, how many of those rows are non-null, and the share.

    One aggregate pass per source computes its row count and the non-null
    count of every profiled column it has; sources lacking a column add
    nothing. The per-source rows are then summed per column.
    """
    parts = []
    for name, df in sources.items():
        present = [c for c in columns if c in df.columns]
        aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"nn_{i}") for i, c in enumerate(present)]
        wide = df.agg(*aggs)
        if not present:
            continue
        stacked = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"nn_{i}").alias("non_null"))
            for i, c in enumerate(present)]))
        parts.append(wide.select(F.lit(name).alias("source"), stacked.alias("r")).select("source", "r.*"))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    n_sources = len(sources)
    return (allp.groupBy("column_name")
                .agg(F.count(F.lit(1)).alias("sources_with_column"),
                     F.sum("rows").alias("rows_where_present"),
                     F.sum("non_null").alias("non_null_rows"))
                .withColumn("total_sources", F.lit(n_sources).cast("bigint"))
                .withColumn("non_null_pct",
                            F.round(F.col("non_null_rows") * 100.0 / F.col("rows_where_present"), 1)))


ROW_GROUPS = "path string, row_group int, column_name string, rows long, bytes long, nulls long, min_value string, max_value string"


def row_group_stats(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Per file, row group and column: rows, compressed bytes, null count, least and greatest value as text.

    Footers are read in parallel tasks, no data page is; what a writer left
    out is NULL. A column that a file holds only as nulls has no statistics of
    its own and counts all its rows as null. Nested columns have one row per
    leaf, under the leaf's path.
    """
    from tryline.sources.files import landed_files, parquet_opener
    opener = parquet_opener()

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for batch in batches:
            named = batch.to_pydict()
            out = []
            for i, path in enumerate(named["path"]):
                file = pq.ParquetFile(pa.BufferReader(named["content"][i])) if "content" in named else opener(path)
                empty = {f.name for f in file.schema_arrow if pa.types.is_null(f.type)}
                for g in range(file.metadata.num_row_groups):
                    group = file.metadata.row_group(g)
                    for k in range(group.num_columns):
                        column = group.column(k)
                        s, name = column.statistics, column.path_in_schema
                        nulls = group.num_rows if name in empty else s.null_count if s is not None and s.has_null_count else None
                        bounds = (str(s.min), str(s.max)) if s is not None and s.has_min_max else (None, None)
                        out.append((path, g, name, group.num_rows, column.total_compressed_size, nulls, *bounds))
            types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = list(zip(*out, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=[c.split()[0] for c in ROW_GROUPS.split(", ")])

    small = landed_files(spark, folder, pattern, small=True, content=True).mapInArrow(read, ROW_GROUPS)
    return small.unionByName(landed_files(spark, folder, pattern, small=False).mapInArrow(read, ROW_GROUPS))


def footer_column_profile(spark: SparkSession, folder: str, columns: Sequence[str], pattern: str = "*.parquet",
                          stats: DataFrame | None = None) -> DataFrame:
    """E16 from Parquet footers alone: per column, the files having it, the
    rows of those files and their non-null rows (row-group null counts).

    Where a writer left no null counts, ``stats_complete`` is false and the
    non-null rows are NULL. ``stats`` is a written table of ``row_group_stats``.
    """
    stats = row_group_stats(spark, folder, pattern) if stats is None else stats
    per_file = stats.groupBy("path", "column_name").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") - F.col("nulls")).alias("non_null"),
        F.bool_and(F.col("nulls").isNotNull()).alias("complete"))
    total = stats.agg(F.count_distinct("path").alias("total_files"))
    out = (per_file.where(F.col("column_name").isin(*columns)).groupBy("column_name")
           .agg(F.count(F.lit(1)).alias("files_with_column"), F.sum("rows").alias("rows_where_present"),
                F.sum("non_null").alias("_non_null"), F.bool_and("complete").alias("stats_complete")))
    return (out.crossJoin(total)      # one row, the number of files
            .withColumn("non_null_rows", F.when(F.col("stats_complete"), F.col("_non_null")))
            .withColumn("non_null_pct", F.round(F.col("non_null_rows") * 100.0 / F.col("rows_where_present"), 1)).drop("_non_null"))


def partition_value(path: str = "path", column: str | None = None) -> Column:
    """A partition column's value in a file's path (``column=value``); NULL for the folder of nulls."""
    value = F.regexp_extract(path, rf"/{column}=([^/]+)/", 1)
    return F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), value)


def layout_summary(stats: DataFrame, partition: str, column: str, kind: str = "bigint") -> DataFrame:
    """E10 from footers: per partition value its files, rows, and the clustering column's bounds, nulls and depth.

    The depth is the largest number of files whose ranges of the column hold
    one value, by a sweep over the ranges' ends: 1 where files of a partition
    don't overlap. ``kind`` is the column's type.
    """
    files = (stats.where(F.col("column_name") == column).withColumn("partition_value", partition_value("path", partition))
             .groupBy("partition_value", "path")
             .agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
                  F.min(F.col("min_value").try_cast(kind)).alias("lo"), F.max(F.col("max_value").try_cast(kind)).alias("hi")))
    ends = files.where("lo is not null").select("partition_value", F.inline(F.array(
        F.struct(F.col("lo").alias("at"), F.lit(0).alias("side"), F.lit(1).alias("step")),
        F.struct(F.col("hi").alias("at"), F.lit(1).alias("side"), F.lit(-1).alias("step")))))
    sweep = Window.partitionBy("partition_value").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    depth = (ends.withColumn("open", F.sum("step").over(sweep)).groupBy(F.col("partition_value").alias("_value"))
             .agg(F.max("open").alias("depth")))
    whole = files.groupBy("partition_value").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))
    return whole.join(depth, F.col("partition_value").eqNullSafe(F.col("_value")), "left").drop("_value")
