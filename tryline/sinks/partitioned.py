"""Date-partitioned tables: size-bounded files (B2, B3, B5) and upserts that touch few partitions (M3, H4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tryline.operators.incremental import snapshot_upsert
from tryline.sinks.writers import drop_materialized
from tryline.sources.files import list_files

TARGET_BYTES = 128 << 20


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row before encoding and compression, an upper estimate of what it takes in a file."""
    total = F.lit(0)
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 5
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 5
        else:
            total = total + 9
    return total


def measured(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows and bytes per partition value: partial sums, one row per value."""
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).cast("double").alias("bytes"))


def write_bounded(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str],
                  target_bytes: int = TARGET_BYTES, mode: str = "overwrite", dynamic: bool = False) -> None:
    """One folder per ``partition_by`` value, rows ordered by ``cluster_by``, no file above ``target_bytes``.

    The bytes per value are measured first. Rows are then dealt out by ranges
    of (partition, cluster) into as many tasks as the whole takes files: a hot
    day is several tasks and files whose ranges of the cluster key follow one
    another, while many small days share a task and are one file each (two
    where a task ends). Within a task files are cut by a row count that keeps
    the value with the widest rows below the target, so no file depends on how
    well the ranges were sampled. ``cluster_by`` should end in a column that
    tells rows of one cluster value apart.
    """
    whole = measured(df, partition_by).agg(F.sum("bytes").alias("bytes"), F.max(F.col("bytes") / F.col("rows")).alias("widest")).first()
    tasks = max(1, -(-int(whole["bytes"] or 0) // target_bytes))
    rows = max(1, int(target_bytes / (whole["widest"] or 1)))
    by = [*partition_by, *cluster_by]
    writer = (df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
              .write.mode(mode).option("maxRecordsPerFile", rows).partitionBy(*partition_by))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def partitioned_clustered(df: DataFrame, path: str, partition_by: str, cluster_by: Sequence[str],
                          mode: str = "overwrite", target_bytes: int = TARGET_BYTES) -> None:
    """One folder per ``partition_by`` value; ``cluster_by`` orders its files, so
    parquet min/max stats skip files and row groups."""
    write_bounded(df, path, [partition_by], cluster_by, target_bytes, mode)


def per_entity_snapshots(df: DataFrame, root: str, labels: DataFrame, key: str = "team_id", label_col: str = "latest_date",
                         mode: str = "overwrite", cluster_by: Sequence[str] = ("game_date",), target_bytes: int = TARGET_BYTES) -> None:
    """One output per entity under ``{key}={id}/{label_col}={label}``.

    ``labels`` has one row per entity (E15); joining it back attaches each
    entity's label to its rows, and entities without rows write nothing. An
    entity above ``target_bytes`` is several files, split by ``cluster_by``.
    """
    write_bounded(df.join(labels.select(key, label_col), key, "inner"), root, [key, label_col], cluster_by, target_bytes, mode)


class PartitionedTable:
    """A parquet table with one row per ``key`` in folders by ``date``, upserted in place.

    A batch reads and replaces only the partitions it touches: those of its
    own dates and those where its keys are already (a corrected date moves a
    row; found by reading the key and date columns alone). The merged
    partitions are first written aside, complete, and then swapped in by a
    dynamic partition overwrite. A run that dies in between is finished by
    ``recover`` (which every upsert calls first) from what lies aside; a batch
    that comes again changes nothing.

    ``prefer`` decides between an existing and a new row (``snapshot_upsert``);
    rows without a date are a partition of their own, rows without a key are
    never upserted.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, date: str = "game_date",
                 prefer: str = "existing", order: Sequence[str] = (), cluster_by: Sequence[str] = (), target_bytes: int = TARGET_BYTES):
        self.spark, self.path, self.key, self.date = spark, path.rstrip("/"), key, date
        # the partition column comes last in what Spark reads back
        self.schema = T.StructType([f for f in schema.fields if f.name != date] + [schema[date]])
        self.prefer, self.order, self.target_bytes = prefer, tuple(order), target_bytes
        self.cluster_by = tuple(cluster_by) or (key,)
        self.aside = f"{self.path}_aside"

    def read(self) -> DataFrame:
        if not list_files(self.spark, self.path, f"{self.date}=*"):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def recover(self) -> bool:
        """Finish a swap that was cut off; whether there was one."""
        if list_files(self.spark, self.aside, "_SUCCESS"):
            self._swap()
            return True
        drop_materialized(self.spark, [self.aside])
        return False

    def _swap(self) -> None:
        merged = self.spark.read.schema(self.schema).parquet(self.aside)
        write_bounded(merged, self.path, [self.date], self.cluster_by, self.target_bytes, dynamic=True)
        # partitions whose last row moved elsewhere are not in the overwrite
        stay = {r["date"] for r in merged.select(F.col(self.date).cast("string").alias("date")).distinct().collect()}
        emptied = [r["date"] for r in self.spark.read.schema("date string").json(f"{self.aside}_dates").collect() if r["date"] not in stay] \
            if list_files(self.spark, f"{self.aside}_dates", "_SUCCESS") else []
        drop_materialized(self.spark, [f"{self.path}/{self.date}={d or '__HIVE_DEFAULT_PARTITION__'}" for d in emptied])
        drop_materialized(self.spark, [self.aside, f"{self.aside}_dates"])

    def touched(self, batch: DataFrame) -> list:
        """Dates of the batch and of the rows that have its keys (one value per partition reaches the driver)."""
        keys = batch.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        held = self.read().select(self.key, self.date).join(keys, self.key, "left_semi").select(self.date)
        return [r[0] for r in batch.where(F.col(self.key).isNotNull()).select(self.date).unionByName(held).distinct().collect()]

    def upsert(self, batch: DataFrame) -> list:
        """Merge ``batch`` (the table's columns and ``order``) into the table; returns the dates it replaced."""
        self.recover()
        batch = batch.where(F.col(self.key).isNotNull())
        dates = self.touched(batch)
        if not dates:
            return []
        here = F.col(self.date).isin(*[d for d in dates if d is not None])
        if None in dates:
            here = here | F.col(self.date).isNull()
        merged = snapshot_upsert(self.read().where(here), batch, key=self.key, prefer=self.prefer, order=self.order)
        self.spark.createDataFrame([(None if d is None else str(d),) for d in dates], "date string") \
            .coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{self.aside}_dates")
        merged.write.mode("overwrite").partitionBy(self.date).parquet(self.aside)
        self._swap()
        return dates
