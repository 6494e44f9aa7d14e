"""Incremental runs over newly landed files (optional wrapper, SURVEY §2.K).

The reference is a daily batch; its incremental behaviour is "fetch what is
missing, upsert, keep the first record". The same DataFrame operators run here
through Structured Streaming with ``trigger(availableNow=True)``: each run
processes only the files that arrived since the last run (tracked in the
stream's checkpoint beside the table) and stops. ``foreachBatch`` applies
the batch upsert to a date-partitioned table, so a lost executor re-runs the
micro-batch from its recorded offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tryline.sinks.partitioned import PartitionedTable
from tryline.sources.files import ORIGIN


def new_files_stream(spark: SparkSession, folder: str, schema: T.StructType,
                     pattern: str = "*.parquet", max_files: int | None = None) -> DataFrame:
    """A file stream over ``folder`` with each row's origin; a declared schema is required for streams."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).select("*", F.col("_metadata.file_name").alias(ORIGIN[0]),
                                         F.col("_metadata.row_index").alias(ORIGIN[1]))


def run_available(stream: DataFrame, process_batch: Callable[[DataFrame, int], None],
                  checkpoint: str) -> None:
    """Process everything available now, micro-batch by micro-batch, then stop."""
    q = (stream.writeStream.foreachBatch(process_batch)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def upsert_batches(table: PartitionedTable) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: upsert each micro-batch into ``table`` (H4 / M3 semantics).

    Only the date partitions that a batch touches are read and replaced. A
    batch that runs again after its write upserts rows that are there already,
    which changes nothing; one that died while partitions were swapped is
    finished first.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)
    return process


def incremental_details_run(spark: SparkSession, landing: str, schema: T.StructType, table: str,
                            key: str = "match_id", prefer: str = "existing", date: str = "game_date") -> DataFrame:
    """One scheduled run: upsert all newly landed files into ``table``, which is
    partitioned by ``date``, and return it. The stream's checkpoint lies beside
    the table, so each table follows a folder for itself; should it get lost,
    all files are upserted once more."""
    target = PartitionedTable(spark, table, schema, key, date, prefer=prefer, order=ORIGIN)
    target.recover()
    run_available(new_files_stream(spark, landing, schema), upsert_batches(target), f"{table.rstrip('/')}_stream")
    return target.read()
