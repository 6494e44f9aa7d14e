"""Spark session defaults and the shared checkpoint folder.

Cluster runs pass their own session, whose configuration is left alone;
``build_session`` is for tests and benches.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast only
# when the measured side is below the threshold, skew-join splitting of hot
# keys, partition coalescing), which is how this package keeps broadcasts
# behind a size check instead of hinting them blindly.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tryline", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches (never used on a cluster)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TRYLINE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or ``fallback``.

    A cluster must name one that driver and executors share; without it this
    raises, since a machine-local folder would be incomplete on read-back.
    Only a local master (tests), where all tasks run on this machine, gets a
    scratch folder of its own.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or fallback
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = _LOCAL_DIRS.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="tryline-")
        _LOCAL_DIRS[sc.applicationId] = current
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"
