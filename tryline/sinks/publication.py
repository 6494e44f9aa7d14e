"""Sets of tables that become readable together, or not at all.

A run writes its tables into folders of its own version,
``{root}/{table}/v={version}``, and last of all one small marker,
``{root}/_published/{version}.json``. Nothing that was published is ever
overwritten, also not by a second run on the same day: a run that dies at any
step leaves the marker before it, and so the tables before it, as they were.
Readers take the greatest marker.

One run at a time per root: retention removes what older runs left unpublished.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tryline.sinks.writers import drop_materialized
from tryline.sources.files import list_files

KEEP = 3
MARKERS = "_published"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a name of its own and rename it: no reader sees half of it."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = _file_system(spark, f"{folder}/_{name}-{uuid.uuid4().hex}.tmp")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(hidden, _file_system(spark, path)[1]):
        raise OSError(f"could not write {path}")


def _get(spark: SparkSession, path: str) -> str:
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Published:
    """One published version and the schemas of its tables."""

    spark: SparkSession
    root: str
    version: str
    schemas: dict[str, dict]

    def path(self, name: str) -> str:
        if name not in self.schemas:
            raise FileNotFoundError(f"no table {name} in version {self.version} under {self.root}")
        return f"{self.root}/{name}/v={self.version}"

    def read(self, name: str) -> DataFrame:
        # the schema is given, so a folder's partition values keep their type and an empty table is readable
        path = self.path(name)
        return self.spark.read.schema(T.StructType.fromJson(self.schemas[name])).parquet(path)


def markers(spark: SparkSession, root: str) -> list[str]:
    """Published versions, oldest first."""
    return [p.rsplit("/", 1)[1].removesuffix(".json") for p in list_files(spark, f"{root.rstrip('/')}/{MARKERS}", "*.json")
            if not p.rsplit("/", 1)[1].startswith("_")]


def current(spark: SparkSession, root: str) -> Published:
    """The version that was published last; ``FileNotFoundError`` if there is none."""
    root = root.rstrip("/")
    known = markers(spark, root)
    if not known:
        raise FileNotFoundError(f"nothing published under {root}")
    return Published(spark, root, known[-1], json.loads(_get(spark, f"{root}/{MARKERS}/{known[-1]}.json"))["schemas"])


class Publication:
    """A run's version in the making: ``write`` its tables, check them, then ``publish``."""

    def __init__(self, spark: SparkSession, root: str, run_date: str):
        self.spark, self.root, self.run_date = spark, root.rstrip("/"), run_date
        # a later run of one day sorts behind the earlier ones, finished or not
        begun = [p.rsplit("/v=", 1)[1] for p in list_files(spark, self.root, f"*/v={run_date}-*")]
        runs = [int(v[len(run_date) + 1:].split("-")[0]) for v in (*markers(spark, root), *begun) if v.startswith(f"{run_date}-")]
        self.version = f"{run_date}-{max(runs, default=0) + 1:04d}-{uuid.uuid4().hex[:8]}"
        self.schemas: dict[str, dict] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/v={self.version}"

    def write(self, df: DataFrame, name: str, writer=None) -> DataFrame:
        """Write a table of this version (with ``writer(df, path)``, if given) and read it back."""
        (writer or (lambda d, path: d.write.parquet(path)))(df, self.path(name))
        self.schemas[name] = df.schema.jsonValue()
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def publish(self, keep: int = KEEP) -> Published:
        """Make this version the current one, in one step, then remove what is older than ``keep`` versions."""
        _put(self.spark, f"{self.root}/{MARKERS}/{self.version}.json",
             json.dumps({"run_date": self.run_date, "schemas": self.schemas}))
        retain(self.spark, self.root, keep)
        return Published(self.spark, self.root, self.version, dict(self.schemas))


def retain(spark: SparkSession, root: str, keep: int = KEEP) -> list[str]:
    """Remove all but the newest ``keep`` published versions, and what unfinished runs before the newest left.

    Markers go before their tables, so no marker ever names a missing table.
    Returns the removed versions.
    """
    root = root.rstrip("/")
    known = markers(spark, root)
    if not known:
        return []
    stay = set(known[-keep:])
    drop_materialized(spark, [f"{root}/{MARKERS}/{v}.json" for v in known if v not in stay])
    old = [p for p in list_files(spark, root, "*/v=*")
           if (v := p.rsplit("/v=", 1)[1]) not in stay and v < known[-1]]
    drop_materialized(spark, old)
    return sorted({p.rsplit("/v=", 1)[1] for p in old})
