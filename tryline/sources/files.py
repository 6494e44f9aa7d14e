"""File-level sources: snapshot scans, drifting-schema reads, guards, registry.

A1-A5 and A10. File names are listed through the Hadoop FileSystem the
session is configured with, so the same code lists a local folder, HDFS or an
object store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tryline.functions.columns import try_date, try_double


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Full paths of the entries of ``folder`` matching ``pattern``, sorted by name."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    glob = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    fs = glob.getFileSystem(conf)
    stats = fs.globStatus(glob) or []
    return sorted(str(s.getPath().toString()) for s in stats)


def latest_snapshot_path(spark: SparkSession, folder: str, pattern: str) -> str:
    """A1: the lexicographically greatest name matching ``pattern``."""
    files = list_files(spark, folder, pattern)
    if not files:
        raise FileNotFoundError(f"No files found for {pattern} in {folder}")
    return max(files, key=lambda p: p.rsplit("/", 1)[-1])


def latest_snapshot(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """A1: read the latest snapshot; raise ``FileNotFoundError`` if none."""
    return spark.read.parquet(latest_snapshot_path(spark, folder, pattern))


def optional_latest_snapshot(spark: SparkSession, folder: str, pattern: str,
                             schema: T.StructType) -> DataFrame:
    """A2: as A1, but a typed empty frame when no snapshot exists."""
    try:
        return latest_snapshot(spark, folder, pattern)
    except FileNotFoundError:
        return spark.createDataFrame([], schema)


_NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)


def coerce(name: str, have: T.DataType, want: T.DataType) -> Column:
    """A landed column in its declared type; what can't be read is NULL.

    Dates come as DATE, TIMESTAMP, text (``yyyyMMdd`` or ISO, a printed
    ``.0`` allowed) or a ``yyyyMMdd`` number; numbers as numbers or text.
    """
    c = F.col(f"`{name}`")
    if have == want:
        return c
    if isinstance(want, T.DateType):
        if isinstance(have, (T.TimestampType, T.TimestampNTZType)):
            return F.to_date(c)
        return try_date(c.try_cast("bigint") if isinstance(have, _NUMBERS) else c.cast("string"))
    if isinstance(want, _NUMBERS) and not isinstance(have, _NUMBERS):
        return try_double(c).try_cast(want)
    if isinstance(have, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c) if isinstance(want, T.StringType) else F.lit(None).cast(want)
    return c.try_cast(want)


def conform(df: DataFrame, declared: T.StructType, keep_extra: bool = True) -> DataFrame:
    """Coerce the declared columns a frame has and add the missing ones as NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [coerce(f.name, have[f.name], f.dataType).alias(f.name) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in declared.fields]
    if keep_extra:
        declared_names = {f.name for f in declared.fields}
        cols += [F.col(f"`{n}`") for n in df.columns if n not in declared_names]
    return df.select(*cols)


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """One type for a column whose files disagree: numbers meet as double, all else as text."""
    first = kinds[0]
    if all(k == first for k in kinds):
        return first
    return T.DoubleType() if all(isinstance(k, _NUMBERS) for k in kinds) else T.StringType()


def union_by_name(frames: Sequence[DataFrame], declared: T.StructType | None = None) -> DataFrame:
    """A3: stack frames by column name; a column missing from a frame is NULL.

    Frames may disagree on a type (bigint and double, text and bigint, an
    all-null column read as int): a declared column is coerced to its declared
    type, any other to the type all its frames can meet in.
    """
    if not frames:
        raise ValueError("no frames to union")
    known = {f.name for f in declared.fields} if declared is not None else set()
    kinds: dict[str, list[T.DataType]] = {}
    for f in frames:
        for c in f.schema.fields:
            if c.name not in known:
                kinds.setdefault(c.name, []).append(c.dataType)
    whole = T.StructType([*(declared.fields if declared is not None else []),
                          *(T.StructField(n, common_type(k)) for n, k in kinds.items())])
    parts = [f.select(*[coerce(c.name, c.dataType, whole[c.name].dataType).alias(c.name) for c in f.schema.fields]) for f in frames]
    if declared is not None:
        parts = [conform(p, declared) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def parquet_opener():
    """A function opening a pyarrow ParquetFile for a local path or any URI
    pyarrow's file systems resolve (only the footer is read until data is
    asked for). Built as a closure so task code ships it by value and Python
    workers need nothing but pyarrow."""
    def open_parquet(path: str):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        if path.startswith("file:"):
            return pq.ParquetFile(path[len("file:"):])
        for old in ("s3a://", "s3n://"):      # Hadoop's names of schemes
            path = path.replace(old, "s3://", 1) if path.startswith(old) else path
        if "://" in path:
            fs, inner = pafs.FileSystem.from_uri(path)
            return pq.ParquetFile(fs.open_input_file(inner))
        return pq.ParquetFile(path)
    return open_parquet


#: Where a landed row came from: its file's name and its place in it.
ORIGIN = ("_file", "_row")
#: Files up to this size are read whole by the task that gets them; of larger ones only the footer is.
SMALL_FILE = 64 << 20
FOOTER = "path string, length long, rows long, schema string"


def landed_files(spark: SparkSession, folder: str, pattern: str = "*.parquet", small: bool | None = None,
                 content: bool = False) -> DataFrame:
    """``(path, length)`` of the files of ``folder``, listed by Spark; with ``content`` also their bytes.

    ``small`` keeps those up to ``SMALL_FILE`` (or, if false, the others); the
    size is checked before a file is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    try:
        found = files.load(folder.rstrip("/"))
    except AnalysisException as e:
        raise FileNotFoundError(f"No parquet files found in {folder}") from e
    if small is not None:
        found = found.where(F.col("length") <= SMALL_FILE if small else F.col("length") > SMALL_FILE)
    return found.select("path", "length", *(["content"] if content else []))


def footers(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """``(path, length, rows, schema)`` of each parquet file, read in tasks; no path reaches the driver.

    Small files come as bytes through Spark's own file system, so any store
    that Spark reads will do; of large ones the task opens the footer.
    """
    opener = parquet_opener()

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for batch in batches:
            named = batch.to_pydict()
            out = []
            for i, path in enumerate(named["path"]):
                file = pq.ParquetFile(pa.BufferReader(named["content"][i])) if "content" in named else opener(path)
                out.append((path, named["length"][i], file.metadata.num_rows, file.schema_arrow.to_string(show_schema_metadata=False)))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                              pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                                             names=["path", "length", "rows", "schema"])

    small = landed_files(spark, folder, pattern, small=True, content=True).mapInArrow(read, FOOTER)
    return small.unionByName(landed_files(spark, folder, pattern, small=False).mapInArrow(read, FOOTER))


def schema_groups(listing: DataFrame) -> list:
    """One row per schema of a listing: ``schema, files, rows, bytes, sample, n_large``; all that reaches the driver."""
    groups = (listing.groupBy("schema")
              .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("length").alias("bytes"),
                   F.min("path").alias("sample"), F.count_if(F.col("length") > SMALL_FILE).alias("n_large")))
    return sorted(groups.collect(), key=lambda g: g["sample"])


def _read_small(spark: SparkSession, folder: str, pattern: str, listing: DataFrame, schema: str, shape: T.StructType) -> DataFrame:
    """Rows of a schema group's small files, each file parsed in one task; rows carry their origin."""
    from pyspark.sql.pandas.types import to_arrow_schema
    fields = T.StructType([*shape.fields, T.StructField(ORIGIN[0], T.StringType()), T.StructField(ORIGIN[1], T.LongType())])
    target = to_arrow_schema(shape, timestamp_utc=True)

    def parse(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                at = 0
                for rows in pq.ParquetFile(pa.BufferReader(content.as_buffer())).iter_batches():
                    table = pa.Table.from_batches([rows]).select(target.names).cast(target, safe=False)
                    n = len(table)
                    table = table.append_column(ORIGIN[0], pa.array([path.rsplit("/", 1)[-1]] * n, pa.string()))
                    table = table.append_column(ORIGIN[1], pa.array(range(at, at + n), pa.int64()))
                    at += n
                    yield from table.to_batches()

    mine = listing.where((F.col("schema") == schema) & (F.col("length") <= SMALL_FILE)).select(F.col("path").alias("_path"))
    files = landed_files(spark, folder, pattern, small=True, content=True)
    # the listing decides which files belong to the group; contents are read where they are parsed
    return files.join(mine, F.col("path") == F.col("_path"), "left_semi").select("path", "content").mapInArrow(parse, fields)


def _read_large(spark: SparkSession, listing: DataFrame, schema: str, shape: T.StructType) -> DataFrame:
    """Rows of a schema group's large files by Spark's reader (their paths: at most one per ``SMALL_FILE`` bytes of data)."""
    paths = [r["path"] for r in listing.where((F.col("schema") == schema) & (F.col("length") > SMALL_FILE)).select("path").collect()]
    return spark.read.schema(shape).parquet(*sorted(paths)).select(
        "*", F.col("_metadata.file_name").alias(ORIGIN[0]), F.col("_metadata.row_index").alias(ORIGIN[1]))


def read_drifting(spark: SparkSession, folder: str, declared: T.StructType,
                  pattern: str = "*.parquet", origin: bool = False, listing: DataFrame | None = None,
                  available: Sequence[str] = ()) -> DataFrame:
    """A3 for files whose schemas drift: group the files by footer schema, read
    each group with its own schema, conform it to the declared types and union
    by name. With ``origin``, every row carries its file's name and its place in it.

    ``listing`` is a written table of ``footers``; without it one is written
    to the shared folder. The driver sees one row per schema, and Spark's
    reader gets paths of large files only. For each column of ``available``,
    ``{column}_available`` tells whether the row's file has it: a value that
    is NULL there and one that never was landed stay apart (M5).
    """
    if listing is None:
        from tryline.sinks.writers import materialize
        listing = materialize(spark, footers(spark, folder, pattern), "footers")
    groups = schema_groups(listing)
    require_files(groups, folder)
    frames = []
    for g in groups:
        shape = spark.read.parquet(g["sample"]).schema
        if g["files"] > g["n_large"]:
            frames.append(_read_small(spark, folder, pattern, listing, g["schema"], shape))
        if g["n_large"]:
            frames.append(_read_large(spark, listing, g["schema"], shape))
        here = 1 if g["n_large"] in (0, g["files"]) else 2
        frames[-here:] = [f.select("*", *[F.lit(c in shape.names).alias(f"{c}_available") for c in available]) for f in frames[-here:]]
    out = union_by_name(frames, declared)
    return out if origin else out.drop(*ORIGIN)


# --- guards (A4) --------------------------------------------------------------


def require_files(paths: Sequence[str], folder: str) -> None:
    if not paths:
        raise FileNotFoundError(f"No parquet files found in {folder}")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: a missing required column is an error (schema check, no job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{', '.join(missing)} column missing")
    return df


def require_rows(df: DataFrame, what: str = "data") -> DataFrame:
    """A4: empty data is an error (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


# --- registry (A5) and source selection (A10) -----------------------------------


class SourceRegistry:
    """A5: logical names (``raw.team_stats`` ...) resolved to readers."""

    def __init__(self):
        self._readers: dict[str, Callable[[], DataFrame]] = {}

    def register(self, name: str, reader: Callable[[], DataFrame]) -> None:
        self._readers[name] = reader

    def table(self, name: str) -> DataFrame:
        if name not in self._readers:
            raise KeyError(f"unknown source {name!r}")
        return self._readers[name]()

    def names(self) -> list[str]:
        return sorted(self._readers)


def select_source(mode: str, mart: Callable[[], tuple[DataFrame, ...]],
                  local: Callable[[], tuple[DataFrame, ...]]) -> tuple[str, tuple[DataFrame, ...]]:
    """A10: ``mart`` / ``local`` / ``auto``; auto tries the marts and falls
    back to the local build when they cannot be resolved (the documented
    fallback, S8). Returns the source actually used and its frames."""
    mode = mode.strip().lower()
    if mode not in ("auto", "mart", "local"):
        raise ValueError("source must be one of: auto, mart, local")
    if mode == "local":
        return "local", local()
    try:
        frames = mart()
        for f in frames:
            f.schema  # noqa: B018 -- resolves the plan: missing tables fail here
        return "mart", frames
    except (AnalysisException, FileNotFoundError):
        if mode == "mart":
            raise
        return "local", local()
