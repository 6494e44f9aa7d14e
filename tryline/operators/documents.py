"""JSON / document operators from the scheduled side flows.

All run as native expressions over columns (``from_json``, ``to_json``,
higher-order functions); no row is parsed in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_document(spark: SparkSession, path: str, array_field: str,
                       schema: T.StructType | str | None = None) -> DataFrame:
    """A whole-document JSON file holding an array of records; one row per
    record (``inline`` of the array)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    doc = reader.json(path)
    return doc.select(F.inline(F.col(array_field)))


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON records with the schema inferred (a JSON array file or lines)."""
    return spark.read.option("multiLine", True).json(path)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Literal rows (INSERT ... VALUES into a cleared table), ordered."""
    df = spark.createDataFrame(list(rows), schema)
    return df.orderBy(*order_by) if order_by else df


def keep_columns_default(json_col: str | Column, keys: Sequence[str], default: str = "N/A") -> list[Column]:
    """For each key, its value from a JSON object, or ``default`` when the
    key is absent. A key present with JSON null stays NULL (absent != null)."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    m = F.from_json(c, T.MapType(T.StringType(), T.StringType()))
    return [F.when(F.map_contains_key(m, k), m[k]).otherwise(F.lit(default)).alias(k) for k in keys]


def json_array_join(json_col: str | Column, name_field: str = "name", array_field: str = "types",
                    item_path: Sequence[str] = ("type", "name"), sep: str = ", ") -> Column:
    """``Name: <name>\\nTypes: <a, b, ...>`` from a nested JSON record,
    joining one field of every element of an array of objects."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    item: T.DataType = T.StringType()
    for part in reversed(item_path):
        item = T.StructType([T.StructField(part, item)])
    schema = T.StructType([T.StructField(name_field, T.StringType()),
                           T.StructField(array_field, T.ArrayType(item))])
    rec = F.from_json(c, schema)

    def leaf(x: Column) -> Column:
        for part in item_path:
            x = x[part]
        return x

    types = F.array_join(F.transform(rec[array_field], leaf), sep)
    return F.concat(F.lit("Name: "), rec[name_field], F.lit("\nTypes: "), types)


def serialize_nested(df: DataFrame) -> DataFrame:
    """C11: every array / map / struct column becomes its JSON text; scalar
    columns are untouched (SURVEY S11: all nested columns, not only lists)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def avg_by_group(df: DataFrame, group: str, value: str, out: str = "avg_price", digits: int = 2) -> DataFrame:
    """Mean per group rounded to ``digits``, highest first."""
    return (df.groupBy(group).agg(F.round(F.avg(value), digits).alias(out))
              .orderBy(F.col(out).desc(), F.col(group)))
