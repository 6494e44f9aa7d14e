"""Post-load validation: what was loaded, how much, from when to when, and how it lies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tryline.operators import profile
from tryline.plans.landing import LAYOUT
from tryline.sinks.publication import Published
from tryline.sinks.writers import export_json, materialize

#: Fixed value: rows of a result's exported sample.
SAMPLE = 200


@dataclass
class Validation:
    results: dict[str, DataFrame]
    root: str

    @property
    def problems(self) -> list[str]:
        """Tables that are empty, and days whose files overlap in the cluster key more than two deep."""
        empty = [f"{r['table_name']} is empty" for r in self.results["row_counts"].where("row_count = 0").collect()]
        layout = self.results["layout"].where("depth > 2").groupBy("table_name").count().collect()
        return empty + [f"{r['table_name']}: {r['count']} partitions overlap" for r in layout]


def inventory(load: Published) -> DataFrame:
    """E9 + E11 over a published load: table, ordinal, column, type."""
    rows = [(name, i + 1, f["name"], f["type"] if isinstance(f["type"], str) else f["type"]["type"])
            for name, schema in sorted(load.schemas.items()) for i, f in enumerate(schema["fields"])]
    return load.spark.createDataFrame(rows, "table_name string, ordinal_position int, column_name string, data_type string")


def validate_load(spark: SparkSession, load: Published, out_dir: str, date_col: str = "game_date", id_col: str = "team_id") -> Validation:
    """Validate a published load of the raw tables and export each result as JSON below ``out_dir``.

    Row counts and layout come from footers alone; only the date bounds and
    the distinct teams read data (two columns of team stats).
    """
    root = out_dir.rstrip("/")
    counts, layouts = [], []
    for name in sorted(load.schemas):
        stats = materialize(spark, profile.row_group_stats(spark, load.path(name), "part-*.parquet"), "row_groups")
        groups = stats.select("path", "row_group", "rows").distinct()
        counts.append(groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
        if name in LAYOUT:
            partition, cluster = LAYOUT[name]
            layouts.append(profile.layout_summary(stats, partition, cluster[0], "string")
                           .select(F.lit(name).alias("table_name"), F.lit(partition).alias("partition_column"), F.lit(cluster[0]).alias("cluster_column"),
                                   "partition_value", "files", "rows", "nulls", "min_value", "max_value", "depth"))
    results = {"inventory": inventory(load), "row_counts": _stack(counts),
               "date_bounds": profile.date_bounds(load.read("team_stats"), date_col, id_col), "layout": _stack(layouts)}
    order = {"inventory": ("table_name", "ordinal_position"), "row_counts": ("table_name",), "date_bounds": (),
             "layout": ("table_name", "partition_value")}
    for name, df in results.items():
        export_json(df, f"{root}/{name}", order_by=order[name], limit=SAMPLE if name == "layout" else None)
    return Validation(results, root)


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
