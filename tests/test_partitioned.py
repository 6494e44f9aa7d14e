"""Size-bounded layout (B2, B3, B5), partition-scoped upserts (M3, H4), publication."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tryline.operators import profile
from tryline.sinks import partitioned, publication
from tryline.sinks.partitioned import PartitionedTable, partitioned_clustered
from tryline.sinks.publication import Publication, current

DAY = dt.date(2024, 1, 1)


def _days(spark, hot=20000, small=40):
    """One day with most rows, half of them of one team, and many small days."""
    rows = spark.range(hot).select(
        F.lit(DAY).alias("game_date"), F.when(F.col("id") % 2 == 0, "t0").otherwise(F.concat(F.lit("t"), (F.col("id") % 97).cast("string"))).alias("team_id"),
        F.format_string("m%06d", "id").alias("match_id"), F.rand(1).alias("score"))
    others = spark.range(small * 5).select(
        F.date_add(F.lit(DAY), (F.col("id") % small + 1).cast("int")).alias("game_date"), F.lit("t1").alias("team_id"),
        F.format_string("s%06d", "id").alias("match_id"), F.rand(2).alias("score"))
    return rows.unionByName(others).repartition(5)


def test_hot_day_is_several_bounded_files_with_disjoint_ranges(spark, tmp_path):
    df, target = _days(spark), 64 << 10
    partitioned_clustered(df, str(tmp_path / "t"), "game_date", ["team_id", "match_id"], target_bytes=target)
    files = sorted((tmp_path / "t").glob("game_date=*/*.parquet"))
    assert max(f.stat().st_size for f in files) <= target
    hot = [f for f in files if f.parent.name == "game_date=2024-01-01"]
    assert len(hot) >= 10
    ranges = []
    for f in hot:
        t = pq.read_table(f, columns=["team_id", "match_id"]).to_pylist()
        keys = [(r["team_id"], r["match_id"]) for r in t]
        assert keys == sorted(keys)
        ranges.append((keys[0], keys[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    # small days share tasks: one file, or two where a task ends
    per_day = {}
    for f in files:
        per_day.setdefault(f.parent.name, []).append(f)
    assert sum(len(v) > 1 for k, v in per_day.items() if k != "game_date=2024-01-01") <= 3
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == df.count() and back.exceptAll(df.select(back.columns)).count() == 0
    # file skipping by the cluster key: a team's rows are in few of the hot day's files
    assert sum(1 for lo, hi in ranges if lo[0] <= "t50" <= hi[0]) <= 2


def test_layout_summary_of_footers(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 3).alias("part"), F.col("id").alias("k"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    partitioned.write_bounded(df, str(tmp_path / "t"), ["part"], ["k"], target_bytes=8 << 10)
    stats = profile.row_group_stats(spark, str(tmp_path / "t"))
    got = {r["partition_value"]: r for r in profile.layout_summary(stats, "part", "k").collect()}
    assert {p: (r["rows"], r["min_value"], r["max_value"], r["depth"]) for p, r in got.items()} == {
        "0": (1667, 0, 4998, 1), "1": (1667, 1, 4999, 1), "2": (1666, 2, 4997, 1)}
    assert all(r["files"] > 2 for r in got.values())
    nulls = {r["partition_value"]: r["nulls"] for r in profile.layout_summary(stats, "part", "v").collect()}
    assert nulls == {str(p): sum(1 for i in range(5000) if i % 3 == p and i % 10 == 0) for p in range(3)}
    # the same rows unclustered overlap
    df.repartition(4).write.partitionBy("part").parquet(str(tmp_path / "u"))
    mixed = profile.layout_summary(profile.row_group_stats(spark, str(tmp_path / "u")), "part", "k").collect()
    assert all(r["depth"] == 4 for r in mixed)


SCHEMA = "match_id string, name string, game_date date"


def _table(spark, tmp_path, **more):
    from pyspark.sql.types import _parse_datatype_string
    return PartitionedTable(spark, str(tmp_path / "table"), _parse_datatype_string(SCHEMA), "match_id", **more)


def _batch(spark, *rows):
    return spark.createDataFrame([(m, n, d and DAY + dt.timedelta(days=d - 1)) for m, n, d in rows], SCHEMA)


def _rows(table):
    return sorted(((r["match_id"], r["name"], r["game_date"] and (r["game_date"] - DAY).days + 1) for r in table.read().collect()), key=str)


def _files(tmp_path):
    return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("*.parquet")}


def test_batch_of_one_day_leaves_other_partitions(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.upsert(_batch(spark, ("a", "1", 1), ("b", "1", 2), ("c", "1", 3), ("n", "1", None), (None, "no key", 1)))
    before = _files(tmp_path)
    assert table.upsert(_batch(spark, ("b", "2", 2), ("d", "2", 2))) == [DAY + dt.timedelta(days=1)]
    after = _files(tmp_path)
    same = {k for k in before if before[k] == after.get(k)}
    assert {k.split("/")[1] for k in same} == {"game_date=2024-01-01", "game_date=2024-01-03", "game_date=__HIVE_DEFAULT_PARTITION__"}
    assert _rows(table) == sorted([("a", "1", 1), ("b", "1", 2), ("c", "1", 3), ("d", "2", 2), ("n", "1", None)], key=str)
    # the same batch again changes no row
    table.upsert(_batch(spark, ("b", "2", 2), ("d", "2", 2)))
    assert len(_rows(table)) == 5


def test_corrected_date_moves_the_row(spark, tmp_path):
    """With prefer=new a row leaves the partition it was in, which may become empty; with prefer=existing it stays."""
    table = _table(spark, tmp_path, prefer="new")
    table.upsert(_batch(spark, ("a", "1", 1), ("b", "1", 2), ("c", "1", 2), ("n", "1", None)))
    table.upsert(_batch(spark, ("a", "moved", 5), ("n", "dated", 6)))
    assert _rows(table) == [("a", "moved", 5), ("b", "1", 2), ("c", "1", 2), ("n", "dated", 6)]
    old = _table(spark, tmp_path, prefer="existing")
    old.upsert(_batch(spark, ("b", "again", 9)))
    assert ("b", "1", 2) in _rows(old) and len(_rows(old)) == 4


def test_upsert_cut_off_in_the_swap_is_finished(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path, prefer="new")
    table.upsert(_batch(spark, ("a", "1", 1), ("b", "1", 2)))
    monkeypatch.setattr(partitioned, "write_bounded", _die)
    with pytest.raises(RuntimeError):
        table.upsert(_batch(spark, ("a", "2", 4)))
    monkeypatch.undo()
    assert _rows(table) == [("a", "1", 1), ("b", "1", 2)]        # nothing swapped yet
    assert _table(spark, tmp_path).recover()
    assert _rows(table) == [("a", "2", 4), ("b", "1", 2)]
    assert not table.recover()


def _die(*args, **kwargs):
    raise RuntimeError("killed")


@pytest.mark.parametrize("step", ["first table", "second table", "gate", "marker", "retention"])
def test_run_killed_at_any_step_leaves_the_last_version(spark, tmp_path, monkeypatch, step):
    """The same day again: readers see all of the old version, or all of the new."""
    root = str(tmp_path / "marts")

    def run(value, die=None):
        version = Publication(spark, root, "20260420")
        frame = spark.createDataFrame([(value,)], "v int")
        for name in ("one", "two"):
            if die == ("first table" if name == "one" else "second table"):
                version.write(frame, name, lambda df, path: (df.write.parquet(path + "/half"), _die()))
            version.write(frame, name)
        if die == "gate":
            _die()
        version.publish(keep=1)

    run(1)
    if step == "marker":
        monkeypatch.setattr(publication, "_put", _die)
    if step == "retention":
        monkeypatch.setattr(publication, "drop_materialized", _die)
    with pytest.raises(RuntimeError):
        run(2, step)
    monkeypatch.undo()
    want = 2 if step == "retention" else 1
    got = current(spark, root)
    assert [got.read(n).first()["v"] for n in ("one", "two")] == [want, want]
    run(3)
    got = current(spark, root)
    assert [got.read(n).first()["v"] for n in ("one", "two")] == [3, 3]
    # what was older, published or not, is gone
    assert {p.name for p in (tmp_path / "marts").glob("*/v=*")} == {f"v={got.version}"}
    assert [p.name for p in (tmp_path / "marts" / "_published").glob("*.json")] == [f"{got.version}.json"]


def test_failing_gate_publishes_nothing(spark, tmp_path):
    from tryline.operators.quality import QualityGateError
    from tryline.plans.daily import build_marts
    from tryline.sources.fixtures import RawTables

    class Twice(RawTables):
        @property
        def match_details(self):
            return super().match_details.unionByName(super().match_details.limit(3))

    raw, root = RawTables(spark, "/root/testdata/sf0.001"), str(tmp_path / "marts")
    first, report = build_marts(spark, raw, root, "20260420")
    assert report.count() == 29 and report.where("failures > 0").count() == 0
    with pytest.raises(QualityGateError):
        build_marts(spark, Twice(spark, "/root/testdata/sf0.001"), root, "20260420")
    assert current(spark, root).version == first.version


def test_empty_table_is_publishable(spark, tmp_path):
    version = Publication(spark, str(tmp_path), "20260420")
    version.write(spark.createDataFrame([], SCHEMA), "t", lambda d, p: partitioned_clustered(d, p, "game_date", ["match_id"]))
    version.publish()
    assert current(spark, str(tmp_path)).read("t").count() == 0
    with pytest.raises(FileNotFoundError):
        current(spark, str(tmp_path)).read("unknown")
