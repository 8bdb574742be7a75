"""Versioned tables: readers see the table before or after a change."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from tributary.sinks import versioned
from tributary.sinks.versioned import read_version, snapshots, vacuum, write_version


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def day(spark, d, ids, extra=""):
    return spark.createDataFrame([(i, f"x{i}{extra}", d) for i in ids], "id long, v string, day string")


def test_a_write_that_dies_leaves_the_old_table(spark, tmp, monkeypatch):
    path = f"{tmp}/t"
    write_version(spark.range(100), path)
    dying = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id") + 1).alias("id"))
    with pytest.raises(Exception, match="killed"):
        write_version(dying, path)
    assert read_version(spark, path).count() == 100 and snapshots(spark, path) == [1]

    def gone(*a):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(versioned, "_add_snapshot", gone)       # all data written, the snapshot not
    with pytest.raises(RuntimeError):
        write_version(spark.range(7), path)
    monkeypatch.undo()
    assert read_version(spark, path).count() == 100
    assert len(vacuum(spark, path, keep=1, older_than_hours=-1)) == 2
    assert read_version(spark, path).count() == 100


def test_an_open_reader_keeps_its_snapshot(spark, tmp):
    path = f"{tmp}/t"
    write_version(spark.range(10), path)
    reader = read_version(spark, path)
    assert write_version(spark.range(3), path) == {"status": "success", "path": path, "rows": 3, "snapshot": 2}
    assert reader.count() == 10 and read_version(spark, path).count() == 3 and read_version(spark, path, 1).count() == 10
    write_version(read_version(spark, path).where("id > 0"), path)       # a table rewritten from itself
    assert rows(read_version(spark, path)) == [(1,), (2,)]


def test_partitions_are_replaced_together(spark, tmp):
    path = f"{tmp}/t"
    write_version(day(spark, "d1", [1, 2]).unionByName(day(spark, "d2", [3])).unionByName(day(spark, None, [4])), path, ["day"])
    write_version(day(spark, "d2", [5, 6], "new").unionByName(day(spark, "a=b/c", [7])), path, ["day"], mode="partitions")
    assert rows(read_version(spark, path)) == [(1, "x1", "d1"), (2, "x2", "d1"), (4, "x4", None), (5, "x5new", "d2"), (6, "x6new", "d2"), (7, "x7", "a=b/c")]
    assert "PartitionFilters: [isnotnull(day" in plan_text(read_version(spark, path).where("day = 'd2'"))
    write_version(day(spark, "d3", [8]).withColumn("late", F.lit(1)), path, ["day"], mode="partitions")
    assert read_version(spark, path).where("late = 1").count() == 1 and read_version(spark, path).where("late is null").count() == 6
    with pytest.raises(TypeError, match="column v"):
        write_version(day(spark, "d3", [8]).withColumn("v", F.lit(1)), path, ["day"], mode="partitions")
    assert snapshots(spark, path) == [1, 2, 3]


def test_two_writers_lose_nothing(spark, tmp, monkeypatch):
    path = f"{tmp}/t"
    write_version(day(spark, "d1", [1]), path, ["day"])
    add, raced = versioned._add_snapshot, []

    def slow(*a):
        if not raced:                                            # another writer commits first
            raced.append(1)
            write_version(day(spark, "d2", [2]), path, ["day"], mode="partitions")
        return add(*a)

    monkeypatch.setattr(versioned, "_add_snapshot", slow)
    assert write_version(day(spark, "d3", [3]), path, ["day"], mode="partitions")["snapshot"] == 3
    assert [r[0] for r in rows(read_version(spark, path))] == [1, 2, 3]


def test_no_rows_and_no_table(spark, tmp):
    with pytest.raises(FileNotFoundError):
        read_version(spark, f"{tmp}/none")
    for cols in ([], ["day"]):
        path = f"{tmp}/t{len(cols)}"
        assert write_version(day(spark, "d1", []), path, cols)["rows"] == 0
        back = read_version(spark, path)
        assert back.collect() == [] and back.columns == ["id", "v", "day"]
    write_version(day(spark, "d1", [1]), f"{tmp}/t1", ["day"], mode="partitions")
    assert rows(read_version(spark, f"{tmp}/t1")) == [(1, "x1", "d1")]
    with pytest.raises(ValueError):
        write_version(day(spark, "d1", [1]), path, mode="partitions")
