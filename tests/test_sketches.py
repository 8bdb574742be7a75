"""Mergeable distinct sketches and checksum comparison against exact counts."""

import os

from pyspark.sql import functions as F

from conftest import plan_text
from tributary.operators import checksums, sketches
from tributary.operators.checks import cross_source_consistency, uniqueness


def days(spark, n=60_000):
    """Two clean days, one with many repeats, one without a date that repeats a key."""
    clean = spark.range(n).select(F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("day"), F.col("id").alias("k"))
    hot = spark.range(n).select(F.lit("d2").alias("day"), F.when(F.col("id") < n // 3, F.lit(7)).otherwise(F.col("id") + 10 * n).alias("k"))
    undated = spark.createDataFrame([(None, None), (None, None), (None, 5)], "day string, k long")
    return clean.unionByName(hot).unionByName(undated)


def test_duplicates_exact_where_flagged(spark, tmp):
    df = days(spark)
    sketches.update_sketches(spark, f"{tmp}/s", df, "day", ["k"])
    got = {r.part: r for r in sketches.partition_duplicates(df, sketches.read_sketches(spark, f"{tmp}/s"), "day", ["k"]).collect()}
    assert {p: (r.rows, r.flagged, r.duplicate_rows) for p, r in got.items()} == {
        "d0": (30_000, False, 0), "d1": (30_000, False, 0), "d2": (60_000, True, 19_999), None: (3, True, 1)}
    assert 0 < got["d0"].unseen_at_most < 30_000 * 2 * sketches.DEVIATIONS * sketches.relative_error()
    assert got["d2"].unseen_at_most == got[None].unseen_at_most == 0


def test_merged_estimate_within_its_error(spark, tmp):
    df = days(spark)
    sketches.update_sketches(spark, f"{tmp}/s", df, "day", ["k"])
    merged = sketches.merged_distinct(sketches.read_sketches(spark, f"{tmp}/s")).first()
    exact = uniqueness(df, ["k"]).first()
    assert merged.rows == exact.rows and merged.at_least <= exact.distinct_keys <= merged.at_most
    assert abs(merged.estimate / exact.distinct_keys - 1) <= sketches.DEVIATIONS * sketches.relative_error()
    few = sketches.merged_distinct(sketches.sketch_partitions(df.where("k < 9000 or k is null"), "day", ["k"])).first()
    assert few.estimate == few.at_least == few.at_most == 9001          # a sketch that holds every key is exact


def test_a_day_costs_a_day(spark, tmp):
    path = f"{tmp}/s"
    sketches.update_sketches(spark, path, days(spark), "day", ["k"])
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if "day=" in d}
    sketches.update_sketches(spark, path, spark.range(10).select(F.lit("d1").alias("day"), F.col("id").alias("k")), "day", ["k"])
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if "day=" in d}
    kept = {f for f in before if after.get(f) == before[f]}
    assert len([f for f in before if f.endswith(".parquet") and f not in kept]) == 1
    assert {r.part: r.rows for r in sketches.read_sketches(spark, path).collect()} == {"d0": 30_000, "d1": 10, "d2": 60_000, None: 3}


def test_exact_count_reads_flagged_partitions_only(spark, tmp):
    days(spark).write.partitionBy("day").parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    made = sketches.sketch_partitions(df.where("day in ('d0', 'd2')"), "day", ["k"])
    plan = plan_text(sketches.partition_duplicates(df, made, "day", ["k"]))
    assert "PartitionFilters: [isnotnull(day" in plan and "d2" in plan


def test_sketches_of_keys_with_nulls_and_of_nothing(spark, tmp):
    df = spark.createDataFrame([("a", None, 5), ("a", 5, None), ("a", None, None), ("a", 5, None)], "d string, x long, y long")
    assert sketches.partition_duplicates(df, sketches.sketch_partitions(df, "d", ["x", "y"]), "d", ["x", "y"]).first().duplicate_rows == 1
    none = sketches.read_sketches(spark, f"{tmp}/nowhere")
    assert none.count() == 0 and tuple(sketches.merged_distinct(none).first()) == (0, 0, 0, 0)
    assert sketches.partition_duplicates(df.limit(0), none, "d", ["x"]).collect() == []


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_differences_are_those_of_the_full_join(spark):
    a = spark.range(5000).select((F.col("id") % 900).alias("k")).unionByName(spark.createDataFrame([(None,), (None,), (-1,)], "k long"))
    b = a.where("k is null or (k <> 17 and k <> 400)").unionByName(spark.createDataFrame([(None,), (3,), (10_000,)], "k long"))
    for bits in (2, 10, 16):
        got = rows(checksums.consistency_differences(a, "k", b, "k", bits=bits))
        assert got == rows(cross_source_consistency(a, "k", b, "k").where("not n_left <=> n_right")) and len(got) == 5


def test_equal_sources_shuffle_no_key(spark):
    a = spark.range(0, 20_000, 1, 4).select((F.col("id") % 3000).alias("k"))
    b = a.repartition(3).orderBy(F.col("k").desc())
    out = checksums.consistency_differences(a, "k", b, "k")
    assert out.collect() == []
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "EmptyRelation" in final.split("== Initial Plan ==")[0]


def test_checksums_add_up(spark):
    a = spark.range(1000).select((F.col("id") % 77).alias("k"))
    parts = checksums.key_checksums(a.where("k < 30"), "k").unionByName(checksums.key_checksums(a.where("k >= 30"), "k"))
    assert rows(checksums.merge_checksums(parts)) == rows(checksums.key_checksums(a, "k"))
    empty = a.limit(0)
    assert rows(checksums.consistency_differences(a, "k", empty, "k")) == rows(cross_source_consistency(a, "k", empty, "k"))
    assert checksums.consistency_differences(empty, "k", empty, "k").collect() == []
