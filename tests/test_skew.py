"""A key holding a third of all rows (derived from events by Spark)."""

import os

from pyspark.sql import functions as F

from conftest import SF01, plan_text
from tributary.operators import checks, quality
from tributary.plans import models
from tributary.plans.standins import table
from tributary.sinks.lake import write_dated


def _hot(spark):
    ev = table(spark, SF01, "events")
    # clicks and errors (about 40% of all events) belong to user 0 and to
    # 2024-01-05: one key and one day hold a large share of the rows
    hot = F.col("event_type").isin("click", "error")
    return ev.select(
        "event_id", "event_type",
        F.when(hot, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot, F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ts"),
    )


def test_hot_key_latest_row_and_checks(spark):
    df = _hot(spark)
    got = {r.user_id: r.event_id for r in models.latest_per_key(df, "user_id", ["ts", "event_id"]).collect()}
    pdf = df.toPandas().sort_values(["user_id", "ts", "event_id"])
    want = pdf.groupby("user_id").tail(1).set_index("user_id")["event_id"].to_dict()
    assert got == want
    assert "Window" not in plan_text(models.latest_per_key(df, "user_id", ["ts", "event_id"]))
    dup = quality.validate_no_duplicates(df, ["user_id"]).first().metric
    assert dup == df.count() - df.select("user_id").distinct().count()
    orphans = checks.relationship_orphans(df, "user_id", table(spark, SF01, "customer"), "c_custkey")
    assert orphans.count() == 0


def test_hot_day_is_split_across_tasks(spark, tmp):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        # many input splits, as a large source has (AQE splits a hot
        # partition along map outputs)
        write_dated(_hot(spark).repartition(8), tmp, "events", "ts")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_dir = f"{tmp}/raw/events/year=2024/month=1/day=5"
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1  # the dominant day was written by several tasks
    back = spark.read.parquet(f"{tmp}/raw/events")
    assert back.count() == _hot(spark).count()


def test_rows_without_a_key_spread_over_the_tasks(spark):
    """A third of the rows NULL, a third one key: the join's partitions stay even for the NULLs, and nothing is lost."""
    from tributary.plans.models import left_join_spread
    left = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.range(9000).select(F.col("id").cast("string").alias("rk"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "rk string, v long"))
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(name, value)
    try:
        out = left_join_spread(left, right, "k", "rk")
        per_task = out.where("k is null").groupBy(F.spark_partition_id()).count().collect()
        got = {r.id: r.v for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 1000
    assert got == {i: (None if i % 3 == 0 else -1 if i % 3 == 1 else 2 * i) for i in range(9000)}
    assert out.columns == ["id", "k", "rk", "v"]
