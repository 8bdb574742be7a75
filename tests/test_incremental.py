"""Incremental models against the full rebuild."""

import glob
import os
import re

from pyspark.sql import functions as F

from conftest import plan_text
from tributary.plans import models
from tributary.plans.incremental import refresh_fact, update_dimension

COLUMNS = "complaint_id string, source_system string, customer_id string, agent_id string, category string, resolution_status string, opened_at timestamp_ntz, closed_at timestamp_ntz, channel string, part string"


def complaints(spark, part, ids):
    return spark.createDataFrame([(f"c{i}", "s", f"u{i % 7}" if i % 5 else None, f"a{i % 3}", "x", "open", None, None, "call", part) for i in ids], COLUMNS)


def stamps(path):
    return {os.path.relpath(p, path): os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/*/*.parquet")}


def parts_rewritten(before, path):
    after = stamps(path)
    return {os.path.dirname(p) for p in after if p not in before} | {os.path.dirname(p) for p in before if p not in after}


def test_second_day_rewrites_its_partitions_only(spark, tmp):
    customers, agents, unified, fact = (f"{tmp}/{n}" for n in ("customers", "agents", "unified", "fact"))

    def people(rows, v):
        return spark.createDataFrame([(k, n, v) for k, n in rows], "id string, name string, version int")

    def run(parts, new_customers, new_agents, v):
        changed = [update_dimension(spark, path, people(rows, v).withColumnRenamed("id", key), key, ["version"], ["name"], buckets=8)
                   for path, rows, key in ((customers, new_customers, "customer_id"), (agents, new_agents, "agent_id"))]
        done = refresh_fact(spark, spark.read.parquet(unified), spark.read.parquet(customers), spark.read.parquet(agents), fact, parts,
                            changed_customers=changed[0], changed_agents=changed[1])
        return done, [sorted(r.key for r in c.collect()) for c in changed]

    def rebuilt():
        out = models.fct_complaints(spark.read.parquet(unified), spark.read.parquet(customers), spark.read.parquet(agents), keep=["part"])
        return sorted(map(tuple, out.collect()), key=repr)

    def stored():
        df = spark.read.parquet(fact)
        return sorted(map(tuple, df.select("complaint_id", "source_system", "customer_id", "customer_name", "agent_id", "agent_name", "category", "resolution_status", "opened_at",
                                           "closed_at", "resolution_seconds", "channel", "part").collect()), key=repr)

    complaints(spark, "d1", range(0, 4)).unionByName(complaints(spark, "d2", range(4, 8))).write.partitionBy("part").parquet(unified)
    done, changed = run(["d1", "d2"], [(f"u{i}", f"U{i}") for i in range(6)] + [(None, "nobody")], [(f"a{i}", f"A{i}") for i in range(3)], 1)
    assert done == ["d1", "d2"] and changed[0] == [f"u{i}" for i in range(6)]
    assert stored() == rebuilt()

    # a new day, no dimension changed: only that day
    complaints(spark, "d3", range(8, 12)).write.partitionBy("part").mode("append").parquet(unified)
    before = stamps(fact)
    done, changed = run(["d3"], [("u1", "U1")], [], 2)
    assert done == ["d3"] and changed == [[], []] and parts_rewritten(before, fact) == {"part=d3"}
    assert stored() == rebuilt()

    # a customer's name and a late customer: the days that hold them
    before = stamps(fact)
    done, changed = run([], [("u4", "New name"), ("u6", "Late")], [], 3)
    assert changed[0] == ["u4", "u6"] and done == ["d2", "d3"] and parts_rewritten(before, fact) == {"part=d2", "part=d3"}
    assert stored() == rebuilt()

    # an older version of a customer changes nothing; a reloaded day that is empty goes
    before = stamps(fact)
    done, changed = run([], [("u4", "Old name")], [], 0)
    assert done == [] and changed[0] == [] and parts_rewritten(before, fact) == set()
    refresh_fact(spark, spark.read.parquet(unified).where("part <> 'd1'"), spark.read.parquet(customers), spark.read.parquet(agents), fact, ["d1"])
    assert {r.part for r in spark.read.parquet(fact).select("part").distinct().collect()} == {"d2", "d3"}


def test_refresh_reads_the_named_partitions(spark, tmp):
    complaints(spark, "d1", range(4)).write.partitionBy("part").parquet(f"{tmp}/u")
    plan = plan_text(models.fct_complaints(spark.read.parquet(f"{tmp}/u").where(F.col("part").isin("d1")),
                                           spark.createDataFrame([("u1", "x")], "customer_id string, name string"), spark.createDataFrame([("a1", "x")], "agent_id string, name string"), keep=["part"]))
    assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ = d1", plan)


def test_a_large_partition_is_dealt_over_tasks(spark, tmp):
    rows = complaints(spark, "big", range(4000)).unionByName(complaints(spark, "small", range(40))).coalesce(1)      # one mapper holds all
    from tributary.plans.incremental import dealt_by_partition, partition_counts
    counts = partition_counts(rows, "part")
    assert counts == {"big": 4000, "small": 40}
    dealt = dealt_by_partition(rows, "part", counts, rows=200)
    tasks = dealt.select("part", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert max(r["count"] for r in tasks) <= 1200 and len(tasks) > 5
    assert dealt.where("part = 'small'").select(F.spark_partition_id()).distinct().count() == 1
    assert sorted(dealt.collect(), key=repr) == sorted(rows.collect(), key=repr)
