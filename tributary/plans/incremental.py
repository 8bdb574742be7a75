"""Incremental gold models: a day costs a day.

The fact is stored by the partition its complaints landed in, a dimension by
buckets of its key.  What changed decides what is rewritten: new or reloaded
partitions of the unified complaints, and those partitions of the fact that
hold a customer or an agent whose dimension row changed.  Rows elsewhere are
neither read whole nor written; the result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.plans.models import _orderable, _q, fct_complaints, latest_per_key
from tributary.session import scratch_path

BUCKETS = 64
ROWS = 500_000     # rows of one partition that a task writes, about


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write ``df``, replacing the partitions it holds and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def partition_counts(df: DataFrame, column: str) -> dict:
    """Rows of each partition; as many values as there are partitions."""
    return {r[column]: r["n"] for r in df.groupBy(_q(column)).agg(F.count(F.lit(1)).alias("n")).collect()}


def dealt_by_partition(df: DataFrame, column: str, counts: dict, rows: int = ROWS) -> DataFrame:
    """``df`` dealt for a write partitioned by ``column``: a partition goes to one task, one
    of more than ``rows`` rows (by ``counts``) to several by a hash of the row, so that no
    task's share grows with a partition, whichever mappers its rows come from."""
    pieces = {v: -(-n // rows) for v, n in counts.items() if v is not None and n > rows}
    tasks = max(1, -(-2 * sum(counts.values()) // rows))
    if not pieces:
        return df.repartition(tasks, _q(column))
    of = F.create_map(*[F.lit(x) for pair in pieces.items() for x in pair])
    piece = F.pmod(F.xxhash64(*[_q(c) for c in df.columns if _orderable(df.schema[c].dataType)]), F.coalesce(of[_q(column)], F.lit(1)))
    return df.repartition(tasks, _q(column), piece)


def update_dimension(spark: SparkSession, path: str, delta: DataFrame, key: str, order_cols: list[str], tracked: list[str],
                     buckets: int = BUCKETS) -> DataFrame:
    """Fold ``delta`` into the dimension at ``path`` (M5) and return the keys (one
    column ``key``) whose ``tracked`` columns are new or differ.

    The latest row per key is associative, so the stored rows and the delta's
    give what all rows ever seen would.  Only the buckets of the delta's keys
    are read and rewritten.  Rows with a NULL key are left out.  ``buckets`` must stay the same for a path."""
    delta = delta.where(_q(key).isNotNull()).withColumn("bucket", F.pmod(F.xxhash64(_q(key)), F.lit(buckets)).cast("int"))
    old = _stored(spark, path)
    if old is not None:
        touched = [r["bucket"] for r in delta.select("bucket").distinct().collect()]       # at most ``buckets``
        old = old.where(F.col("bucket").isin(touched)) if touched else old.where("false")
    both = delta if old is None else old.unionByName(delta, allowMissingColumns=True)
    new_path = scratch_path(spark, "dimension")
    latest_per_key(both, key, order_cols).write.parquet(new_path)
    new = spark.read.parquet(new_path)
    before = new.where("false").select(key, *tracked) if old is None else old.select(key, *tracked)
    before = before.select(_q(key).alias("__key"), F.struct(*[_q(c) for c in tracked]).alias("__was"))
    after = new.select(_q(key).alias("key"), F.struct(*[_q(c) for c in tracked]).alias("__is"))
    changed_path = scratch_path(spark, "changed-keys")
    (after.join(before, after["key"] == before["__key"], "left").where(F.col("__key").isNull() | ~F.col("__is").eqNullSafe(F.col("__was")))
     .select("key").write.parquet(changed_path))
    if new.isEmpty():
        return spark.read.schema(after.select("key").schema).parquet(changed_path)
    _replace_partitions(new.hint("rebalance", F.col("bucket")), path, "bucket")
    return spark.read.schema(after.select("key").schema).parquet(changed_path)


def affected_partitions(fact: DataFrame | None, part_col: str, changed: dict[str, DataFrame | None]) -> list[str]:
    """The fact's partitions that hold a changed key (``changed``: fact column -> keys); reads the
    key columns only.  As many values as the fact has partitions at most."""
    found: set[str] = set()
    for column, keys in changed.items():
        if fact is not None and keys is not None:
            hit = fact.select(part_col, column).join(keys.select(F.col("key").alias(column)), column, "left_semi")
            found |= {r[part_col] for r in hit.select(part_col).distinct().collect()}
    return sorted(found)


def refresh_fact(spark: SparkSession, unified: DataFrame, customers_dim: DataFrame, agents_dim: DataFrame, path: str, parts: list[str],
                 part_col: str = "part", changed_customers: DataFrame | None = None, changed_agents: DataFrame | None = None) -> list[str]:
    """Bring the fact at ``path`` up to date and return the partitions rewritten.

    ``unified``: the unified complaints with their partition ``part_col`` (text), stored by it, so
    that the filter below prunes.  ``parts``: partitions whose complaints are new or were reloaded.
    ``changed_*``: keys of changed dimension rows.  A partition that has no
    complaints any more is removed.  Partitions not named are not written."""
    fact = _stored(spark, path)
    todo = sorted({*parts, *affected_partitions(fact, part_col, {"customer_id": changed_customers, "agent_id": changed_agents})})
    if not todo:
        return []
    rows = unified.where(F.col(part_col).isin(todo))
    made = fct_complaints(rows, customers_dim, agents_dim, keep=[part_col])
    left = partition_counts(rows, part_col)
    if left:
        _replace_partitions(dealt_by_partition(made, part_col, left), path, part_col)
    for gone in (set(todo) - left.keys() if fact is not None else ()):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part_col}={gone}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return todo
