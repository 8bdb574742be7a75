"""Spark session defaults and the shared scratch area.

Everything the library writes as an intermediate (round-trip fixtures,
lineage cuts) goes under the folder the cluster names in
``spark.checkpoint.dir``.  The setting is read from the session; a local
folder is only chosen when it is unset, which is the case in tests and on a
laptop.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job in this library relies on.
#  * AQE re-plans joins and aggregates from runtime sizes: small shuffle
#    outputs become broadcast joins, skewed partitions are split.
#  * Dynamic partition overwrite replaces only the partitions a write touches
#    (daily re-runs stay idempotent).
#  * Snappy is the codec the landing layer is specified with.
#  * Arrow moves driver-side lists (file paths) into Spark in batches.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tributary",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster, pass nothing for ``master`` and let spark-submit decide;
    ``shuffle_partitions`` should then be sized so one partition of the
    largest shuffle fits an executor core's memory (AQE coalesces upward).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local session (tests, a laptop) gets a
    temporary folder of its own when the setting is absent; on a cluster a
    machine-local folder would be invisible to the executors, so a missing
    setting is an error there.
    """
    current = None
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext handle (e.g. a remote session)
        current = None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/object store) "
                               "for lineage cuts and staged tables")
        configured = tempfile.mkdtemp(prefix="tributary-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    try:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    except Exception:
        return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/tributary/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan is re-read several times or grows long; never
    ``localCheckpoint`` (executor-local blocks die with the executor).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can open the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def as_uri(path: str) -> str:
    """Absolute local paths become ``file:`` URIs; URIs pass through."""
    if "://" in path or path.startswith("file:"):
        return path
    return "file://" + os.path.abspath(path)
