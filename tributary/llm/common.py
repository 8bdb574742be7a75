"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tributary
from tributary.session import scratch_path

_shipped: set[str] = set()
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package: sent once per application,
    as a zip that Spark itself hands out (the driver's own temporary file)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tributary.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tributary-package-"), "tributary-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def tidy(run):
    """``run`` of a ``mapInArrow``; at its task's end the memory that Arrow and the C library
    keep for later goes back to the system.  Workers are reused, so what one stage
    left would otherwise count against the executor in all that follow."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):      # not the GNU C library
                pass

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Used where a result feeds several jobs: the work before it runs once, and
    an executor lost later costs only a re-read.  Shuffle files of the finished
    job are let go at once, so a chain of stages needs the disk of its largest.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: str | Column) -> Column:
    """Two independent 64-bit hashes of a text (null counts as empty): what
    tells rows with one id but different texts apart."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(7), t).alias("b"))
