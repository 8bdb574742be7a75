"""Mergeable distinct counts: a day costs a day.

One Theta sketch of the key per partition is kept in a Parquet table beside
the data.  A run sketches the partitions that are new or were reloaded, the
rest are merged from what is stored.  A sketch decides where an exact count is
due: a partition whose rows exceed what its sketch allows for distinct keys
has duplicates and is counted exactly; the others are not read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators.checks import _q

LG_ENTRIES = 14            # 16,384 hashes a sketch: 128 KB, relative standard error 0.78 %
DEVIATIONS = 3             # a sketch speaks for this many standard errors


def relative_error(lg_entries: int = LG_ENTRIES) -> float:
    """Relative standard error of an estimate; keys up to 2^lg_entries are counted exactly."""
    return (2 ** lg_entries - 1) ** -0.5


def _key_hash(columns: list[str]) -> Column:
    """64 bits of a key; NULLs count as a value, as in GROUP BY."""
    return F.xxhash64(*[_q(c) for c in columns], *[_q(c).isNull() for c in columns])


def sketch_partitions(df: DataFrame, part_col: str, columns: list[str], lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``part`` (text), ``rows``, ``sketch`` per value of ``part_col``.  Sketches are partial
    aggregates: a hot key or a hot partition sends one sketch a task to the shuffle."""
    return df.groupBy(_q(part_col).cast("string").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.theta_sketch_agg(_key_hash(columns), lg_entries).alias("sketch"))


def update_sketches(spark: SparkSession, path: str, df: DataFrame, part_col: str, columns: list[str],
                    lg_entries: int = LG_ENTRIES) -> None:
    """Sketch the partitions ``df`` holds and replace their rows in the table at ``path``, no others.
    ``df`` must hold those partitions whole.  ``columns`` and ``lg_entries`` must stay the same for a path."""
    made = sketch_partitions(df, part_col, columns, lg_entries).withColumn("day", F.coalesce("part", F.lit("")))
    (made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The stored sketches; no rows before the first update."""
    schema = "part string, rows long, sketch binary"
    try:
        return spark.read.schema(f"{schema}, day string").parquet(path).drop("day")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _bounds(lg_entries: int) -> list[Column]:
    error = DEVIATIONS * relative_error(lg_entries)
    estimated = F.col("estimate") > 2 ** lg_entries          # below that a sketch holds every key
    return [
        F.when(estimated, F.floor(F.col("estimate") / (1 + error))).otherwise(F.col("estimate")).cast("long").alias("at_least"),
        F.least(F.when(estimated, F.ceil(F.col("estimate") / (1 - error))).otherwise(F.col("estimate")).cast("long"), F.col("rows")).alias("at_most"),
    ]


def merged_distinct(sketches: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``rows``, ``estimate``, ``at_least``, ``at_most`` distinct keys over all the
    partitions given, from their sketches alone; no partitions, zeros."""
    one = sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                       F.coalesce(F.theta_sketch_estimate(F.theta_union_agg("sketch", lg_entries)), F.lit(0)).cast("long").alias("estimate"))
    return one.select("rows", "estimate", *_bounds(lg_entries))


def partition_estimates(sketches: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``part``, ``rows``, ``estimate``, ``at_least``, ``at_most``, ``flagged`` (more rows than the
    sketch allows for distinct keys) per partition."""
    each = sketches.select("part", "rows", F.theta_sketch_estimate("sketch").cast("long").alias("estimate"))
    return each.select("part", "rows", "estimate", *_bounds(lg_entries)).withColumn("flagged", F.col("rows") > F.col("at_most"))


def partition_duplicates(df: DataFrame, sketches: DataFrame, part_col: str, columns: list[str],
                         lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``part``, ``rows``, ``flagged``, ``duplicate_rows``, ``unseen_at_most`` per partition.

    Flagged partitions are counted exactly: only they are read (a filter on
    ``part_col``, so that stored partitions are pruned), with the key's group-by.
    In the others the sketch found no duplicates; up to ``unseen_at_most`` rows
    may be, 0 where the sketch held every key.  The list of flagged partitions,
    at most one value a partition, is what reaches the driver."""
    parts = partition_estimates(sketches, lg_entries)
    flagged = [r["part"] for r in parts.where("flagged").select("part").collect()]
    named = [p for p in flagged if p is not None]
    some = F.lit(False)
    if named:
        kind = df.schema[part_col].dataType
        some = some | _q(part_col).isin([F.lit(p).cast(kind) for p in named])
    if None in flagged:
        some = some | _q(part_col).isNull()
    part = _q(part_col).cast("string")
    exact = (df.where(some).groupBy(part.alias("p"), *[_q(c).alias(f"k{i}") for i, c in enumerate(columns)]).agg(F.count(F.lit(1)).alias("n"))
             .groupBy("p").agg((F.sum("n") - F.count(F.lit(1))).alias("d")))
    return parts.join(exact, F.col("part").eqNullSafe(F.col("p")), "left").select(
        "part", "rows", "flagged", F.coalesce("d", F.lit(0)).cast("long").alias("duplicate_rows"),
        F.when(F.col("flagged") | (F.col("estimate") <= 2 ** lg_entries), F.lit(0))
        .otherwise(F.greatest(F.col("rows") - F.col("at_least"), F.lit(0))).cast("long").alias("unseen_at_most"))
