"""Backfill over a date range.

The reference catches up one day per scheduled run, strictly in sequence.
Here the days still missing are found in one job — a date spine left-anti
joined to the days present — and every missing day is then written by one
dynamic-overwrite job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import as_date_literal
from tributary.sinks.lake import PARTITION_COLS, write_parquet
from tributary.functions.dates import date_parts

# The reference schedule's catch-up window (inclusive).
SCHEDULE_START = _dt.date(2025, 11, 20)
SCHEDULE_END = _dt.date(2025, 12, 23)


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """Every calendar day from ``start`` to ``end`` inclusive, column ``day``.
    Size is the number of days in the range."""
    return spark.range(1).select(
        F.explode(F.sequence(as_date_literal(start), as_date_literal(end), F.expr("INTERVAL 1 DAY"))).alias("day")
    )


def present_days(df: DataFrame, date_col: str) -> DataFrame:
    """Distinct days with data (partial aggregation per task first)."""
    return df.select(F.col(date_col).cast("date").alias("day")).where(F.col("day").isNotNull()).distinct()


def missing_days(present: DataFrame, start, end) -> DataFrame:
    """Days of the range with no data: the backfill work list."""
    spark = present.sparkSession
    return date_spine(spark, start, end).join(present, "day", "left_anti")


def backfill(source: DataFrame, date_col: str, start, end, target_path: str, present: DataFrame | None = None) -> dict:
    """Write every missing day of ``[start, end]`` from ``source`` in one
    job.  ``present`` defaults to the days already in ``target_path``.

    The work list is computed first (at most one row per day of the range,
    so collecting it is bounded) and becomes a plain ``IN`` filter on the
    source: it can prune source partitions and row groups, and the write
    never reads the folder it overwrites.
    """
    spark = source.sparkSession
    if present is None:
        try:
            existing = spark.read.parquet(target_path)
            present = existing.select(
                F.make_date("year", "month", "day").alias("day")).distinct()
        except AnalysisException as exc:  # nothing written yet; any other error must not pass as "all days missing"
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            present = spark.createDataFrame([], "day date")
    todo = [r["day"] for r in missing_days(present, start, end).collect()]
    if not todo:
        return {"status": "nothing to do", "path": target_path, "rows": 0}
    rows = source.where(F.to_date(F.col(date_col)).isin(todo))
    return write_parquet(rows.select("*", *date_parts(F.col(date_col))), target_path, PARTITION_COLS)
