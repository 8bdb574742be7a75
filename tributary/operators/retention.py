"""Storage-tier report for dated data.

Re-aims the bucket lifecycle rule (archive at 90 days, deep archive at 180,
expire at 365) as a report over any dated dataset.  Nothing is deleted here:
``expired_partitions`` lists what a separate, explicit call may drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.dates import as_of_timestamp

# Lifecycle thresholds in days and tier names.
ARCHIVE_DAYS = 90
DEEP_ARCHIVE_DAYS = 180
EXPIRE_DAYS = 365
TIERS = ("standard", "archive", "deep_archive", "expired")


def age_days(date_col: Column | str, as_of=None) -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.datediff(as_of_timestamp(as_of).cast("date"), c.cast("date")).cast("int")


def tier_of(age: Column, archive_days: int = ARCHIVE_DAYS, deep_days: int = DEEP_ARCHIVE_DAYS,
            expire_days: int = EXPIRE_DAYS) -> Column:
    return (
        F.when(age >= expire_days, F.lit("expired"))
        .when(age >= deep_days, F.lit("deep_archive"))
        .when(age >= archive_days, F.lit("archive"))
        .otherwise(F.lit("standard"))
    )


def retention_tiers(df: DataFrame, date_col: str, as_of=None, **thresholds) -> DataFrame:
    """Every row with ``age_days`` and its ``tier`` at ``as_of``."""
    age = age_days(date_col, as_of)
    return df.withColumn("age_days", age).withColumn("tier", tier_of(F.col("age_days"), **thresholds))


def expired_partitions(df: DataFrame, partition_cols: list[str], date_col: str, as_of=None,
                       expire_days: int = EXPIRE_DAYS) -> DataFrame:
    """Distinct partitions whose date is past expiry.  On a table partitioned
    by ``partition_cols`` Spark answers this from partition values."""
    return (
        df.select(*partition_cols, F.col(date_col).cast("date").alias("partition_date"))
        .distinct()
        .where(age_days("partition_date", as_of) >= expire_days)
    )
