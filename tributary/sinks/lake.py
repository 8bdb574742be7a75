"""Lake writers: static and date-partitioned Parquet.

One path function serves writers and loaders (decisions Z4, Z5).  Dated
writes use dynamic partition overwrite, so a re-run replaces exactly the
days it carries and leaves every other day alone (F6, Z13).  Every row is
written to its own partition; nothing is taken from a first row (Z7).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tributary.functions.dates import as_date_literal, date_parts

PARTITION_COLS = ("year", "month", "day")


def observed_rows(obs: Observation, df: DataFrame, key: str = "rows") -> int:
    """The row count observed on a write.  A write over zero partitions
    reports no metrics; only then is the input counted (it is empty or
    nearly so)."""
    try:
        return int(obs.get[key])
    except Exception:
        return df.count()


def layer_path(root: str, dataset: str, layer: str | None = "raw") -> str:
    """``<root>/<layer>/<dataset>`` — the single naming rule for a dataset."""
    root = root.rstrip("/")
    return f"{root}/{layer}/{dataset}" if layer else f"{root}/{dataset}"


def write_static(df: DataFrame, root: str, table: str, layer: str | None = "raw") -> dict:
    """K1: overwrite a whole reference dataset at ``<root>/<layer>/<table>``."""
    path = layer_path(root, table, layer)
    obs = Observation(f"static_{table}_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return {"status": "success", "path": path, "rows": observed_rows(obs, df)}


def write_parquet(
    df: DataFrame,
    path: str,
    partition_cols: list[str] | tuple[str, ...] | None = None,
    mode: str = "overwrite_partitions",
    rebalance: bool = True,
) -> dict:
    """K2: Parquet write, plain or partitioned.

    ``mode``: ``overwrite_partitions`` (dynamic: replace only the partitions
    present in ``df``), ``overwrite`` (replace the dataset), ``append``.
    The row count comes from an ``Observation`` on the write itself, not a
    second scan (F15).

    A partitioned write is preceded by a ``REBALANCE`` on the partition
    columns: rows of one day meet in few tasks (few, large files instead of
    one small file per task and day), AQE coalesces small days together and
    splits a day that holds a large share of the rows into several tasks by
    size.  ``rebalance=False`` writes straight from the input partitions
    (no shuffle) — right when each input task already holds one day.
    """
    cols = list(partition_cols or [])
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if cols and rebalance:
        out = out.hint("rebalance", *cols)
    writer = out.write
    if mode == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic" if cols else "static")
    elif mode in ("overwrite", "append"):
        writer = writer.mode(mode)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "static")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return {"status": "success", "path": path, "rows": observed_rows(obs, df)}


def with_execution_date(df: DataFrame, execution_date=None, padded: bool = False) -> DataFrame:
    """``year, month, day`` of one execution date on every row."""
    if execution_date is None:
        execution_date = _dt.datetime.now(_dt.timezone.utc).date()
    return df.select("*", *date_parts(as_date_literal(execution_date), padded=padded))


def write_to_raw_layer(df: DataFrame, root: str, source: str, execution_date=None) -> dict:
    """K3: stamp the execution date's ``year/month/day`` (today, UTC, when
    absent) and replace that day under ``<root>/raw/<source>``."""
    return write_parquet(
        with_execution_date(df, execution_date), layer_path(root, source, "raw"), PARTITION_COLS,
    )


def write_dated(df: DataFrame, root: str, source: str, date_col: str, layer: str | None = "raw") -> dict:
    """Write rows to the day of their own ``date_col`` (K19 and K6): one job
    for all days, each day replaced as a unit.  Existing ``year/month/day``
    columns are recomputed from ``date_col``."""
    day = F.to_date(F.col(date_col))
    rest = df.drop(*PARTITION_COLS)
    return write_parquet(rest.select("*", *date_parts(day)), layer_path(root, source, layer), PARTITION_COLS)


def read_days(spark, path: str, start=None, end=None) -> DataFrame:
    """Read a ``year/month/day`` dataset, optionally limited to a date range.

    The range is applied on the partition columns, so only matching
    directories are listed and read (``PartitionFilters``); it holds for
    padded and unpadded layouts alike because partition values read back as
    integers (F5).
    """
    df = spark.read.parquet(path)
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")

    def as_key(d):
        d = _dt.date.fromisoformat(str(d)) if not isinstance(d, _dt.date) else d
        return d.year * 10000 + d.month * 100 + d.day

    if start is not None:
        df = df.where(key >= as_key(start))
    if end is not None:
        df = df.where(key <= as_key(end))
    return df


def read_day(spark, path: str, day) -> DataFrame:
    """One day's partition (X18) with equality filters on each column."""
    d = _dt.date.fromisoformat(str(day)) if not isinstance(day, _dt.date) else day
    return (
        spark.read.parquet(path)
        .where((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day))
    )
