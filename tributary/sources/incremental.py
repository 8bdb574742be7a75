"""Incremental reads.

``date_col > last`` is a plain predicate: on Parquet it reaches the scan as
a pushed filter (row groups skipped by their statistics); on a table
partitioned by date it prunes partitions; on JDBC it becomes the ``WHERE``
of the remote query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _literal_like(df: DataFrame, column: str, value) -> Column:
    """``value`` as a literal of the column's own type (no cast of the
    column itself, so the comparison stays pushable)."""
    dtype = df.schema[column].dataType
    return F.lit(value).cast(dtype)


def extract_incremental(
    df: DataFrame, date_column: str, last_value=None, inclusive: bool = False,
    dedupe_keys: list[str] | None = None, loaded: DataFrame | None = None,
) -> DataFrame:
    """Rows newer than the last extracted value; a full read when there is
    none.

    The default is the strict ``>`` of the reference, which loses rows
    stamped with exactly the last value if they arrive after it was read.
    ``inclusive=True`` re-reads the boundary value.  What the target already
    holds there must not come again: give ``loaded`` (the target) and the
    ``dedupe_keys`` that name a row, and rows whose key the target holds *at
    the boundary value* are left out by an anti-join over that value's rows
    only.  ``dedupe_keys`` also drops repeats of a key within the new read.
    """
    if inclusive and last_value is not None and (loaded is None or not dedupe_keys):
        raise ValueError("an inclusive read needs the loaded rows and the keys that name a row")
    if last_value is None:
        return df
    bound = _literal_like(df, date_column, last_value)
    c = F.col(f"`{date_column}`")
    out = df.where(c >= bound if inclusive else c > bound)
    if inclusive:
        held = loaded.where(F.col(f"`{date_column}`") == _literal_like(loaded, date_column, last_value))
        names = [date_column, *(k for k in dedupe_keys if k != date_column)]
        held = held.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(names)])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(names)]
        out = out.join(held, same, "left_anti")
    if dedupe_keys:
        out = out.dropDuplicates(dedupe_keys)
    return out


def high_water_mark(df: DataFrame, date_column: str):
    """The greatest value of ``date_column`` already loaded (``None`` when
    empty) — the next run's ``last_value``.  One aggregate; on Parquet the
    max is computed from the column only."""
    return df.agg(F.max(F.col(f"`{date_column}`")).alias("hwm")).first()["hwm"]


def watermark_from_audit(spark, root: str, source: str):
    """The last execution date recorded for ``source`` in the audit table
    (K7), or ``None`` — the ``last_value`` of the next incremental read when
    the target itself is not at hand.  Reads only that source's partition."""
    from tributary.sinks.audit import read_audit

    audit = read_audit(spark, root).where(F.col("source") == source)
    return audit.agg(F.max("execution_date").alias("last")).first()["last"]
