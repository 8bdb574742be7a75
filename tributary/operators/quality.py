"""Data-quality checks and the check suite.

Each check returns a ``DataFrame`` with one row per check::

    check_order INT, check STRING, passed BOOLEAN, metric BIGINT,
    detail STRING, message STRING

``metric`` is the row count (A1), the number of missing columns (A2), the
total NULL count (A3) or the duplicate count (A4).

The suite (A5) fuses every configured check into ONE job over the data:
when duplicate keys are configured, rows are first aggregated by the key
(partial aggregation on the map side, so even a key holding a third of all
rows contributes one row per map task to the shuffle), and the row count and
per-column NULL counts are carried through that same aggregate.  Without
keys it is a single global aggregate with no shuffle of data at all.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

CHECK_COLUMNS = ("check_order", "check", "passed", "metric", "detail", "message")

# Check names (in suite order) and the report messages.
CHECK_ORDER = ("row_count", "required_columns", "no_nulls", "no_duplicates")
MSG_ROW_COUNT = "Row count: %d (min: {min_rows})"
MSG_MISSING = "Missing columns: "
MSG_ALL_PRESENT = "All required columns present"
MSG_NULLS = "Nulls found in: "
MSG_NO_NULLS = "No nulls in critical columns"
MSG_DUPLICATES = "Found %d duplicates"
MSG_NO_DUPLICATES = "No duplicates"


def null_indicator(df: DataFrame, column: str) -> Column:
    """1 when the value is missing.  Floating NaN counts as missing."""
    ref = F.col(f"`{column}`")
    dtype = df.schema[column].dataType
    missing = ref.isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(ref)
    return F.when(missing, F.lit(1)).otherwise(F.lit(0))


def _check_row(order: int, name: str, passed: Column, metric: Column, detail: Column, message: Column) -> Column:
    return F.struct(
        F.lit(order).cast("int").alias("check_order"),
        F.lit(name).alias("check"),
        passed.alias("passed"),
        metric.cast("long").alias("metric"),
        detail.alias("detail"),
        message.alias("message"),
    )


def _metrics(df: DataFrame, null_cols: list[str], unique_cols: list[str] | None) -> DataFrame:
    """One-row DataFrame: ``_rows``, ``_nullN`` per column, ``_groups``."""
    null_exprs = [F.sum(null_indicator(df, c)) for c in null_cols]
    if unique_cols:
        keys = [F.col(f"`{c}`") for c in unique_cols]
        per_key = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            *[e.alias(f"_z{i}") for i, e in enumerate(null_exprs)],
        )
        return per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("_rows"),
            F.count(F.lit(1)).cast("long").alias("_groups"),
            *[F.coalesce(F.sum(f"_z{i}"), F.lit(0)).cast("long").alias(f"_null{i}") for i in range(len(null_cols))],
        )
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("_rows"),
        *[F.coalesce(e, F.lit(0)).cast("long").alias(f"_null{i}") for i, e in enumerate(null_exprs)],
    )


def _row_count_check(order: int, min_rows: int) -> Column:
    n = F.col("_rows")
    return _check_row(
        order, "row_count", n >= F.lit(min_rows), n,
        F.lit(f"expected_min={min_rows}"),
        F.format_string(MSG_ROW_COUNT.format(min_rows=min_rows), n),
    )


def _required_check(order: int, present: list[str], required: list[str]) -> Column:
    missing = [c for c in required if c not in present]  # U2: list difference, no job
    detail = ",".join(missing)
    msg = MSG_MISSING + detail if missing else MSG_ALL_PRESENT
    return _check_row(order, "required_columns", F.lit(not missing), F.lit(len(missing)), F.lit(detail), F.lit(msg))


def _nulls_check(order: int, null_cols: list[str]) -> Column:
    total = F.lit(0).cast("long")
    for i in range(len(null_cols)):
        total = total + F.col(f"_null{i}")
    parts = [
        F.when(F.col(f"_null{i}") > 0, F.concat(F.lit(f"{c}="), F.col(f"_null{i}").cast("string")))
        for i, c in enumerate(null_cols)
    ]
    detail = F.concat_ws(",", *parts) if parts else F.lit("")
    return _check_row(
        order, "no_nulls", total == 0, total, detail,
        F.when(total == 0, F.lit(MSG_NO_NULLS)).otherwise(F.concat(F.lit(MSG_NULLS), detail)),
    )


def _dup_check(order: int, unique_cols: list[str]) -> Column:
    dups = F.col("_rows") - F.col("_groups")
    return _check_row(
        order, "no_duplicates", dups == 0, dups, F.lit(",".join(unique_cols)),
        F.when(dups == 0, F.lit(MSG_NO_DUPLICATES)).otherwise(F.format_string(MSG_DUPLICATES, dups)),
    )


def _report(metrics: DataFrame, rows: list[Column]) -> DataFrame:
    return metrics.select(F.inline(F.array(*rows)))


def _require_columns(df: DataFrame, cols: list[str], what: str) -> None:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"{what}: columns not in the data: {absent}")


def validate_row_count(df: DataFrame, min_rows: int = 1) -> DataFrame:
    """A1: ``count >= min_rows``."""
    return _report(_metrics(df, [], None), [_row_count_check(1, min_rows)])


def validate_required_columns(df: DataFrame, required_columns: list[str]) -> DataFrame:
    """A2: case-sensitive presence test on the schema; reads no data."""
    one = df.sparkSession.range(1)
    return _report(one, [_required_check(1, df.columns, list(required_columns))])


def validate_no_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """A3: per-column NULL (and NaN) counts over the columns that exist;
    only non-zero counts appear in ``detail``."""
    cols = [c for c in columns if c in df.columns]
    return _report(_metrics(df, cols, None), [_nulls_check(1, cols)])


def validate_no_duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """A4: rows beyond the first per key; NULL keys equal each other."""
    _require_columns(df, columns, "no_duplicates")
    return _report(_metrics(df, [], list(columns)), [_dup_check(1, list(columns))])


def run_quality_checks(df: DataFrame, config: dict) -> DataFrame:
    """A5: run the configured checks in the fixed order, in ONE job.

    ``config`` keys: ``min_rows``, ``required_columns``, ``no_null_columns``,
    ``unique_columns``.  Absent keys skip their check.
    """
    null_cols = [c for c in config.get("no_null_columns", []) if c in df.columns]
    unique_cols = list(config["unique_columns"]) if "unique_columns" in config else None
    if unique_cols:
        _require_columns(df, unique_cols, "no_duplicates")
    rows: list[Column] = []
    order = 0
    if "min_rows" in config:
        order += 1
        rows.append(_row_count_check(order, int(config["min_rows"])))
    if "required_columns" in config:
        order += 1
        rows.append(_required_check(order, df.columns, list(config["required_columns"])))
    if "no_null_columns" in config:
        order += 1
        rows.append(_nulls_check(order, null_cols))
    if unique_cols is not None:
        order += 1
        rows.append(_dup_check(order, unique_cols))
    if not rows:
        schema = "check_order int, check string, passed boolean, metric bigint, detail string, message string"
        return df.sparkSession.createDataFrame([], schema)
    return _report(_metrics(df, null_cols, unique_cols), rows)


def observe_checks(df: DataFrame, config: dict):
    """A5 without a job of its own: the checks ride on the next action over
    the returned DataFrame (e.g. the write) as an ``Observation``.

    Returns ``(observed_df, report)``; call ``report()`` after the action to
    get the same report DataFrame ``run_quality_checks`` gives.  Only the
    single-pass checks can be observed: a duplicate check needs a shuffle by
    key and raises ``ValueError`` here.
    """
    import uuid

    from pyspark.sql import Observation

    if "unique_columns" in config:
        raise ValueError("no_duplicates needs a shuffle by key; use run_quality_checks")
    null_cols = [c for c in config.get("no_null_columns", []) if c in df.columns]
    obs = Observation(f"checks_{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).cast("long").alias("_rows")]
    exprs += [F.coalesce(F.sum(null_indicator(df, c)), F.lit(0)).cast("long").alias(f"_null{i}")
              for i, c in enumerate(null_cols)]
    observed = df.observe(obs, *exprs)

    def report() -> DataFrame:
        names = ["_rows"] + [f"_null{i}" for i in range(len(null_cols))]
        try:
            values = obs.get
        except Exception:  # the action ran over zero partitions: an empty input
            values = {n: 0 for n in names}
        one = df.sparkSession.createDataFrame([tuple(int(values[n]) for n in names)],
                                              ", ".join(f"{n} bigint" for n in names))
        rows: list[Column] = []
        order = 0
        if "min_rows" in config:
            order += 1
            rows.append(_row_count_check(order, int(config["min_rows"])))
        if "required_columns" in config:
            order += 1
            rows.append(_required_check(order, df.columns, list(config["required_columns"])))
        if "no_null_columns" in config:
            order += 1
            rows.append(_nulls_check(order, null_cols))
        return _report(one, rows)

    return observed, report


def summarize_checks(report: DataFrame) -> DataFrame:
    """A5 totals: ``total_checks, passed_checks, failed_checks, all_passed``."""
    return report.agg(
        F.count(F.lit(1)).cast("long").alias("total_checks"),
        F.coalesce(F.sum(F.col("passed").cast("long")), F.lit(0)).cast("long").alias("passed_checks"),
        F.coalesce(F.sum((~F.col("passed")).cast("long")), F.lit(0)).cast("long").alias("failed_checks"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame, on_fail: str = "warn") -> dict:
    """Act on a check report.  ``warn`` logs and lets the load go on
    (the reference's behaviour); ``raise`` stops it.

    Collects the report, which has at most four rows.
    """
    rows = [r.asDict() for r in report.orderBy("check_order").collect()]
    failed = [r for r in rows if not r["passed"]]
    result = {
        "total_checks": len(rows),
        "passed_checks": len(rows) - len(failed),
        "failed_checks": len(failed),
        "all_passed": not failed,
        "checks": rows,
    }
    if failed:
        msg = "; ".join(r["message"] for r in failed)
        if on_fail == "raise":
            raise QualityGateError(msg)
        log.warning("quality checks failed: %s", msg)
    return result


def rows_by(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Row count per group (per date, per partition)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n"))
