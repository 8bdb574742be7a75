"""Declared data tests and quality metrics.

The reference only names these; the semantics here are ours and are stated
in each docstring.  Single-pass metrics (D5, D6, D10) are one global
aggregate each; the checks that need keys (D2, D4, D7, D8) shuffle on the
key after map-side partial aggregation wherever the answer allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.casts import safe_cast
from tributary.functions.dates import as_of_timestamp
from tributary.operators.quality import null_indicator


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is NULL (NaN counts as NULL)."""
    return df.where(null_indicator(df, column) == 1)


def relationship_orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str | None = None
) -> DataFrame:
    """Child rows with a non-NULL key that has no parent row.

    NULL keys are filtered first: a left-anti join would keep them (F12),
    and NULL is D1's business, not D2's.  The parent side is reduced to its
    distinct keys; Catalyst/AQE broadcast it when its measured size is under
    the broadcast threshold, and otherwise sort-merge join with AQE splitting
    a skewed child key.
    """
    parent_key = parent_key or child_key
    keys = parent.select(_q(parent_key).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    return (
        child.where(_q(child_key).isNotNull())
        .join(keys, _q(child_key) == F.col("__pk"), "left_anti")
    )


def accepted_values_violations(df: DataFrame, column: str, values: list) -> DataFrame:
    """D3: each non-NULL value outside ``values`` with its row count
    (``value``, ``n``).  Partial aggregation makes a hot value cheap."""
    return (
        df.where(_q(column).isNotNull() & ~_q(column).isin(list(values)))
        .groupBy(_q(column).alias(column))
        .agg(F.count(F.lit(1)).cast("long").alias("n"))
    )


def duplicate_key_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return (
        df.groupBy(*[_q(c) for c in columns])
        .agg(F.count(F.lit(1)).cast("long").alias("n"))
        .where(F.col("n") > 1)
    )


def type_conformance(df: DataFrame, expected: T.StructType | dict) -> DataFrame:
    """Declared vs actual type per column, in one pass.

    For a column held as text whose declared type is not text, counts the
    non-NULL values that would not cast (``try_cast`` gives NULL).  Columns
    declared but absent are reported with ``actual_type`` NULL.
    Output: ``column, expected_type, actual_type, type_matches, bad_values``.
    """
    if isinstance(expected, T.StructType):
        exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    else:
        exp = dict(expected)
    actual = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    names = list(exp)
    for i, name in enumerate(names):
        want = exp[name]
        have = actual.get(name)
        if isinstance(have, T.StringType) and want != "string":
            bad = F.sum(F.when(_q(name).isNotNull() & safe_cast(_q(name), want).isNull(), 1).otherwise(0))
        else:
            bad = F.lit(0)
        aggs.append(F.coalesce(bad, F.lit(0)).cast("long").alias(f"_b{i}"))
    counts = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    rows = []
    for i, name in enumerate(names):
        have = actual.get(name)
        have_s = have.simpleString() if have is not None else None
        rows.append(F.struct(
            F.lit(name).alias("column"),
            F.lit(exp[name]).alias("expected_type"),
            F.lit(have_s).cast("string").alias("actual_type"),
            F.lit(have_s == exp[name]).alias("type_matches"),
            F.col(f"_b{i}").alias("bad_values"),
        ))
    return counts.select(F.inline(F.array(*rows)))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of non-NULL values per column, one pass.
    Output: ``column, non_null, total, completeness``; an empty table has
    counts of 0 and no share (NULL)."""
    aggs = [F.count(F.lit(1)).cast("long").alias("_total")]
    aggs += [F.sum(1 - null_indicator(df, c)).cast("long").alias(f"_c{i}") for i, c in enumerate(columns)]
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.col(f"_c{i}"), F.lit(0)).cast("long").alias("non_null"),
            F.col("_total").alias("total"),
            F.try_divide(F.coalesce(F.col(f"_c{i}"), F.lit(0)), F.col("_total")).cast("double").alias("completeness"),
        )
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def uniqueness(df: DataFrame, columns: list[str], approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """``rows, distinct_keys, duplicate_rows, uniqueness`` over a key.

    Exact by default: a group-by on the key with map-side partial
    aggregation, then a global sum.  ``approximate`` swaps in HyperLogLog++
    (no shuffle of keys at all) for very wide keys.  An empty table has
    counts of 0 and no share (``uniqueness`` NULL).
    """
    keys = [_q(c) for c in columns]
    if approximate:
        one = df.agg(
            F.count(F.lit(1)).cast("long").alias("rows"),
            F.approx_count_distinct(F.struct(*keys), rsd).cast("long").alias("distinct_keys"),
        )
    else:
        one = (
            df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
                F.count(F.lit(1)).cast("long").alias("distinct_keys"),
            )
        )
    return one.select(
        "rows", "distinct_keys",
        (F.col("rows") - F.col("distinct_keys")).alias("duplicate_rows"),
        F.try_divide(F.col("distinct_keys"), F.col("rows")).cast("double").alias("uniqueness"),
    )


def cross_source_consistency(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str,
    left_name: str = "left", right_name: str = "right",
) -> DataFrame:
    """Per-key presence and row counts in two sources.

    Both sides are aggregated to one row per key before the full outer join,
    so the join sees each key once per side no matter how skewed the raw
    data is.  Output: ``key, n_<left>, n_<right>, status`` with status
    ``both`` / ``only_<left>`` / ``only_<right>``.
    """
    # Grouping and joining on struct(key): struct equality treats NULL fields
    # as equal (NULL keys meet), and the join reuses the hash partitioning
    # the two aggregates already have — no further exchange.
    a = left.groupBy(F.struct(_q(left_key).alias("k")).alias("__k")).agg(
        F.count(F.lit(1)).cast("long").alias(f"n_{left_name}"))
    b = right.groupBy(F.struct(_q(right_key).alias("k")).alias("__k")).agg(
        F.count(F.lit(1)).cast("long").alias(f"n_{right_name}"))
    j = a.join(b, a["__k"] == b["__k"], "full")
    return j.select(
        F.coalesce(a["__k"], b["__k"]).getField("k").alias("key"),
        F.col(f"n_{left_name}"),
        F.col(f"n_{right_name}"),
        F.when(a["__k"].isNotNull() & b["__k"].isNotNull(), F.lit("both"))
        .when(b["__k"].isNull(), F.lit(f"only_{left_name}"))
        .otherwise(F.lit(f"only_{right_name}")).alias("status"),
    )


def freshness(
    df: DataFrame, ts_column: str, as_of=None, group_by: list[str] | str | None = None,
    max_age_days: int | None = None,
) -> DataFrame:
    """Newest timestamp per group and its age in whole days at ``as_of``.
    Output: ``[group cols], last_ts, age_days[, fresh]``."""
    groups = [group_by] if isinstance(group_by, str) else list(group_by or [])
    agg = df.groupBy(*[_q(g) for g in groups]).agg(F.max(_q(ts_column)).alias("last_ts"))
    ref = as_of_timestamp(as_of)
    out = agg.withColumn("age_days", F.datediff(ref.cast("date"), F.col("last_ts").cast("date")).cast("int"))
    if max_age_days is not None:
        out = out.withColumn("fresh", F.col("age_days") <= F.lit(max_age_days))
    return out


def business_rules(df: DataFrame, rules: dict[str, str | Column]) -> DataFrame:
    """Rows violating each named rule, one pass over the data.

    A rule is a boolean expression that must hold; a row violates it when
    the expression is FALSE (NULL — rule not applicable — is not counted).
    Output: ``rule, violations, checked``.
    """
    names = list(rules)
    aggs = [F.count(F.lit(1)).cast("long").alias("_rows")]
    for i, name in enumerate(names):
        expr = rules[name]
        cond = F.expr(expr) if isinstance(expr, str) else expr
        aggs.append(F.coalesce(F.sum(F.when(~cond, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"_v{i}"))
    one = df.agg(*aggs)
    rows = [
        F.struct(F.lit(n).alias("rule"), F.col(f"_v{i}").alias("violations"), F.col("_rows").alias("checked"))
        for i, n in enumerate(names)
    ]
    return one.select(F.inline(F.array(*rows)))


def profile(
    df: DataFrame,
    min_rows: int | None = None,
    not_null: list[str] | None = None,
    completeness_of: list[str] | None = None,
    expected_types: dict[str, str] | None = None,
    rules: dict[str, str | Column] | None = None,
) -> DataFrame:
    """A1 + A3 + D5 + D6 + D10 fused into ONE aggregate over ``df``.

    Every requested metric is a column of a single global aggregate (no
    shuffle of data: partial aggregates per task, one row each to the
    final step), then unpivoted.  Output, one row per metric:
    ``metric, subject, value (double), passed (boolean)``.

    * ``row_count`` / ``*``: rows; passed when ``>= min_rows``.
    * ``null_count`` / column: NULL (or NaN) values; passed when 0.
    * ``completeness`` / column: non-NULL share (NULL for an empty table,
      which passes: nothing is missing); passed when 1.
    * ``bad_type_values`` / column: text values that do not cast to the
      expected type; passed when 0 (types already equal count 0).
    * ``rule_violations`` / rule: rows where the rule is FALSE; passed when 0.
    """
    aggs: list[Column] = [F.count(F.lit(1)).cast("long").alias("__rows")]
    plan: list[tuple[str, str, str]] = [("row_count", "*", "__rows")]
    for i, c in enumerate(not_null or []):
        aggs.append(F.coalesce(F.sum(null_indicator(df, c)), F.lit(0)).cast("long").alias(f"__n{i}"))
        plan.append(("null_count", c, f"__n{i}"))
    for i, c in enumerate(completeness_of or []):
        aggs.append(F.coalesce(F.sum(1 - null_indicator(df, c)), F.lit(0)).cast("long").alias(f"__c{i}"))
        plan.append(("completeness", c, f"__c{i}"))
    actual = {f.name: f.dataType for f in df.schema.fields}
    for i, (c, want) in enumerate((expected_types or {}).items()):
        if isinstance(actual.get(c), T.StringType) and want != "string":
            bad = F.sum(F.when(_q(c).isNotNull() & safe_cast(_q(c), want).isNull(), 1).otherwise(0))
        else:
            bad = F.lit(0)
        aggs.append(F.coalesce(bad, F.lit(0)).cast("long").alias(f"__t{i}"))
        plan.append(("bad_type_values", c, f"__t{i}"))
    for i, (name, expr) in enumerate((rules or {}).items()):
        cond = F.expr(expr) if isinstance(expr, str) else expr
        aggs.append(F.coalesce(F.sum(F.when(~cond, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"__r{i}"))
        plan.append(("rule_violations", name, f"__r{i}"))
    one = df.agg(*aggs)
    rows = []
    for metric, subject, col in plan:
        v = F.col(col)
        if metric == "row_count":
            value, ok = v.cast("double"), (v >= F.lit(min_rows if min_rows is not None else 0))
        elif metric == "completeness":
            value = F.try_divide(v, F.col("__rows")).cast("double")
            ok = v == F.col("__rows")
        else:
            value, ok = v.cast("double"), v == 0
        rows.append(F.struct(F.lit(metric).alias("metric"), F.lit(subject).alias("subject"),
                             value.alias("value"), ok.alias("passed")))
    return one.select(F.inline(F.array(*rows)))
