"""Registered queries: one per operator group of SURVEY §2, each with the
DuckDB SQL that must give the same rows on the supplied tables.

Every query reads the whole supplied tables (or data Spark derives from
them).  Names of computed columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import date_parts
from tributary.functions.jsonfn import flatten, json_field
from tributary.operators import checks, checksums, quality, sketches
from tributary.operators.columns import clean_email_column, clean_headers, clean_sheet, read_projection
from tributary.operators.metadata import stamp_metadata, with_row_count
from tributary.operators.retention import retention_tiers
from tributary.operators.union import union_by_name
from tributary.session import scratch_path
from tributary.plans import backfill, models, standins
from tributary.plans.standins import table
from tributary.sources.incremental import extract_incremental
from tributary.schemas import SOURCE_SYSTEMS

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# Fixed values used by several queries.
AS_OF_EVENTS = "2024-02-01"          # just after the events window
AS_OF_ORDERS = "2001-08-02"          # the day after the last order
AS_OF_STAMP = "2025-12-01 06:30:00"  # extraction instant for stamp queries
SUITE_CONFIG = {
    "min_rows": 1,
    "required_columns": ["l_orderkey", "l_linenumber", "l_comment"],
    "no_null_columns": ["l_orderkey", "l_quantity", "l_comment"],
    "unique_columns": ["l_orderkey", "l_linenumber"],
}


def _events_with_null_types(spark, sf):
    """Error events carry no type: NULLs for the null checks to find."""
    ev = table(spark, sf, "events")
    return ev.withColumn("event_type", F.expr("nullif(event_type, 'error')"))


# ---------------------------------------------------------------------------
# A: quality checks
# ---------------------------------------------------------------------------

@register("dq_row_count", """
select 1::int as check_order, 'row_count' as "check", count(*) >= 1 as passed,
       count(*)::bigint as metric, 'expected_min=1' as detail,
       'Row count: ' || count(*) || ' (min: 1)' as message
from orders
""")
def q_dq_row_count(spark, sf):
    """A1 on orders."""
    return quality.validate_row_count(table(spark, sf, "orders"), 1)


@register("dq_null_counts", """
with e as (select nullif(event_type, 'error') as event_type, value from events),
m as (
  select coalesce(sum(case when event_type is null then 1 else 0 end), 0)::bigint as n0,
         coalesce(sum(case when value is null or isnan(value) then 1 else 0 end), 0)::bigint as n1
  from e)
select 1::int as check_order, 'no_nulls' as "check", (n0 + n1) = 0 as passed, (n0 + n1)::bigint as metric,
       concat_ws(',', case when n0 > 0 then 'event_type=' || n0 end, case when n1 > 0 then 'value=' || n1 end) as detail,
       case when n0 + n1 = 0 then 'No nulls in critical columns'
            else 'Nulls found in: ' || concat_ws(',', case when n0 > 0 then 'event_type=' || n0 end,
                                                 case when n1 > 0 then 'value=' || n1 end) end as message
from m
""")
def q_dq_null_counts(spark, sf):
    """A3: NULL/NaN counts, only existing columns (``no_such`` is ignored)."""
    return quality.validate_no_nulls(_events_with_null_types(spark, sf), ["event_type", "value", "no_such"])


@register("dq_duplicates", """
with g as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all),
m as (select sum(n)::bigint - count(*)::bigint as d from g)
select 1::int as check_order, 'no_duplicates' as "check", d = 0 as passed, d as metric,
       'l_orderkey,l_linenumber' as detail,
       case when d = 0 then 'No duplicates' else 'Found ' || d || ' duplicates' end as message
from m
""")
def q_dq_duplicates(spark, sf):
    """A4: rows beyond the first per (l_orderkey, l_linenumber)."""
    return quality.validate_no_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_SUITE_SQL = """
with g as (
  select l_orderkey, l_linenumber, count(*) as n,
         sum(case when l_orderkey is null then 1 else 0 end) as z0,
         sum(case when l_quantity is null or isnan(l_quantity) then 1 else 0 end) as z1
  from lineitem group by all),
m as (select coalesce(sum(n), 0)::bigint as r, count(*)::bigint as g,
             coalesce(sum(z0), 0)::bigint as n0, coalesce(sum(z1), 0)::bigint as n1 from g),
report as (
  select 1::int as check_order, 'row_count' as "check", r >= 1 as passed, r as metric,
         'expected_min=1' as detail, 'Row count: ' || r || ' (min: 1)' as message from m
  union all
  select 2, 'required_columns', false, 1::bigint, 'l_comment', 'Missing columns: l_comment' from m
  union all
  select 3, 'no_nulls', (n0 + n1) = 0, (n0 + n1)::bigint,
         concat_ws(',', case when n0 > 0 then 'l_orderkey=' || n0 end, case when n1 > 0 then 'l_quantity=' || n1 end),
         case when n0 + n1 = 0 then 'No nulls in critical columns' else 'Nulls found in: ' ||
           concat_ws(',', case when n0 > 0 then 'l_orderkey=' || n0 end, case when n1 > 0 then 'l_quantity=' || n1 end) end
  from m
  union all
  select 4, 'no_duplicates', (r - g) = 0, (r - g)::bigint, 'l_orderkey,l_linenumber',
         case when r - g = 0 then 'No duplicates' else 'Found ' || (r - g) || ' duplicates' end from m)
"""


@register("dq_suite", _SUITE_SQL + "select * from report")
def q_dq_suite(spark, sf):
    """A5: the four checks in one job over lineitem."""
    return quality.run_quality_checks(table(spark, sf, "lineitem"), SUITE_CONFIG)


@register("dq_suite_summary", _SUITE_SQL + """
select count(*)::bigint as total_checks, sum(case when passed then 1 else 0 end)::bigint as passed_checks,
       sum(case when passed then 0 else 1 end)::bigint as failed_checks, bool_and(passed) as all_passed
from report
""")
def q_dq_suite_summary(spark, sf):
    """A5 totals."""
    return quality.summarize_checks(quality.run_quality_checks(table(spark, sf, "lineitem"), SUITE_CONFIG))


@register("rows_per_day", """
select cast(ts as date) as form_date, count(*)::bigint as n from events group by all
""")
def q_rows_per_day(spark, sf):
    """Total rows per dated input."""
    ev = table(spark, sf, "events").select(F.col("ts").cast("date").alias("form_date"))
    return quality.rows_by(ev, "form_date")


@register("partition_counts", """
select cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as day,
       count(*)::bigint as n
from events group by all
""")
def q_partition_counts(spark, sf):
    """P9 + A9: year/month/day partition columns and rows per partition."""
    ev = table(spark, sf, "events").select(*date_parts(F.col("ts")))
    return quality.rows_by(ev, ["year", "month", "day"])


# ---------------------------------------------------------------------------
# P / X: columns and scalar functions
# ---------------------------------------------------------------------------

@register("col_clean_email", """
select cast(c_custkey as varchar) as customer_id, lower(c_name || '@X.COM') as email from customer
""")
def q_col_clean_email(spark, sf):
    """P4 (X1, X2, X5): padded, mixed-case e-mails lower-cased and stripped."""
    cust = standins.customers(spark, sf).select(
        "customer_id", F.concat(F.lit("\t "), F.col("email"), F.lit(" \n")).alias("email"))
    return clean_email_column(cust, "email")


@register("header_clean_light", """
select c_custkey as c_custkey, c_name as c_name, c_nationkey as "c_nation:key", c_mktsegment as "c_mkt-segment"
from customer
""")
def q_header_clean_light(spark, sf):
    """Lower -> strip -> space to '_' (other characters kept)."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("  C Name "),
        F.col("c_nationkey").alias("C Nation:Key"), F.col("c_mktsegment").alias("C MKT-Segment"))
    return clean_headers(c, "light")


@register("header_clean_sheet", """
select c_custkey as c_custkey, c_name as c_name, c_nationkey as cnation_key, c_mktsegment as c_mktsegment
from customer
""")
def q_header_clean_sheet(spark, sf):
    """P2 + P3: full header clean, empty rows dropped, text stripped."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("C_CustKey "),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t")).alias(" C Name"),
        F.col("c_nationkey").alias("C-Nation Key!"),
        F.concat(F.lit("\n"), F.col("c_mktsegment")).alias("C_MktSegment"))
    return clean_sheet(c)


@register("read_projection", """
select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000
""")
def q_read_projection(spark, sf):
    """Projection + predicate text pushed into the scan."""
    return read_projection(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"],
                           where="o_orderstatus = 'F' and o_totalprice > 100000")


@register("metadata_stamp", """
select o_orderkey, timestamp '2025-12-01 06:30:00' as _extraction_timestamp,
       'postgres_web_forms' as _source_system, 'unknown' as _source_location,
       count(*) over ()::bigint as _row_count
from orders
""")
def q_metadata_stamp(spark, sf):
    """Metadata stamp with the batch row count on every row."""
    o = table(spark, sf, "orders").select("o_orderkey")
    return stamp_metadata(o, SOURCE_SYSTEMS["web_forms"], None, as_of=AS_OF_STAMP)


@register("json_field", """
select event_id, try_cast(json_extract_string(props, '$.k') as int) as k from events
""")
def q_json_field(spark, sf):
    """A typed field out of a JSON text column."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", json_field("props", "$.k", "int").alias("k"))


@register("flatten_nested", """
select c_custkey, c_name as "info.name", c_nationkey as "info.nation.key", c_acctbal as "info.nation.bal"
from customer
""")
def q_flatten_nested(spark, sf):
    """Nested records flattened to dotted names."""
    c = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"),
                 F.struct(F.col("c_nationkey").alias("key"), F.col("c_acctbal").alias("bal")).alias("nation"))
        .alias("info"))
    return flatten(c)


@register("file_name_dates", """
select event_id, cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as day
from events
""")
def q_file_name_dates(spark, sf):
    """X6 + X10/X11: the date in a file stem -> partition columns (K6)."""
    from tributary.functions.dates import date_from_file_name
    ev = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("call_logs_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("file_name"))
    return ev.select("event_id", *date_parts(date_from_file_name("file_name")))


# ---------------------------------------------------------------------------
# Reads and unions
# ---------------------------------------------------------------------------

@register("incremental", """
select event_id, ts from events where ts > timestamp '2024-01-15'
""")
def q_incremental(spark, sf):
    """Strictly newer than the last extracted value."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    return extract_incremental(ev, "ts", "2024-01-15 00:00:00")


@register("incremental_inclusive", """
select event_id, ts from events
where ts > (select max(ts) from events where ts < timestamp '2024-01-15')
   or (ts = (select max(ts) from events where ts < timestamp '2024-01-15')
       and event_id not in (select min(event_id) from events where ts = (select max(ts) from events where ts < timestamp '2024-01-15')))
""")
def q_incremental_inclusive(spark, sf):
    """S17 at the boundary: rows stamped with the last value come, but for the
    one that the target holds already."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    before = ev.where(F.col("ts") < F.lit("2024-01-15").cast(ev.schema["ts"].dataType))
    last = before.agg(F.max("ts").alias("m")).first()["m"]
    loaded = before.where(F.col("ts") < F.lit(last)).unionByName(
        before.where(F.col("ts") == F.lit(last)).groupBy("ts").agg(F.min("event_id").alias("event_id")).select("event_id", "ts"))
    return extract_incremental(ev, "ts", last, inclusive=True, dedupe_keys=["event_id"], loaded=loaded)


@register("scan_page", """
select event_id, user_id from events where event_id > 2500 order by event_id limit 500
""")
def q_scan_page(spark, sf):
    """L2: one keyset page — ``id > last ORDER BY id LIMIT n`` (the limit
    is the feature: a page)."""
    ev = table(spark, sf, "events")
    return read_projection(ev, ["event_id", "user_id"], where=F.col("event_id") > 2500,
                           order_by=["event_id"], limit=500)


@register("dated_union", """
select event_id, strftime(ts, '%Y-%m-%d') as form_date,
       'postgres_web_forms' as _source_system,
       'postgres:public.web_form_request_' || strftime(ts, '%Y_%m_%d') as _source_location,
       count(*) over (partition by strftime(ts, '%Y-%m-%d'))::bigint as _row_count
from events
""")
def q_dated_union(spark, sf):
    """Rows of daily tables with ``form_date`` and the row count
    of their own table; counts per date are aggregated then broadcast back
    (one row per day) instead of a window over each day."""
    ev = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("form_date"),
        F.lit(SOURCE_SYSTEMS["web_forms"]).alias("_source_system"),
        F.concat(F.lit("postgres:public.web_form_request_"), F.date_format("ts", "yyyy_MM_dd")).alias("_source_location"),
    )
    return with_row_count(ev, count_by="form_date", bounded=True)  # one row per day


@register("union_by_name", """
select c_custkey as id, c_name as name, c_mktsegment as segment, null::double as bal from customer
union all
select s_suppkey, s_name, null, s_acctbal from supplier
""")
def q_union_by_name(spark, sf):
    """Union by name, missing columns NULL."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.col("s_acctbal").alias("bal"))
    return union_by_name([c, s])


# ---------------------------------------------------------------------------
# D: declared tests and metrics
# ---------------------------------------------------------------------------

@register("not_null", """
select event_id, user_id, ts from events where nullif(event_type, 'error') is null
""")
def q_not_null(spark, sf):
    """Failing rows of a not-null test."""
    return checks.not_null_failures(_events_with_null_types(spark, sf), "event_type").select("event_id", "user_id", "ts")


@register("relationships", """
select o_orderkey, o_custkey from orders
where o_custkey is not null and o_custkey not in (select user_id from events where user_id is not null)
""")
def q_relationships(spark, sf):
    """Web forms whose customer has no call record (child keys with
    no parent among the distinct event users)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return checks.relationship_orphans(o, "o_custkey", table(spark, sf, "events"), "user_id")


@register("accepted_values", """
select o_orderstatus, count(*)::bigint as n from orders
where o_orderstatus is not null and o_orderstatus not in ('O', 'F') group by 1
""")
def q_accepted_values(spark, sf):
    """D3: values outside the accepted set, with counts."""
    return checks.accepted_values_violations(table(spark, sf, "orders"), "o_orderstatus", ["O", "F"])


@register("accepted_resolution_states", """
select 'Escalated' as resolution_status, count(*)::bigint as n from orders where o_orderstatus = 'P'
""")
def q_accepted_resolution_states(spark, sf):
    """D3 on the web-form stand-in: states outside Resolved/Pending."""
    wf = standins.web_forms(spark, sf)
    return checks.accepted_values_violations(wf, "resolution_status", ["Resolved", "Pending"])


@register("duplicate_groups", """
select l_orderkey, l_linenumber, count(*)::bigint as n from lineitem group by all having count(*) > 1
""")
def q_duplicate_groups(spark, sf):
    """Key combinations seen more than once."""
    return checks.duplicate_key_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("type_validation", """
with c as (select cast(c_custkey as varchar) as customer_id, c_name as name,
                  cast(c_nationkey as varchar) as address from customer)
select 'customer_id' as "column", 'bigint' as expected_type, 'string' as actual_type, false as type_matches,
       coalesce(sum(case when customer_id is not null and try_cast(customer_id as bigint) is null then 1 else 0 end), 0)::bigint as bad_values from c
union all
select 'name', 'bigint', 'string', false,
       coalesce(sum(case when name is not null and try_cast(name as bigint) is null then 1 else 0 end), 0)::bigint from c
union all
select 'address', 'int', 'string', false,
       coalesce(sum(case when address is not null and try_cast(address as int) is null then 1 else 0 end), 0)::bigint from c
union all
select 'email', 'string', 'string', true, 0::bigint
""")
def q_type_validation(spark, sf):
    """Declared vs actual types; non-castable text values counted."""
    c = standins.customers(spark, sf)
    return checks.type_conformance(c, {"customer_id": "bigint", "name": "bigint", "address": "int", "email": "string"})


@register("completeness", """
with e as (select nullif(event_type, 'error') as event_type, value, props from events)
select 'event_type' as "column", count(event_type)::bigint as non_null, count(*)::bigint as total,
       count(event_type) / count(*) as completeness from e
union all select 'value', count(value)::bigint, count(*)::bigint, count(value) / count(*) from e
union all select 'props', count(props)::bigint, count(*)::bigint, count(props) / count(*) from e
""")
def q_completeness(spark, sf):
    """Share of non-NULL values per column."""
    return checks.completeness(_events_with_null_types(spark, sf), ["event_type", "value", "props"])


@register("completeness_empty", """
select 'none' as rows_of, * from (values ('completeness', 0::bigint, null::double), ('uniqueness', 0::bigint, null::double),
  ('row_count', (select count(*) from lineitem where l_quantity < 0), 0.0::double)) t(metric, n, share)
union all select 'all', 'completeness', count(*), count(l_orderkey) / count(*) from lineitem
union all select 'all', 'uniqueness', count(*), count(distinct l_orderkey) / count(*) from lineitem
union all select 'all', 'row_count', count(*), count(*)::double from lineitem
""")
def q_completeness_empty(spark, sf):
    """D6/D7/D10 on a whole table and on one that has no rows (counts of 0 and no share)."""
    lines = table(spark, sf, "lineitem")
    out = None
    for name, df in (("all", lines), ("none", lines.where("l_quantity < 0"))):
        df = df.select("l_orderkey")
        c = checks.completeness(df, ["l_orderkey"]).select(F.lit("completeness").alias("metric"), F.col("total").alias("n"), F.col("completeness").alias("share"))
        u = checks.uniqueness(df, ["l_orderkey"]).select(F.lit("uniqueness").alias("metric"), F.col("rows").alias("n"), F.col("uniqueness").alias("share"))
        p = checks.profile(df, min_rows=0, completeness_of=["l_orderkey"]).where("metric = 'row_count'").select(
            "metric", F.col("value").cast("long").alias("n"), F.col("value").alias("share"))
        both = c.unionByName(u).unionByName(p).select(F.lit(name).alias("rows_of"), "*")
        out = both if out is None else out.unionByName(both)
    return out


@register("uniqueness", """
with g as (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all)
select sum(n)::bigint as rows, count(*)::bigint as distinct_keys, (sum(n) - count(*))::bigint as duplicate_rows,
       count(*) / sum(n) as uniqueness from g
""")
def q_uniqueness(spark, sf):
    """Exact uniqueness ratio of a key."""
    return checks.uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("consistency", """
with a as (select o_custkey as k, count(*)::bigint as n_orders from orders group by 1),
     b as (select user_id as k, count(*)::bigint as n_events from events group by 1)
select coalesce(a.k, b.k) as key, n_orders, n_events,
       case when a.k is not null and b.k is not null then 'both'
            when b.k is null then 'only_orders' else 'only_events' end as status
from a full join b on a.k = b.k
""")
def q_consistency(spark, sf):
    """Per-customer presence and counts in two sources."""
    return checks.cross_source_consistency(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "events"),
                                           "user_id", "orders", "events")


@register("consistency_differences", """
with a as (select o_orderkey as k, count(*)::bigint as n_orders from orders group by 1),
     b as (select l_orderkey as k, 1::bigint as n_lines from lineitem group by 1)
select coalesce(a.k, b.k) as key, n_orders, n_lines,
       case when a.k is not null and b.k is not null then 'both'
            when b.k is null then 'only_orders' else 'only_lines' end as status
from a full join b on a.k = b.k where n_orders is distinct from n_lines
""")
def q_consistency_differences(spark, sf):
    """Keys of orders and of their lines that do not match, found by bucket checksums."""
    lines = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    return checksums.consistency_differences(table(spark, sf, "orders"), "o_orderkey", lines, "l_orderkey", "orders", "lines")


@register("distinct_sketches", """
with k as (select 'event_id' as key, cast(ts as date) as day, event_id as v from events
           union all select 'user_id', cast(ts as date), user_id from events)
select key, cast(day as varchar) as part, count(*)::bigint as rows,
       (count(*) - count(distinct v))::bigint as duplicate_rows
from k group by all
""")
def q_distinct_sketches(spark, sf):
    """Duplicates per day from stored sketches of two runs, counted exactly where a sketch flags the day."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    base = scratch_path(spark, "distinct-sketches")
    out = None
    for key in ("event_id", "user_id"):
        for run in (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"), F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")):
            sketches.update_sketches(spark, f"{base}/{key}", events.where(run), "day", [key])
        found = sketches.partition_duplicates(events, sketches.read_sketches(spark, f"{base}/{key}"), "day", [key])
        found = found.select(F.lit(key).alias("key"), "part", "rows", "duplicate_rows")
        out = found if out is None else out.unionByName(found)
    return out


@register("timeliness", """
select event_type, max(ts) as last_ts,
       cast(date_diff('day', cast(max(ts) as date), date '2024-02-01') as int) as age_days,
       date_diff('day', cast(max(ts) as date), date '2024-02-01') <= 2 as fresh
from events group by 1
""")
def q_timeliness(spark, sf):
    """Freshness per source (event type) at a reference instant."""
    return checks.freshness(table(spark, sf, "events"), "ts", AS_OF_EVENTS, "event_type", max_age_days=2)


@register("business_rules", """
select 'value_non_negative' as rule, coalesce(sum(case when not (value >= 0) then 1 else 0 end), 0)::bigint as violations,
       count(*)::bigint as checked from events
union all
select 'value_below_50', coalesce(sum(case when not (value < 50) then 1 else 0 end), 0)::bigint, count(*)::bigint from events
union all
select 'k_under_100', coalesce(sum(case when not (try_cast(json_extract_string(props, '$.k') as int) < 100) then 1 else 0 end), 0)::bigint,
       count(*)::bigint from events
""")
def q_business_rules(spark, sf):
    """Violations per named rule, one pass."""
    return checks.business_rules(table(spark, sf, "events"), {
        "value_non_negative": "value >= 0",
        "value_below_50": "value < 50",
        "k_under_100": "try_cast(get_json_object(props, '$.k') as int) < 100",
    })


@register("dq_profile", """
with e as (select nullif(event_type, 'error') as event_type, value, props from events),
m as (select count(*) as r,
             sum(case when event_type is null then 1 else 0 end) as n0,
             sum(case when value is null or isnan(value) then 1 else 0 end) as n1,
             count(event_type) as c0,
             sum(case when props is not null and try_cast(props as int) is null then 1 else 0 end) as t0,
             sum(case when not (value < 50) then 1 else 0 end) as r0
      from e)
select 'row_count' as metric, '*' as subject, r::double as value, r >= 1 as passed from m
union all select 'null_count', 'event_type', n0::double, n0 = 0 from m
union all select 'null_count', 'value', n1::double, n1 = 0 from m
union all select 'completeness', 'event_type', c0 / r, c0 = r from m
union all select 'bad_type_values', 'props', t0::double, t0 = 0 from m
union all select 'rule_violations', 'value_below_50', r0::double, r0 = 0 from m
""")
def q_dq_profile(spark, sf):
    """A1 + A3 + D5 + D6 + D10 fused: one aggregate over events."""
    return checks.profile(_events_with_null_types(spark, sf), min_rows=1, not_null=["event_type", "value"],
                          completeness_of=["event_type"], expected_types={"props": "int"},
                          rules={"value_below_50": "value < 50"})


# ---------------------------------------------------------------------------
# M: models
# ---------------------------------------------------------------------------

_CALLS_SQL = """
select cast(event_id as varchar) as complaint_id, 'call_logs' as source_system,
       cast(user_id as varchar) as customer_id, """ + standins.AGENT_SQL.format(k="event_id") + """ as agent_id, event_type as category,
       'Resolved' as resolution_status, ts as opened_at,
       ts + to_seconds(cast(floor(value) as bigint)) as closed_at, 'call' as channel
from events
"""

_FORMS_SQL = """
select cast(o_orderkey as varchar) as complaint_id, 'web_forms' as source_system,
       cast(o_custkey as varchar) as customer_id, """ + standins.AGENT_SQL.format(k="o_orderkey") + """ as agent_id, o_orderpriority as category,
       case o_orderstatus when 'F' then 'Resolved' when 'O' then 'Pending' when 'P' then 'Escalated' end
         as resolution_status,
       o_orderdate as opened_at, null::timestamp as closed_at, 'web' as channel
from orders
"""


@register("stg_call_logs", _CALLS_SQL)
def q_stg_call_logs(spark, sf):
    """M3: call logs conformed (odd headers renamed, trimmed, typed)."""
    return models.stg_call_logs(standins.call_logs(spark, sf))


@register("stg_web_forms", _FORMS_SQL)
def q_stg_web_forms(spark, sf):
    """M3: web forms conformed."""
    return models.stg_web_forms(standins.web_forms(spark, sf))


_SOCIAL_SQL = """
select cast(conv_id as varchar) || '-' || cast(turn as varchar) as complaint_id, 'social_media' as source_system,
       cast(conv_id as varchar) as customer_id, """ + standins.AGENT_SQL.format(k="conv_id") + """ as agent_id, role as category,
       'Pending' as resolution_status, make_timestamp(2024, 2, 1 + conv_id % 28, 0, 0, 0.0) as opened_at,
       case when turn % 5 <> 4 then make_timestamp(2024, 3, 1 + turn % 28, 10, 30, 0.0) end as closed_at, 'chat' as channel
from conversations
"""


@register("stg_social_media", _SOCIAL_SQL)
def q_stg_social_media(spark, sf):
    """M3: social media conformed (text dates parsed leniently)."""
    return models.stg_social_media(standins.social_media(spark, sf))


@register("int_complaints_unified", f"""
{_CALLS_SQL} union all {_FORMS_SQL} union all {_SOCIAL_SQL}
""")
def q_int_complaints_unified(spark, sf):
    """M4: one complaint row across the three channels."""
    return models.int_complaints_unified(
        models.stg_call_logs(standins.call_logs(spark, sf)),
        models.stg_web_forms(standins.web_forms(spark, sf)),
        models.stg_social_media(standins.social_media(spark, sf)),
    )


@register("dim_latest", """
select user_id, event_id, event_type, ts from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
""")
def q_dim_latest(spark, sf):
    """M5: latest row per key (max_by aggregate, skew-safe)."""
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return models.latest_per_key(ev, "user_id", ["ts", "event_id"])


@register("dim_customers", """
select cast(c_custkey as varchar) as customer_id, c_name as name, null::varchar as gender,
       null::varchar as date_of_birth, null::varchar as signup_date, c_name || '@X.COM' as email,
       cast(c_nationkey as varchar) as address
from customer
""")
def q_dim_customers(spark, sf):
    """M5: customer dimension, one row per customer_id."""
    return models.dim_customers(standins.customers(spark, sf))


@register("dim_customers_latest", """
with r as (
  select cast(c_custkey as varchar) as customer_id, c_name || '#' || v as name, date '2020-01-15' + cast((c_custkey * 37 + v * 11) % 400 as int) as d
  from customer, (values (0), (1), (2)) t(v))
select customer_id, arg_max(name, d) as name, strftime(max(d), '%Y-%m-%d') as signup from r group by 1
""")
def q_dim_customers_latest(spark, sf):
    """M5 over repeated keys: the latest by a text date that comes in two
    layouts (text order would choose another row)."""
    d = F.expr("date_add(date '2020-01-15', cast((c_custkey * 37 + v * 11) % 400 as int))")
    raw = table(spark, sf, "customer").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.concat("c_name", F.lit("#"), F.col("v").cast("string")).alias("name"),
        F.when(F.col("v") == 1, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("signup_date"))
    return models.dim_customers(raw).select(
        "customer_id", "name", F.date_format(models.lenient_timestamp(F.col("signup_date")), "yyyy-MM-dd").alias("signup"))


@register("dim_agents", """
select cast(s_suppkey as varchar) as agent_id, s_name || '#1' as name, cast(s_nationkey as varchar) as state from supplier
""")
def q_dim_agents(spark, sf):
    """M5: agents, one row per key, from rows that repeat every key with
    another number of years."""
    raw = standins.agents(spark, sf).withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    raw = raw.select("id", F.concat("name", F.lit("#"), F.col("v").cast("string")).alias("name"),
                     F.when(F.col("v") == 1, "10").otherwise("9").alias("experience"), "state")
    return models.dim_agents(raw).select("agent_id", "name", "state")


@register("fct_complaints", f"""
with u as ({_CALLS_SQL} union all {_FORMS_SQL} union all {_SOCIAL_SQL}),
     c as (select cast(c_custkey as varchar) as cid, c_name from customer),
     a as (select cast(s_suppkey as varchar) as aid, s_name from supplier)
select u.complaint_id, u.source_system, u.customer_id, c.c_name as customer_name, u.agent_id,
       a.s_name as agent_name, u.category, u.resolution_status, u.opened_at, u.closed_at,
       date_diff('second', u.opened_at, u.closed_at) as resolution_seconds, u.channel
from u left join c on u.customer_id = c.cid left join a on u.agent_id = a.aid
""")
def q_fct_complaints(spark, sf):
    """Complaints joined to both dimensions, resolution seconds."""
    unified = models.int_complaints_unified(
        models.stg_call_logs(standins.call_logs(spark, sf)),
        models.stg_web_forms(standins.web_forms(spark, sf)),
        models.stg_social_media(standins.social_media(spark, sf)),
    )
    return models.fct_complaints(
        unified,
        models.dim_customers(standins.customers(spark, sf)),
        models.dim_agents(standins.agents(spark, sf)),
    )


@register("fct_incremental", ORACLE_SQL["fct_complaints"])
def q_fct_incremental(spark, sf):
    """K17, M5, M6 by what changed: the fact of the complaints to 1996 with some
    customers under old names; then the later months and the right names come,
    and only their partitions are rewritten.  Equal to the full build."""
    from tributary.plans.incremental import dealt_by_partition, partition_counts, refresh_fact, update_dimension
    base = scratch_path(spark, "fct-incremental")
    unified = models.int_complaints_unified(
        models.stg_call_logs(standins.call_logs(spark, sf)), models.stg_web_forms(standins.web_forms(spark, sf)),
        models.stg_social_media(standins.social_media(spark, sf))).withColumn("part", F.coalesce(F.date_format("opened_at", "yyyy-MM"), F.lit("undated")))
    customers = standins.customers(spark, sf).withColumn("__version", F.lit(1))
    stale = F.pmod(F.xxhash64("customer_id"), F.lit(50)) == 0
    early = (F.col("part") < "1997") | (F.col("part") == "undated")
    agents = standins.agents(spark, sf)
    agents = models.stg_agents(agents).withColumn("__version", F.lit(1))
    for step, rows in enumerate((unified.where(early), unified.where(~early))):
        counts = partition_counts(rows, "part")      # as many as there are months
        dealt_by_partition(rows, "part", counts).write.partitionBy("part").mode("append").parquet(f"{base}/unified")
        came = customers.withColumn("name", F.when(stale, F.lit("old name")).otherwise(F.col("name"))) if step == 0 else customers.where(stale).withColumn("__version", F.lit(2))
        new_customers = update_dimension(spark, f"{base}/customers", came, "customer_id", ["__version"], ["name"], buckets=8)
        new_agents = update_dimension(spark, f"{base}/agents", agents if step == 0 else agents.where("false"), "agent_id", ["__version"], ["name"], buckets=8)
        refresh_fact(spark, spark.read.parquet(f"{base}/unified"), spark.read.parquet(f"{base}/customers"), spark.read.parquet(f"{base}/agents"),
                     f"{base}/fact", list(counts), changed_customers=new_customers, changed_agents=new_agents)
    return spark.read.parquet(f"{base}/fact").select(
        "complaint_id", "source_system", "customer_id", "customer_name", "agent_id", "agent_name", "category", "resolution_status", "opened_at", "closed_at",
        "resolution_seconds", "channel")


@register("fct_unique_key", f"""
with u as ({_CALLS_SQL} union all {_FORMS_SQL} union all {_SOCIAL_SQL})
select complaint_id, source_system, count(*)::bigint as n from u group by all having count(*) > 1
""")
def q_fct_unique_key(spark, sf):
    """D4 on the fact's declared key (complaint_id, source_system)."""
    unified = models.int_complaints_unified(
        models.stg_call_logs(standins.call_logs(spark, sf)),
        models.stg_web_forms(standins.web_forms(spark, sf)),
        models.stg_social_media(standins.social_media(spark, sf)),
    )
    return checks.duplicate_key_groups(unified, ["complaint_id", "source_system"])


# ---------------------------------------------------------------------------
# R1, T2
# ---------------------------------------------------------------------------

@register("retention", """
select o_orderkey, cast(date_diff('day', cast(o_orderdate as date), date '2001-08-02') as int) as age_days,
       case when date_diff('day', cast(o_orderdate as date), date '2001-08-02') >= 365 then 'expired'
            when date_diff('day', cast(o_orderdate as date), date '2001-08-02') >= 180 then 'deep_archive'
            when date_diff('day', cast(o_orderdate as date), date '2001-08-02') >= 90 then 'archive'
            else 'standard' end as tier
from orders
""")
def q_retention(spark, sf):
    """Storage tier per dated row at a reference date."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return retention_tiers(o, "o_orderdate", AS_OF_ORDERS).drop("o_orderdate")


@register("expired_partitions", """
select distinct cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
       cast(o_orderdate as date) as partition_date
from orders
where date_diff('day', cast(o_orderdate as date), date '2001-08-02') >= 365
""")
def q_expired_partitions(spark, sf):
    """Dated partitions past the expiry age (report only)."""
    from tributary.operators.retention import expired_partitions
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("int").alias("year"), F.month("o_orderdate").cast("int").alias("month"),
        "o_orderdate")
    return expired_partitions(o, ["year", "month"], "o_orderdate", AS_OF_ORDERS)


@register("backfill", """
select d::date as missing_day
from generate_series(date '2024-01-01', date '2024-02-03', interval 1 day) as t(d)
where d::date not in (select distinct cast(ts as date) from events)
""")
def q_backfill(spark, sf):
    """The days of a catch-up window with no data yet."""
    present = backfill.present_days(table(spark, sf, "events"), "ts")
    return backfill.missing_days(present, "2024-01-01", "2024-02-03").select(F.col("day").alias("missing_day"))
