"""Raw complaint tables derived from the supplied star-schema tables.

The supplied data has no complaint tables, so each raw table is derived,
with Spark, from one supplied table (``FIXTURES.md`` §2):

    customer  -> customers        supplier -> agents
    events    -> call_logs        conversations -> social_media
    orders    -> web_forms        events by day -> dated web-form tables

Every column keeps the raw layer's name and type (``schemas.RAW_TABLES``),
so the staging/model code downstream runs exactly as on real landings.
All derivations are projections and filters: pushed into the Parquet scan,
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import date_parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Derived values, the same text in Spark SQL and in the oracles: an agent's key
# (some NULL, some unknown), request dates in two layouts, resolution times of
# which some are no dates.
AGENT_SQL = "case when {k} % 13 = 0 then 'unknown-agent' when {k} % 10 = 0 then null else cast({k} % 10 as string) end"
REQUEST_DATE_SQL = ("case when conv_id % 2 = 0 then '2024-02-' || lpad(cast(1 + conv_id % 28 as string), 2, '0') "
                    "else lpad(cast(1 + conv_id % 28 as string), 2, '0') || '/02/2024' end")
RESOLUTION_DATE_SQL = ("case when turn % 5 = 4 then 'pending' "
                       "else '2024-03-' || lpad(cast(1 + turn % 28 as string), 2, '0') || ' 10:30:00' end")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("string").alias("date_of_birth"),
        F.lit(None).cast("string").alias("signup_date"),
        F.concat(F.col("c_name"), F.lit("@X.COM")).alias("email"),
        F.col("c_nationkey").cast("string").alias("address"),
    )


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("string").alias("experience"),
        F.col("s_nationkey").cast("string").alias("state"),
    )


def call_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("unnamed:_0"),
        F.col("event_id").cast("string").alias("call_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("complaint_catego_ry"),
        F.expr(AGENT_SQL.format(k="event_id")).alias("agent_id"),
        F.col("ts").alias("call_start_time"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), F.col("ts")).alias("call_end_time"),
        F.lit("Resolved").alias("resolutionstatus"),
        F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("calllogsgenerationdate"),
    )


def social_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("complaint_id"),
        F.col("conv_id").cast("string").alias("customer_id"),
        F.col("role").alias("complaint_catego_ry"),
        F.expr(AGENT_SQL.format(k="conv_id")).alias("agent_id"),
        F.lit("Pending").alias("resolutionstatus"),
        F.expr(REQUEST_DATE_SQL).alias("request_date"),
        F.expr(RESOLUTION_DATE_SQL).alias("resolution_date"),
        F.lit("chat").alias("media_channel"),
        F.lit(None).cast("string").alias("mediacomplaintgenerationdate"),
    )


# Order status -> resolution state used by the web-form
# stand-in (F finished, O open, P partly done).
STATUS_MAP = (("F", "Resolved"), ("O", "Pending"), ("P", "Escalated"))


def _status(c):
    expr = F.lit(None).cast("string")
    for code, state in reversed(STATUS_MAP):
        expr = F.when(c == code, F.lit(state)).otherwise(expr)
    return expr


def web_forms_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web forms before extraction metadata (what a dated table holds)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("form_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.expr(AGENT_SQL.format(k="o_orderkey")).alias("agent_id"),
        F.col("o_orderpriority").alias("complaint_type"),
        _status(F.col("o_orderstatus")).alias("resolution_status"),
        F.col("o_orderdate").alias("submission_date"),
    )


def web_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = web_forms_raw(spark, sf_dir)
    return w.select("*", *date_parts(F.col("submission_date")))
