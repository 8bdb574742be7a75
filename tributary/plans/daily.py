"""One day of the complaint platform, end to end.

Order: database and table set-up -> extract and land every source -> load
the raw tables by name -> silver staging -> gold dimensions and fact ->
declared tests.  Sources are independent, so their extract/land/load chains
are submitted as concurrent Spark jobs (one thread each); every step inside
is a DataFrame job.  This is a plain function, not a scheduler: retries and
calendars belong to whatever runs it.

Dated raw tables are partitioned by ``year/month/day`` (an addition to the
declared columns) so a re-run of a day replaces exactly that day.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import checks
from tributary.plans import models, reference
from tributary.plans.landing import ingest
from tributary.schemas import CALL_LOGS, CUSTOMERS, AGENTS, RESOLUTION_STATES, SOCIAL_MEDIA, WEB_FORMS
from tributary.sinks.audit import audit_record, save_audit
from tributary.sinks.lake import PARTITION_COLS, layer_path, read_day
from tributary.sinks.warehouse import Warehouse
from tributary.sources.files import fetch_files
from tributary.sources.jdbc import JdbcSource
from tributary.sources.sheets import extract_agents

log = logging.getLogger(__name__)

_PARTS = [T.StructField(c, T.IntegerType(), True) for c in PARTITION_COLS]


def _with_parts(schema: T.StructType) -> T.StructType:
    names = {f.name for f in schema.fields}
    return T.StructType(list(schema.fields) + [f for f in _PARTS if f.name not in names])


@dataclass
class Sources:
    """Where a day's inputs are.  Any of them may be absent."""
    customers_dir: str | None = None
    call_logs_dir: str | None = None
    social_media_dir: str | None = None
    spreadsheet_dir: str | None = None
    web_forms: JdbcSource | None = None
    web_forms_schema: str | None = None
    web_forms_key: str | None = None
    web_forms_balanced: bool = False  # quantile bands of the key (unevenly spread keys)


def setup(wh: Warehouse) -> None:
    """K10 + K9: databases and the raw tables."""
    wh.setup()
    wh.create_table(wh.table_name("raw", "agents"), AGENTS)
    wh.create_table(wh.table_name("raw", "customers"), CUSTOMERS)
    for name, schema in (("call_logs", CALL_LOGS), ("social_media", SOCIAL_MEDIA), ("web_forms", WEB_FORMS)):
        wh.create_table(wh.table_name("raw", name), _with_parts(schema), partitioned_by=list(PARTITION_COLS))


def _land_agents(spark, src: Sources, lake: str, wh: Warehouse, ds, as_of, on_fail) -> dict:
    df = extract_agents(spark, src.spreadsheet_dir, "agents", as_of=as_of)
    res = reference.load_reference(df, lake, "agents", reference.AGENT_CHECKS, execution_date=ds,
                                   on_fail=on_fail, as_of=as_of)
    wh.load_parquet(layer_path(lake, "agents", "raw"), wh.table_name("raw", "agents"), mode="overwrite")
    return res


def _land_customers(spark, src: Sources, lake: str, wh: Warehouse, ds, as_of) -> dict:
    res = ingest(spark, fetch_files(spark, src.customers_dir), lake, "customers")
    wh.load_parquet(layer_path(lake, "customers", None), wh.table_name("raw", "customers"), mode="overwrite")
    return res


def _land_daily_files(spark, folder: str, lake: str, dataset: str, wh: Warehouse, ds, as_of) -> dict:
    # only the day's files are opened, landed and loaded: a day costs a day
    res = ingest(spark, fetch_files(spark, folder), lake, dataset, incremental=True, execution_date=ds, as_of=as_of or ds)
    if res["status"] == "empty":
        save_audit(audit_record(spark, dataset, ds, 0, "empty", None, as_of), lake)
        return {**res, "loaded_rows": 0, "cast_losses": {}}
    day = read_day(spark, layer_path(lake, dataset, None), ds)
    table = wh.table_name("raw", dataset)
    loaded = wh.load_by_name(day, table, mode="overwrite")  # replaces that day only; losses observed
    save_audit(audit_record(spark, dataset, ds, loaded["rows"], "success", None, as_of,
                            details={"cast_losses": loaded["cast_losses"], "ignored_columns": loaded["ignored"]}),
               lake)
    res["loaded_rows"], res["cast_losses"] = loaded["rows"], loaded["cast_losses"]
    return res


def _land_web_forms(spark, src: Sources, lake: str, wh: Warehouse, ds, as_of) -> dict:
    extracted = src.web_forms.extract_dated_tables(spark, schema=src.web_forms_schema, key=src.web_forms_key,
                                                   as_of=as_of, balanced=src.web_forms_balanced)
    res = reference.load_web_forms(extracted, lake, execution_date=ds, as_of=as_of)
    wh.load_by_name(spark.read.parquet(layer_path(lake, "web_forms", "raw")), wh.table_name("raw", "web_forms"),
                    mode="overwrite", whole_table=True)
    return res


def run_day(spark: SparkSession, src: Sources, lake: str, wh: Warehouse, ds: str, as_of=None,
            on_fail: str = "warn", parallel: int = 4, buckets: int | None = None) -> dict:
    """Land, load and model one execution date ``ds`` (``YYYY-MM-DD``).

    ``buckets`` saves the fact and ``dim_customers`` bucketed on
    ``customer_id`` (and ``dim_agents`` on ``agent_id``), so consumers'
    fact-dimension joins need no shuffle.
    """
    setup(wh)
    steps = {}
    if src.spreadsheet_dir:
        steps["agents"] = lambda: _land_agents(spark, src, lake, wh, ds, as_of, on_fail)
    if src.customers_dir:
        steps["customers"] = lambda: _land_customers(spark, src, lake, wh, ds, as_of)
    if src.call_logs_dir:
        steps["call_logs"] = lambda: _land_daily_files(spark, src.call_logs_dir, lake, "call_logs", wh, ds, as_of)
    if src.social_media_dir:
        steps["social_media"] = lambda: _land_daily_files(spark, src.social_media_dir, lake, "social_media",
                                                          wh, ds, as_of)
    if src.web_forms is not None:
        steps["web_forms"] = lambda: _land_web_forms(spark, src, lake, wh, ds, as_of)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(fn) for name, fn in steps.items()}
        landed = {name: f.result() for name, f in futures.items()}

    # silver (K17): staging models over the raw tables
    stg = {
        "stg_agents": models.stg_agents(wh.source("raw", "agents")),
        "stg_customers": wh.source("raw", "customers"),
        "stg_call_logs": models.stg_call_logs(wh.source("raw", "call_logs")),
        "stg_social_media": models.stg_social_media(wh.source("raw", "social_media")),
        "stg_web_forms": models.stg_web_forms(wh.source("raw", "web_forms")),
    }
    silver_db, gold_db = wh.db("silver"), wh.db("gold")
    for name, df in stg.items():
        models.materialize(df, name, silver_db)
    silver = {name: wh.source("silver", name) for name in stg}

    # gold: dimensions and the fact
    unified = models.int_complaints_unified(
        silver["stg_call_logs"], silver["stg_social_media"], silver["stg_web_forms"])
    models.materialize(unified, "int_complaints_unified", silver_db)
    by_customer = {"bucket_by": "customer_id", "buckets": buckets} if buckets else {}
    by_agent = {"bucket_by": "agent_id", "buckets": buckets} if buckets else {}
    models.materialize(models.dim_customers(silver["stg_customers"]), "dim_customers", gold_db, **by_customer)
    models.materialize(models.dim_agents(silver["stg_agents"]), "dim_agents", gold_db, **by_agent)
    fct = models.fct_complaints(wh.source("silver", "int_complaints_unified"), wh.source("gold", "dim_customers"),
                                wh.source("gold", "dim_agents"))
    models.materialize(fct, "fct_complaints", gold_db, **by_customer)

    # declared tests (D1-D4) on the fact: counts of failing rows
    f = wh.source("gold", "fct_complaints")
    tests = {
        "unique_complaint_source": checks.duplicate_key_groups(f, ["complaint_id", "source_system"]).count(),
        "not_null_customer_id": checks.not_null_failures(f, "customer_id").count(),
        "not_null_agent_id": checks.not_null_failures(f, "agent_id").count(),
        "relationship_customer": checks.relationship_orphans(
            f, "customer_id", wh.source("gold", "dim_customers"), "customer_id").count(),
        "relationship_agent": checks.relationship_orphans(
            f, "agent_id", wh.source("gold", "dim_agents"), "agent_id").count(),
        "accepted_resolution_status": checks.accepted_values_violations(
            f, "resolution_status", list(RESOLUTION_STATES)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0],
    }
    return {"landed": landed, "tests": tests}
