import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001, plan_text
from pyspark.sql import functions as F
from tributary.plans import models, standins


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 100)), min_size=1, max_size=30,
                unique_by=lambda t: t[2]))
@settings(max_examples=10, deadline=None)
def test_latest_per_key_matches_brute_force(spark, rows):  # M5
    df = spark.createDataFrame(rows, "k int, ts int, id int")
    got = {r.k: (r.ts, r.id) for r in models.latest_per_key(df, "k", ["ts", "id"]).collect()}
    want = {}
    for k, ts, i in rows:
        if k not in want or (ts, i) > want[k]:
            want[k] = (ts, i)
    assert got == want


def test_latest_per_key_has_no_window(spark):
    ev = standins.table(spark, SF001, "events").select("user_id", "event_id", "ts")
    plan = plan_text(models.latest_per_key(ev, "user_id", ["ts", "event_id"]))
    assert "Window" not in plan


def test_fact_keeps_unknown_customers(spark):  # M6, J2
    calls = spark.createDataFrame(
        [("c1", "u1", None, "cat", "Resolved", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 1))],
        "call_id string, customer_id string, agent_id string, complaint_catego_ry string, "
        "resolutionstatus string, call_start_time timestamp_ntz, call_end_time timestamp_ntz")
    stg = models.stg_call_logs(calls)
    custs = spark.createDataFrame([("u2", "n")], "customer_id string, name string")
    agents = spark.createDataFrame([("1", "a")], "id string, name string")
    f = models.fct_complaints(stg, models.dim_customers(custs, ["name"]), models.dim_agents(agents, ["name"])).collect()[0]
    assert f.customer_name is None and f.resolution_seconds == 60 and f.source_system == "call_logs"


def test_unified_has_conformed_columns(spark):  # M3, M4
    from tributary.schemas import COMPLAINT_COLUMNS
    u = models.int_complaints_unified(
        models.stg_call_logs(standins.call_logs(spark, SF001)),
        models.stg_web_forms(standins.web_forms(spark, SF001)),
        models.stg_social_media(standins.social_media(spark, SF001)))
    assert tuple(u.columns) == COMPLAINT_COLUMNS


def test_bucketed_fact_and_dimension_join_without_shuffle(spark):  # K17 option
    from conftest import plan_text
    from tributary.sinks.warehouse import Warehouse
    import tempfile
    wh = Warehouse(spark, tempfile.mkdtemp(), namespace="bk_")
    wh.setup(("gold",))
    fct = standins.table(spark, SF001, "orders").select(F.col("o_custkey").alias("customer_id"), "o_totalprice")
    dim = standins.table(spark, SF001, "customer").select(F.col("c_custkey").alias("customer_id"), "c_name")
    models.materialize(fct, "fct", wh.db("gold"), bucket_by="customer_id", buckets=8)
    models.materialize(dim, "dim", wh.db("gold"), bucket_by="customer_id", buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the sort-merge path
    try:
        j = wh.source("gold", "fct").join(wh.source("gold", "dim"), "customer_id")
        text = plan_text(j)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert j.count() == fct.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_latest_by_text_dates(spark):  # M5
    rows = [("1", "31/12/2023", "old"), ("1", "02/01/2024", "new"), ("2", "2024-03-01", "iso"), ("2", "05/02/2024", "earlier"), ("3", "soon", "b"), ("3", "soon", "a")]
    df = spark.createDataFrame(rows, "customer_id string, signup_date string, name string").repartition(3)
    got = {r.customer_id: r.name for r in models.dim_customers(df).collect()}
    assert got == {"1": "new", "2": "iso", "3": "b"}     # a tie is broken by the rest of the row


def test_latest_needs_an_order(spark):
    import pytest
    with pytest.raises(ValueError):
        models.dim_customers(spark.createDataFrame([("1", "n")], "customer_id string, name string"))


def test_bad_times_do_not_stop_staging(spark):  # M3
    raw = spark.createDataFrame([("c1", "u", "a", "x", "Resolved", "10:30", "31/12/2023")],
                                "call_id string, customer_id string, agent_id string, complaint_catego_ry string, "
                                "resolutionstatus string, call_start_time string, call_end_time string")
    r = models.stg_call_logs(raw).first()
    assert r.opened_at is None and r.closed_at == dt.datetime(2023, 12, 31)
