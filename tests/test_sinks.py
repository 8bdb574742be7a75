import datetime as dt


from conftest import plan_text
from tributary.plans import models
from tributary.schemas import WEB_FORMS
from tributary.sinks import audit, lake
from tributary.sinks.warehouse import Warehouse


def _days(spark, rows):
    return spark.createDataFrame(rows, "id int, d date")


def test_dynamic_overwrite_replaces_only_touched_day(spark, tmp):  # K2, F6, Z13
    df = _days(spark, [(1, dt.date(2025, 11, 20)), (2, dt.date(2025, 11, 21))])
    lake.write_dated(df, tmp, "calls", "d")
    lake.write_dated(_days(spark, [(3, dt.date(2025, 11, 21))]), tmp, "calls", "d")
    lake.write_dated(_days(spark, [(3, dt.date(2025, 11, 21))]), tmp, "calls", "d")  # re-run
    got = sorted(r.id for r in spark.read.parquet(f"{tmp}/raw/calls").collect())
    assert got == [1, 3]


def test_partition_pruning_on_day_read(spark, tmp):  # X18, F5
    df = _days(spark, [(i, dt.date(2025, 11, 1) + dt.timedelta(days=i)) for i in range(5)])
    lake.write_dated(df, tmp, "calls", "d")
    day = lake.read_day(spark, f"{tmp}/raw/calls", "2025-11-03")
    assert [r.id for r in day.collect()] == [2]
    plan = plan_text(day)
    assert "PartitionFilters: [isnotnull(year" in plan and "(day" in plan
    assert lake.read_days(spark, f"{tmp}/raw/calls", "2025-11-02", "2025-11-04").count() == 3


def test_raw_layer_write_and_observed_count(spark, tmp):  # K3, F15
    res = lake.write_to_raw_layer(spark.range(10), tmp, "agents", "2025-11-20")
    assert res["rows"] == 10
    r = spark.read.parquet(f"{tmp}/raw/agents").select("year", "month", "day").distinct().collect()
    assert [tuple(x) for x in r] == [(2025, 11, 20)]


def test_padded_partitions_read_back_as_int(spark, tmp):  # F5, Z5
    df = lake.with_execution_date(spark.range(2), "2025-01-05", padded=True)
    lake.write_parquet(df, f"{tmp}/p", lake.PARTITION_COLS)
    import os
    assert os.path.isdir(f"{tmp}/p/year=2025/month=01/day=05")
    assert lake.read_day(spark, f"{tmp}/p", "2025-01-05").count() == 2


def test_static_write_overwrites(spark, tmp):  # K1
    lake.write_static(spark.range(3), tmp, "agents")
    lake.write_static(spark.range(2), tmp, "agents")
    assert spark.read.parquet(f"{tmp}/raw/agents").count() == 2


def test_audit_rewrite_same_day(spark, tmp):  # K7, F16
    rec = audit.audit_record(spark, "agents", "2025-11-20", 5, as_of="2025-11-20 01:00:00")
    audit.save_audit(rec, tmp)
    audit.save_audit(audit.audit_record(spark, "agents", "2025-11-20", 7), tmp)
    audit.save_audit(audit.audit_record(spark, "agents", "2025-11-21", 9), tmp)
    got = sorted((r.execution_date, r.row_count) for r in audit.read_audit(spark, tmp).collect())
    assert got == [("2025-11-20", 7), ("2025-11-21", 9)]


def test_by_name_load(spark, tmp):  # K9, K10, K11, F7
    wh = Warehouse(spark, f"{tmp}/wh")
    wh.setup()
    wh.create_table("raw.web_forms_t", WEB_FORMS)
    src = spark.createDataFrame([("F1", "2025-11-20 10:00:00", "x"), ("F2", "not a date", "y")],
                                "FORM_ID string, Submission_Date string, extra string")
    res = wh.load_by_name(src, "raw.web_forms_t", mode="overwrite")
    assert res["ignored"] == ["extra"] and "agent_id" in res["null_filled"]
    assert res["rows"] == 2 and res["cast_losses"] == {"submission_date": 1}  # observed on the insert
    rows = {r.form_id: r for r in spark.table("raw.web_forms_t").collect()}
    assert rows["F1"].submission_date == dt.datetime(2025, 11, 20, 10) and rows["F2"].submission_date is None
    lost = {r.column: r.lost_values for r in wh.cast_losses(src, "raw.web_forms_t").collect()}
    assert lost == {"submission_date": 1}
    wh.load_by_name(src, "raw.web_forms_t", mode="overwrite")  # re-run does not duplicate
    assert spark.table("raw.web_forms_t").count() == 2


def test_raw_layer_to_warehouse(spark, tmp):  # K13, K14, K15
    lake.write_to_raw_layer(spark.range(4), tmp, "calls2", "2025-11-20")
    lake.write_to_raw_layer(spark.range(2), tmp, "calls2", "2025-11-21")
    wh = Warehouse(spark, f"{tmp}/wh")
    wh.setup(("raw",))
    wh.load_raw_layer(tmp, "calls2", execution_date="2025-11-20")
    wh.load_raw_layer(tmp, "calls2", execution_date="2025-11-21")
    wh.load_raw_layer(tmp, "calls2", execution_date="2025-11-21")  # same day again: replaced
    assert spark.table("raw.raw_calls2").count() == 6


def test_materialize_and_schema_name(spark, tmp):  # K17, K18, M1
    assert models.schema_name(" silver ", "public") == "silver"
    assert models.schema_name(None, "public") == "public"
    wh = Warehouse(spark, f"{tmp}/wh")
    wh.setup()
    spark.range(3).withColumnRenamed("id", "agent_id").write.mode("overwrite").saveAsTable("raw.agents_m")
    name = models.materialize(models.stg_passthrough(spark, "raw.agents_m"), "stg_agents_m", "silver")
    assert name == "silver.stg_agents_m" and spark.table(name).count() == 3


def test_warehouse_sql_and_rows(spark, tmp):  # S22, K12
    wh = Warehouse(spark, f"{tmp}/wh", namespace="s22_")
    wh.setup(("raw",))
    wh.create_table(wh.table_name("raw", "t"), spark.range(1).schema)
    res = wh.load_by_name(spark.range(5), wh.table_name("raw", "t"), mode="append")
    assert res["rows"] == 5
    assert wh.sql(f"select count(*) as n from {wh.table_name('raw', 't')}").first().n == 5


def test_incremental_watermarks(spark, tmp):  # S17
    from tributary.sources.incremental import extract_incremental, high_water_mark, watermark_from_audit
    audit.save_audit(audit.audit_record(spark, "calls", "2025-11-20", 3), tmp)
    audit.save_audit(audit.audit_record(spark, "calls", "2025-11-22", 3), tmp)
    audit.save_audit(audit.audit_record(spark, "other", "2025-12-01", 3), tmp)
    last = watermark_from_audit(spark, tmp, "calls")
    assert last == "2025-11-22"
    df = spark.createDataFrame([(dt.date(2025, 11, 22),), (dt.date(2025, 11, 23),)], "d date")
    assert extract_incremental(df, "d", last).count() == 1  # strict >
    held = df.limit(0)
    assert extract_incremental(df, "d", last, inclusive=True, dedupe_keys=["d"], loaded=held).count() == 2
    assert high_water_mark(df, "d") == dt.date(2025, 11, 23)


def test_partitioned_overwrite_under_static_session(spark, tmp):  # Z13 whatever the session says
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        wh = Warehouse(spark, f"{tmp}/wh", namespace="static_")
        wh.setup(("raw",))
        import pyspark.sql.types as T
        schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.IntegerType())])
        wh.create_table(wh.table_name("raw", "t"), schema, partitioned_by=["day"])
        wh.load_by_name(spark.createDataFrame([(1, 1), (2, 2)], "id int, day int"), wh.table_name("raw", "t"), "overwrite")
        wh.load_by_name(spark.createDataFrame([(3, 2)], "id int, day int"), wh.table_name("raw", "t"), "overwrite")
        assert sorted(tuple(r) for r in wh.source("raw", "t").collect()) == [(1, 1), (3, 2)]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_empty_dated_write_is_a_noop(spark, tmp):  # Z7
    lake.write_dated(_days(spark, [(1, dt.date(2025, 11, 20))]), tmp, "calls", "d")
    res = lake.write_dated(spark.createDataFrame([], "id int, d date"), tmp, "calls", "d")
    assert res["rows"] == 0
    assert [r.id for r in spark.read.parquet(f"{tmp}/raw/calls").collect()] == [1]


def test_undated_raw_layer_load_replaces_table(spark, tmp):  # K14 without a date
    lake.write_to_raw_layer(spark.range(3), tmp, "calls3", "2025-11-20")
    lake.write_to_raw_layer(spark.range(2), tmp, "calls3", "2025-11-21")
    wh = Warehouse(spark, f"{tmp}/wh", namespace="k14_")
    wh.setup(("raw",))
    wh.load_raw_layer(tmp, "calls3")
    wh.load_raw_layer(tmp, "calls3")  # re-run: replaced, not doubled
    assert wh.source("raw", "raw_calls3").count() == 5


def test_inclusive_read_leaves_out_what_the_target_holds(spark):  # S17
    import pytest
    from tributary.sources.incremental import extract_incremental
    src = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30), (4, 30)], "id int, d int")
    held = spark.createDataFrame([(1, 10), (2, 20), (4, 10)], "id int, d int")
    got = extract_incremental(src, "d", 20, inclusive=True, dedupe_keys=["id"], loaded=held).collect()
    assert sorted(r.id for r in got) == [3, 4]
    with pytest.raises(ValueError):
        extract_incremental(src, "d", 20, inclusive=True)


def test_undated_reload_drops_old_days(spark, tmp):  # K14
    from tributary.sinks.lake import write_to_raw_layer
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([("1",)], "id string")
    wh = Warehouse(spark, f"{tmp}/wh", namespace="reload_")
    wh.setup(("raw",))
    write_to_raw_layer(df, f"{tmp}/a", "agents", "2025-12-01")
    write_to_raw_layer(df, f"{tmp}/b", "agents", "2025-12-02")
    wh.load_raw_layer(f"{tmp}/a", "agents")
    wh.load_raw_layer(f"{tmp}/b", "agents")
    assert [r.day for r in wh.source("raw", "raw_agents").collect()] == [2]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
