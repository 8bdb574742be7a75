"""Less travelled paths: options and shapes the main flows do not take."""

import json

from conftest import SF001, write
from tributary.plans import reference
from tributary.session import cut_lineage
from tributary.sources import jsonsrc, sheets


def test_json_objects_without_flattening_and_scalar_values(spark, tmp):
    nested = write(f"{tmp}/n.json", json.dumps({"r1": {"a": 1, "b": {"c": 2}}}))
    keep = jsonsrc.read_json_files(spark, [nested], flatten_nested=False)
    assert "b" in keep.columns and keep.first().b.c == "2"
    scalars = write(f"{tmp}/s.json", json.dumps({"x": 1, "y": 2}, indent=1))
    assert sorted(r.value for r in jsonsrc.read_json_files(spark, [scalars]).collect()) == ["1", "2"]
    # on one line, an object with values that are no objects is one JSON Lines record
    line = write(f"{tmp}/l.json", json.dumps({"x": 1, "y": 2}))
    assert [(r.x, r.y) for r in jsonsrc.read_json_files(spark, [line]).collect()] == [("1", "2")]


def test_sheet_tabs_by_name_and_index(spark, tmp):
    write(f"{tmp}/book/agents.csv", "ID,Name\na1,Zed\n")
    write(f"{tmp}/book/regions.csv", "Code\nCA\n")
    assert sheets.list_worksheets(spark, f"{tmp}/book") == ["agents", "regions"]
    assert sheets.read_worksheet(spark, f"{tmp}/book", worksheet_index=1).first().Code == "CA"
    assert sheets.read_worksheet(spark, f"{tmp}/book", "agents").first().ID == "a1"


def test_lineage_cut_and_checkpointed_reference_load(spark, tmp):
    from tributary.plans.standins import table
    df = table(spark, SF001, "supplier").selectExpr("cast(s_suppkey as string) as agent_id", "s_name as name")
    cut = cut_lineage(df)
    assert cut.count() == df.count() and "Scan parquet" not in cut._jdf.queryExecution().toString()
    res = reference.load_reference(df, tmp, "agents", {"min_rows": 1, "unique_columns": ["agent_id"]},
                                   execution_date="2025-11-20", on_fail="raise", checkpoint=True)
    assert res["quality"]["all_passed"] is True and res["rows"] == df.count()


def test_jdbc_schema_qualified_listing(spark):
    import uuid
    from tributary.sources import jdbc
    src = jdbc.derby_memory(f"sch_{uuid.uuid4().hex[:8]}")
    jdbc.write_table(spark.range(3), src, "web_form_request_2025_01_01")
    names = [r.table_name for r in src.list_tables(spark, schema="APP").collect()]
    assert names == ["WEB_FORM_REQUEST_2025_01_01"]
    df = src.extract_dated_tables(spark, schema="APP", key="id")
    assert df.count() == 3 and df.first()._source_location.startswith("postgres:APP.")
