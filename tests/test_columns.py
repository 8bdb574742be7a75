import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.functions.text import clean_email, path_predicate, strip_ws
from tributary.operators import columns as C


def test_light_and_full_clean_names():
    assert C.clean_name_light("  COMPLAINT_catego ry ") == "complaint_catego_ry"
    assert C.clean_name_light("Unnamed: 0") == "unnamed:_0"
    assert C.clean_name_full("Unnamed: 0") == "unnamed_0"
    assert C.clean_name_full("C-Nation Key!") == "cnation_key"


@given(st.text(max_size=30))
@settings(max_examples=200, deadline=None)
def test_full_clean_property(name):
    out = C.clean_name_full(name)
    assert all(ch in "abcdefghijklmnopqrstuvwxyz0123456789_" for ch in out)
    assert C.clean_name_full(out) == out  # idempotent


def test_collision_detected_up_front(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, a_b int")
    with pytest.raises(C.HeaderCollisionError):
        C.clean_headers(df)
    df2 = spark.createDataFrame([(1, 2)], "`X` int, `x ` int")
    with pytest.raises(C.HeaderCollisionError):
        C.clean_headers(df2)


def test_strip_all_whitespace_and_keep_null(spark):  # F4, Z1
    df = spark.createDataFrame([("\t a \n",), (None,), (" B@X.Com\r\n",)], "v string")
    out = df.select(strip_ws("v").alias("s"), clean_email("v").alias("e")).collect()
    assert [r.s for r in out] == ["a", None, "B@X.Com"]
    assert [r.e for r in out] == ["a", None, "b@x.com"]


def test_clean_email_column_absent_is_noop(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert C.clean_email_column(df, "email") is df


def test_clean_sheet_drops_blank_rows_and_strips(spark):  # P3
    df = spark.createDataFrame([(" a ", None), (None, None), ("b", " Z\t")], "`Agent ID` string, `State!` string")
    out = C.clean_sheet(df)
    assert out.columns == ["agent_id", "state"]
    assert sorted(out.collect(), key=lambda r: r.agent_id) == [("a", None), ("b", "Z")]


def test_pandas_style_header_names():
    assert C.add_pandas_index_names(["", "a", "a", " "]) == ["Unnamed: 0", "a", "a.1", "Unnamed: 3"]


def test_dispatch_by_extension_ignores_case():  # P12
    d = C.dispatch_by_extension(["/x/a.csv", "/x/D.CSV", "/x/b.json", "/x/c.txt"])
    assert d == {"csv": ["/x/a.csv", "/x/D.CSV"], "json": ["/x/b.json"], "skipped": ["/x/c.txt"]}


def test_path_predicate(spark):  # P11
    df = spark.createDataFrame([("s3://b/Call_Logs/a.CSV",), ("s3://b/x/logs.json",), ("s3://b/y.csv",)], "p string")
    got = [r.p for r in df.where(path_predicate("p", suffix=".csv", contains_any=["call", "logs"])).collect()]
    assert got == ["s3://b/Call_Logs/a.CSV"]


def test_project_to_schema(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("1", "x", "2024-01-01 00:00:00", "bad")], "ID string, extra string, ts string, n string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("n", T.IntegerType()), T.StructField("missing", T.StringType())])
    r = C.project_to_schema(df, schema).collect()[0]
    assert r.id == 1 and r.ts.year == 2024 and r.n is None and r.missing is None


def test_read_projection_pushes_filter(spark):
    from conftest import SF001, plan_text
    from tributary.plans.standins import table
    df = C.read_projection(table(spark, SF001, "orders"), ["o_orderkey"], where="o_totalprice > 1000")
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan or "o_orderkey" in plan


@given(st.lists(st.text(alphabet="aAbB _-:", min_size=1, max_size=4), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_collision_property(names):  # F8
    cleaned = [C.clean_name_full(n).lower() for n in names]
    if len(set(cleaned)) < len(cleaned):
        with pytest.raises(C.HeaderCollisionError):
            C.cleaned_names(names, "full")
    else:
        assert C.cleaned_names(names, "full") == [C.clean_name_full(n) for n in names]
