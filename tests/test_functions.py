import datetime as dt

from pyspark.sql import functions as F

from tributary.functions import dates, jsonfn, text


def test_file_name_dates(spark):  # X6
    df = spark.createDataFrame([("calls_2025-11-20.csv",), ("calls_2025_11_21.csv",), ("calls.csv",),
                                ("calls_2025-13-40.csv",), ("x_20251120.csv",)], "n string")
    got = [r.d for r in df.select(dates.date_from_file_name("n").alias("d")).collect()]
    assert got == [dt.date(2025, 11, 20), dt.date(2025, 11, 21), None, None, None]


def test_dated_table_names_are_anchored(spark):  # X7, Z12
    df = spark.createDataFrame([("web_form_request_2025_11_20",), ("WEB_FORM_REQUEST_2025_11_21",),
                                ("web_form_request_backup",), ("old_web_form_request_2025_11_20",),
                                ("web_form_request_2025_11_20_v2",)], "t string")
    got = [r.d for r in df.select(dates.dated_table_date("t", "web_form_request_").alias("d")).collect()]
    assert got == [dt.date(2025, 11, 20), dt.date(2025, 11, 21), None, None, None]


def test_date_parts_and_iso(spark):  # P9, X9-X11
    df = spark.createDataFrame([(dt.date(2025, 1, 5),)], "d date")
    assert tuple(df.select(*dates.date_parts("d")).first()) == (2025, 1, 5)
    assert tuple(df.select(*dates.date_parts("d", padded=True)).first()) == ("2025", "01", "05")
    assert df.select(dates.iso_date("d")).first()[0] == "2025-01-05"


def test_as_of_forms(spark):  # X12
    row = spark.range(1).select(
        dates.as_of_timestamp("2025-12-01 06:30:00").alias("a"),
        dates.as_of_timestamp(dt.date(2025, 12, 1)).alias("b"),
        dates.as_of_timestamp(dt.datetime(2025, 12, 1, 7)).alias("c"),
        dates.as_of_timestamp().alias("now"),
    ).first()
    assert row.a == dt.datetime(2025, 12, 1, 6, 30) and row.b == dt.datetime(2025, 12, 1)
    assert row.c == dt.datetime(2025, 12, 1, 7)
    assert abs((row.now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 600


def test_parse_timestamp_lenient(spark):  # X8
    df = spark.createDataFrame([("2025-11-20 10:00:00",), ("20/11/2025",), (None,)], "s string")
    got = [r.t for r in df.select(dates.parse_timestamp("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2025, 11, 20, 10) and got[1] is None and got[2] is None
    got2 = df.select(dates.parse_timestamp("s", "dd/MM/yyyy").alias("t")).collect()[1].t
    assert got2 == dt.datetime(2025, 11, 20)


def test_json_field_and_flatten(spark):  # X15, P13, X16
    df = spark.createDataFrame([('{"k": 7, "o": {"p": "x"}}',), ("not json",)], "j string")
    got = [tuple(r) for r in df.select(jsonfn.json_field("j", "$.k", "int"), jsonfn.json_field("j", "$.o.p")).collect()]
    assert got == [(7, "x"), (None, None)]
    nested = spark.createDataFrame([(1, ("a", (2, [1, 2])))], "id int, `a b` struct<c: string, d: struct<e: int, f: array<int>>>")
    flat = jsonfn.flatten(nested)
    assert flat.columns == ["id", "a b.c", "a b.d.e", "a b.d.f"] and flat.first()["a b.d.f"] == [1, 2]
    assert spark.range(1).select(jsonfn.to_json_text(F.struct(F.lit(1).alias("x")))).first()[0] == '{"x":1}'


def test_text_helpers(spark):  # X19, X20
    row = spark.range(1).select(text.default_if_null(F.lit(None).cast("string")).alias("d"),
                                text.bytes_to_mb(F.lit(3 * 1024 * 1024)).alias("mb")).first()
    assert row.d == "unknown" and row.mb == 3.0


def test_constant_and_text_helpers(spark):  # P10, X5
    from tributary.operators.metadata import with_constant
    df = spark.createDataFrame([(1, None)], "a int, b double")
    out = with_constant(df, "form_date", "2025-11-20").select("form_date", text.to_text("a").alias("t"),
                                                              text.to_text("b").alias("u")).first()
    assert tuple(out) == ("2025-11-20", "1", None)


def test_strip_takes_unicode_blanks(spark):  # X2
    from tributary.functions.text import strip_ws
    df = spark.createDataFrame([("\u00a0\u3000 a\u00a0b \u2028\x1f",)], "s string")
    assert df.select(strip_ws("s")).first()[0] == "a\u00a0b"
