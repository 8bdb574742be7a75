import json
import os

import pytest
from pyspark.errors import PythonException

from conftest import write
from tributary.operators.columns import HeaderCollisionError, clean_headers
from tributary.plans.landing import ingest
from tributary.sources import csvsrc, files, jsonsrc


def test_reordered_headers_bind_by_name(spark, tmp):  # F1
    a = write(f"{tmp}/a.csv", "a,b\n1,2\n")
    b = write(f"{tmp}/b.csv", "b,a\n2,1\n")
    rows = csvsrc.read_csv_files(spark, [a, b]).collect()
    assert all((r.a, r.b) == ("1", "2") for r in rows) and len(rows) == 2


def test_uneven_headers_null_fill(spark, tmp):  # U1
    a = write(f"{tmp}/a.csv", "a,b\n1,2\n")
    b = write(f"{tmp}/b.csv", "a,b,c\n3,4,5\n")
    out = {r.a: r for r in csvsrc.read_csv_files(spark, [a, b]).collect()}
    assert out["1"].c is None and out["3"].c == "5"


def test_blank_and_odd_headers(spark, tmp):  # P1, §1.3
    p = write(f"{tmp}/calls.csv", ',call_ID,COMPLAINT_catego ry\n0,c1,x\n')
    df = clean_headers(csvsrc.read_csv_files(spark, [p]))
    assert df.columns == ["unnamed:_0", "call_id", "complaint_catego_ry"]


def test_collision_before_write(spark, tmp):  # F8
    p = write(f"{tmp}/c.csv", "A b,a_b\n1,2\n")
    with pytest.raises(HeaderCollisionError):
        clean_headers(csvsrc.read_csv_files(spark, [p]))


def test_type_conflict_lands_as_text(spark, tmp):  # F2
    a = write(f"{tmp}/a.csv", "v\n1\n")
    b = write(f"{tmp}/b.csv", "v\nhello\n")
    assert sorted(r.v for r in csvsrc.read_csv_files(spark, [a, b]).collect()) == ["1", "hello"]


def test_header_only_and_empty_files(spark, tmp):
    h = write(f"{tmp}/h.csv", "a,b\n")
    e = write(f"{tmp}/e.csv", "")
    assert csvsrc.read_csv_files(spark, [h, e]).count() == 0
    with pytest.raises(ValueError):
        csvsrc.read_csv_files(spark, [e])


def test_json_three_shapes(spark, tmp):  # S3, F3
    lst = write(f"{tmp}/list.json", json.dumps([{"a": 1, "n": {"x": 1}}, {"a": 2}]))
    dct = write(f"{tmp}/dict.json", json.dumps({"r1": {"a": 3, "n": {"x": 9}}, "r2": {"a": 4, "t": [1, 2]}}))
    sca = write(f"{tmp}/scalar.json", "42")
    emp = write(f"{tmp}/empty.json", "")
    df = jsonsrc.read_json_files(spark, [lst, dct, sca, emp])
    rows = df.collect()
    assert len(rows) == 5
    assert {"a", "n", "n.x", "t", "value"} <= set(df.columns)  # arrays keep structs; objects flattened
    by_a = {r.a: r for r in rows if r.a}
    assert by_a["3"]["n.x"] == "9" and by_a["4"].t == "[1,2]" and by_a["1"].n is not None
    assert [r.value for r in rows if r.value] == ["42"]
    with pytest.raises(ValueError):
        jsonsrc.read_json_files(spark, [emp])


def test_json_column_orient(spark, tmp):
    p = write(f"{tmp}/cols.json", json.dumps({"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": None}}))
    got = sorted(tuple(r) for r in jsonsrc.read_json_files(spark, [p], object_orient="columns").collect())
    assert got == [("1", "x"), ("2", None)]


def test_discovery_errors_and_extensions(spark, tmp):  # S9, S10, P12
    for n in ("a.csv", "D.CSV", "b.json", "c.txt"):
        write(f"{tmp}/in/{n}", "x\n1\n")
    got = [os.path.basename(p) for p in files.fetch_files(spark, f"{tmp}/in")]
    assert got == ["D.CSV", "a.csv", "b.json"]
    assert len(files.find_files(spark, f"{tmp}/in", name_contains="d")) == 1
    os.makedirs(f"{tmp}/empty")
    with pytest.raises(FileNotFoundError):
        files.fetch_files(spark, f"{tmp}/empty")
    with pytest.raises(FileNotFoundError):
        files.fetch_files(spark, f"{tmp}/missing")


def test_listing_prefix_and_inventory(spark, tmp):  # S5, A8, K16, L5
    for i in range(7):
        write(f"{tmp}/lake/call_logs/f{i}.csv", "x\n1\n")
    write(f"{tmp}/lake/agents/agents.parquet", "zz")
    listing = files.list_objects(spark, f"{tmp}/lake")
    inv = {r.prefix: (r.objects, r.empty) for r in files.objects_by_prefix(listing, ["call_logs", "agents", "x"]).collect()}
    assert inv == {"call_logs": (7, False), "agents": (1, False), "x": (0, True)}
    assert files.first_objects(listing, "call_logs", 5).count() == 5
    assert files.list_objects(spark, f"{tmp}/lake", prefix="agents", suffix=".parquet").count() == 1


def test_dated_file_landing(spark, tmp):  # K6, K5, Z2
    write(f"{tmp}/in/x_2025-11-20.csv", "id\n1\n2\n")
    write(f"{tmp}/in/x_2025_11_21.csv", "id\n3\n")
    write(f"{tmp}/in/x.csv", "id\n4\n")
    write(f"{tmp}/in/notes.txt", "skip me")
    fs = [f"{tmp}/in/{n}" for n in os.listdir(f"{tmp}/in")]
    ingest(spark, fs, f"{tmp}/lake", "calls", incremental=True, as_of="2025-12-01")
    got = sorted((r.year, r.month, r.day, r.id) for r in spark.read.parquet(f"{tmp}/lake/calls").collect())
    assert got == [(2025, 11, 20, "1"), (2025, 11, 20, "2"), (2025, 11, 21, "3"), (2025, 12, 1, "4")]
    # explicit date: only files of that day or undated files land there
    ingest(spark, fs, f"{tmp}/lake2", "calls", incremental=True, execution_date="2025-11-21")
    got = sorted(r.id for r in spark.read.parquet(f"{tmp}/lake2/calls").collect())
    assert got == ["3", "4"]
    ingest(spark, fs, f"{tmp}/lake3", "calls", incremental=True, execution_date="2025-11-21", all_files=True)
    assert spark.read.parquet(f"{tmp}/lake3/calls").count() == 4


def test_static_ingest_and_csv_to_parquet(spark, tmp):  # K4, K8
    a = write(f"{tmp}/in/Customers A.csv", "Customer ID,Name\n1,x\n")
    b = write(f"{tmp}/in/more.json", json.dumps([{"Customer ID": "2", "Name": "y"}]))
    res = ingest(spark, [a, b], f"{tmp}/lake", "customers")
    assert res["rows"] == 2
    assert sorted(r.customer_id for r in spark.read.parquet(f"{tmp}/lake/customers").collect()) == ["1", "2"]
    out = csvsrc.convert_csv_to_parquet(spark, a)
    assert spark.read.parquet(out).columns == ["customer_id", "name"]


def test_channel_extractors(spark, tmp):  # S6, S7, S8
    write(f"{tmp}/src/customers/Customers.csv", "Customer ID\n1\n")
    write(f"{tmp}/src/call_logs/call_logs_2025_11_20.csv", "Call ID\n7\n")
    write(f"{tmp}/src/other/LOGS.csv", "Call ID\n8\n")
    write(f"{tmp}/src/social/social_media_1.json", json.dumps([{"Complaint ID": "s1"}]))
    c = csvsrc.extract_customers(spark, f"{tmp}/src", as_of="2025-01-01 00:00:00")
    assert c.select("customer_id", "_source_system", "_row_count").collect()[0] == ("1", "s3_customers", 1)
    cl = csvsrc.extract_call_logs(spark, f"{tmp}/src")
    assert sorted(r.call_id for r in cl.collect()) == ["7", "8"]
    sm = jsonsrc.extract_social_media(spark, f"{tmp}/src")
    assert sm.select("complaint_id", "_source_system").collect()[0] == ("s1", "s3_social_media")


def test_verify_landing(spark, tmp):  # K16, A8, L5, X20
    for i in range(6):
        write(f"{tmp}/lake/call_logs/day={i}/part.parquet", "x" * 1024)
    res = files.verify_landing(spark, f"{tmp}/lake")
    assert res["all_present"] is False  # agents/ is empty
    assert [r.rel_path for r in res["sample"].collect()][0] == "call_logs/day=0/part.parquet"
    assert res["sample"].count() == 5 and abs(res["sample"].first().size_mb - 1 / 1024) < 1e-9


def test_sniff_fallback_through_spark(spark, tmp, monkeypatch):
    a = write(f"{tmp}/a.csv", "a,b\n1,2\n")
    j = write(f"{tmp}/j.json", '\n  [{"a": 1}]')

    def boom(*args, **kwargs):
        raise PythonException("ArrowInvalid: Unrecognized filesystem type in URI: viewfs://x")

    monkeypatch.setattr(files, "sniff_files", boom)
    heads = {r["path"]: r for r in files.sniff_heads(spark, [a, j])}
    assert heads[f"file:{a}"]["first_line"] == "a,b" and heads[f"file:{j}"]["first_char"] == "["


def test_suffix_case_rules(spark, tmp):  # S5-S9 case-sensitive suffix, S10 not
    for n in ("call_a.csv", "call_b.CSV", "x.json"):
        write(f"{tmp}/in/{n}", "Call ID\n1\n")
    assert [os.path.basename(p) for p in files.extract_csv_files(spark, f"{tmp}/in")] == ["call_a.csv"]
    assert len(files.extract_csv_files(spark, f"{tmp}/in", name_contains="CALL")) == 1
    assert csvsrc.extract_call_logs(spark, f"{tmp}/in").count() == 1
    assert len(files.fetch_files(spark, f"{tmp}/in")) == 3


def test_customers_key_may_be_a_folder(spark, tmp):  # S6
    spark.createDataFrame([("1", "a"), ("2", "b")], "`Customer ID` string, Name string") \
        .repartition(2).write.option("header", "true").csv(f"{tmp}/src/customers_export")
    df = csvsrc.extract_customers(spark, f"{tmp}/src", key="customers_export")
    assert sorted(r.customer_id for r in df.collect()) == ["1", "2"]


def test_quoted_line_breaks(spark, tmp):
    p = write(f"{tmp}/notes.csv", 'id,note\n1,"line one\nline two"\n2,"say ""hi"""\n')
    rows = sorted(tuple(r) for r in csvsrc.read_csv_files(spark, [p], multi_line=True).collect())
    assert rows == [("1", "line one\nline two"), ("2", 'say "hi"')]


def test_verify_landing_all_present(spark, tmp):  # K16
    write(f"{tmp}/lake/agents/agents.parquet", "x")
    write(f"{tmp}/lake/call_logs/a.parquet", "y")
    res = files.verify_landing(spark, f"{tmp}/lake")
    assert res["all_present"] is True
    assert {r.prefix: r.objects for r in res["summary"].collect()} == {"agents": 1, "call_logs": 1}


def test_json_lines_files(spark, tmp, monkeypatch):
    lines = write(f"{tmp}/social_lines.json", '{"a": 1, "n": {"x": 1}}\n{"a": 2}\n\n{"a": 3}\n')
    pretty = write(f"{tmp}/pretty.json", '{\n  "r1": {"a": 4}\n}\n')
    one = write(f"{tmp}/one.json", '{"r9": {"a": 5}}')
    got = sorted(r.a for r in jsonsrc.read_json_files(spark, [lines, pretty, one]).collect())
    assert got == ["1", "2", "3", "4", "5"]

    def boom(*args, **kwargs):
        raise PythonException("ArrowInvalid: Unrecognized filesystem type in URI: viewfs://x")

    monkeypatch.setattr(files, "sniff_files", boom)  # the Spark-side sniff agrees
    assert sorted(r.a for r in jsonsrc.read_json_files(spark, [lines, pretty]).collect()) == ["1", "2", "3", "4"]


def test_pretty_printed_json_documents(spark, tmp):  # multi-line object and array documents
    obj = write(f"{tmp}/obj.json", '{\n  "r1": {\n    "a": 1\n  },\n  "r2": {"a": 2}\n}\n')
    arr = write(f"{tmp}/arr.json", '[\n  {"a": 3},\n  {\n    "a": 4\n  }\n]\n')
    cols = write(f"{tmp}/cols.json", '{\n  "a": {"0": 5,\n        "1": 6}\n}\n')
    assert sorted(r.a for r in jsonsrc.read_json_files(spark, [obj, arr]).collect()) == ["1", "2", "3", "4"]
    assert sorted(r.a for r in jsonsrc.read_json_files(spark, [cols], object_orient="columns").collect()) == ["5", "6"]


def test_blank_lines_before_the_header(spark, tmp):
    a = write(f"{tmp}/a.csv", "\n  \n\r\na,b\n1,2\n3,4\n")
    b = write(f"{tmp}/b.csv", "a,b\n5,6\n")
    assert sorted(tuple(r) for r in csvsrc.read_csv_files(spark, [a, b]).collect()) == [("1", "2"), ("3", "4"), ("5", "6")]


def test_header_beyond_a_megabyte_of_blanks(spark, tmp):
    a = write(f"{tmp}/a.csv", "\n" * (3 << 19) + "a,b\n1,2\n")
    j = write(f"{tmp}/j.json", " " * (3 << 19) + '[{"a": 1}]')
    heads = {os.path.basename(r["path"]): r for r in files.sniff_heads(spark, [a, j])}
    assert heads["a.csv"]["first_line"] == "a,b" and heads["j.json"]["first_char"] == "["


def test_header_with_line_break_and_separators(spark, tmp):
    a = write(f"{tmp}/a.csv", '"x\ny",b\u2028c\n1,2\n')
    assert csvsrc.read_csv_files(spark, [a], multi_line=True).columns == ["x\ny", "b\u2028c"]


def test_extra_cells_fail_with_the_file(spark, tmp):
    a = write(f"{tmp}/odd.csv", "a,b\n1,2,3\n")
    with pytest.raises(Exception, match="more cells than the header.*odd.csv"):
        csvsrc.read_csv_files(spark, [a]).collect()


def test_short_rows_and_missing_words(spark, tmp):
    a = write(f"{tmp}/a.csv", 'a,b\n1\nNA,null\nN/A,"nan"\nnan-x,None!\n')
    got = [tuple(r) for r in csvsrc.read_csv_files(spark, [a]).collect()]
    assert got == [("1", None), (None, None), (None, None), ("nan-x", "None!")]
    kept = [tuple(r) for r in csvsrc.read_csv_files(spark, [a], null_values=()).collect()]
    assert ("NA", "null") in kept


def test_one_record_json_lines(spark, tmp):
    one = write(f"{tmp}/one.json", '{"complaint_id":"1","customer_id":"9"}\n')
    two = write(f"{tmp}/two.json", '{"complaint_id":"2","customer_id":"9"}\n{"complaint_id":"3","customer_id":"8"}')
    df = jsonsrc.read_json_files(spark, [one, two])
    assert sorted(df.columns) == ["complaint_id", "customer_id"]
    assert sorted(r.complaint_id for r in df.collect()) == ["1", "2", "3"]


def test_json_shapes(spark, tmp):
    cases = {"lines": ('{"a": "}"}\n{"a": 2}', True), "lone": ('{"a": {"b": 1}, "c": 2}', True), "records": ('{"r1": {"a": 1}, "r2": {"a": "x, :1"}}', False),
             "pretty": ('{\n "a": 1\n}', False), "empty": ("{}", False), "escaped": ('{"a\\"}": {"x": 1}}\n\n', False), "nested": ('{"r": {"x": [1, {"y": 2}]}}\n{"r": {}}', True)}
    paths = {k: write(f"{tmp}/{k}.json", text) for k, (text, _) in cases.items()}
    got = {os.path.basename(r["path"])[:-5]: r["json_lines"] for r in files.sniff_heads(spark, list(paths.values()))}
    assert got == {k: want for k, (_, want) in cases.items()}


def test_files_of_another_day_are_not_opened(spark, tmp):  # K5
    write(f"{tmp}/in/calls_2025-11-20.csv", "a,b\n1,2\n")
    write(f"{tmp}/in/calls_2025-11-21.csv", "a,b\n1,2,3,broken\n")
    res = ingest(spark, [f"{tmp}/in/calls_2025-11-20.csv", f"{tmp}/in/calls_2025-11-21.csv"], f"{tmp}/lake", "calls", incremental=True, execution_date="2025-11-20")
    assert res["rows"] == 1
