import pytest

from conftest import write
from tributary.streaming.landing import land_csv_stream


def test_rerun_adds_nothing_and_late_file_keeps_day(spark, tmp):  # T1, F13, F17
    write(f"{tmp}/in/calls_2025-11-20.csv", "Call ID,v\n1,a\n2,b\n")
    write(f"{tmp}/in/calls_2025-11-21.csv", "Call ID,v\n3,c\n")
    target, ckpt = f"{tmp}/lake", f"{tmp}/ckpt"
    land_csv_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    land_csv_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    assert spark.read.parquet(target).count() == 3
    write(f"{tmp}/in/calls_2025-11-20_late.csv", "Call ID,v\n4,d\n")
    land_csv_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    rows = sorted((r.day, r.call_id) for r in spark.read.parquet(target).collect())
    assert rows == [(20, "1"), (20, "2"), (20, "4"), (21, "3")]


def test_backfill_writes_only_missing_days(spark, tmp):  # T2
    import datetime as dt
    from tributary.plans.backfill import backfill, missing_days, present_days
    src = spark.createDataFrame([(i, dt.datetime(2025, 11, 20 + i)) for i in range(4)], "id int, ts timestamp_ntz")
    backfill(src.where("id < 2"), "ts", "2025-11-20", "2025-11-23", f"{tmp}/t")
    res = backfill(src, "ts", "2025-11-20", "2025-11-23", f"{tmp}/t")
    assert res["rows"] == 2
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/t").collect()) == [0, 1, 2, 3]
    todo = missing_days(present_days(src, "ts"), "2025-11-19", "2025-11-24").collect()
    assert sorted(str(r.day) for r in todo) == ["2025-11-19", "2025-11-24"]


def test_json_stream_landing(spark, tmp):  # T1 for JSON arrays
    import json
    from tributary.streaming.landing import land_json_stream
    write(f"{tmp}/in/social_media_2025-11-20.json", json.dumps([{"Complaint ID": "s1", "n": {"x": 1}},
                                                                  {"Complaint ID": "s2"}]))
    target, ckpt = f"{tmp}/lake", f"{tmp}/ckpt"
    land_json_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    write(f"{tmp}/in/social_media_2025-11-21.json", json.dumps([{"Complaint ID": "s3", "n": {"x": 2}}]))
    land_json_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    land_json_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    rows = sorted((r.day, r.complaint_id) for r in spark.read.parquet(target).collect())
    assert rows == [(20, "s1"), (20, "s2"), (21, "s3")]


def test_stream_refuses_mixed_headers(spark, tmp):  # F1 in a stream
    import pytest
    from tributary.streaming.landing import HeaderShapeError, land_csv_stream
    write(f"{tmp}/in/calls_2025-11-20.csv", "a,b\n1,2\n")
    write(f"{tmp}/in/calls_2025-11-21.csv", "b,a\n2,1\n")
    with pytest.raises(HeaderShapeError):
        land_csv_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ckpt", as_of="2025-12-01")


def test_later_file_with_another_header_fails(spark, tmp):  # F1 after the start
    import pytest
    from tributary.streaming.landing import land_csv_stream
    write(f"{tmp}/in/calls_2025-11-20.csv", "a,b\n1,2\n")
    target, ckpt = f"{tmp}/lake", f"{tmp}/ckpt"
    land_csv_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01")
    write(f"{tmp}/in/calls_2025-11-21.csv", "b,a\n2,1\n")
    with pytest.raises(Exception):
        land_csv_stream(spark, f"{tmp}/in", target, ckpt, as_of="2025-12-01", check_headers=False,
                        schema=spark.createDataFrame([], "a string, b string").schema)
    assert spark.read.parquet(target).count() == 1


def test_json_stream_takes_all_columns_and_lines(spark, tmp):
    from tributary.streaming.landing import land_json_stream
    write(f"{tmp}/in/s_2025-11-20.json", '[{"a": 1}]')
    write(f"{tmp}/in/s_2025-11-21.json", '[{"a": 2, "b": 3}]')
    land_json_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ckpt", as_of="2025-12-01")
    assert sorted((r.a, r.b) for r in spark.read.parquet(f"{tmp}/lake").collect()) == [("1", None), ("2", "3")]
    write(f"{tmp}/lines/s_2025-11-20.json", '{"a": 1}\n{"a": 2}\n')
    write(f"{tmp}/lines/s_2025-11-21.json", '{"a": 3}')
    land_json_stream(spark, f"{tmp}/lines", f"{tmp}/lake2", f"{tmp}/ckpt2", as_of="2025-12-01")
    assert sorted(r.a for r in spark.read.parquet(f"{tmp}/lake2").collect()) == ["1", "2", "3"]


def test_json_stream_refuses_other_shapes(spark, tmp):
    import pytest
    from tributary.streaming.landing import JsonShapeError, land_json_stream
    write(f"{tmp}/in/s_2025-11-20.json", '{"r1": {"a": 1}}')
    with pytest.raises(JsonShapeError):
        land_json_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ckpt", as_of="2025-12-01")


def test_csv_stream_and_batch_give_the_same_rows(spark, tmp):
    """Quoted breaks, missing words and short rows: one treatment, whatever the path."""
    write(f"{tmp}/in/a_2025-11-20.csv", 'id,note,more\n1,"line one\nline two",x\n2,NA,\n3\n4,"say ""hi"", ok",n/a\n')
    land_csv_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ckpt", as_of="2025-12-01")
    from tributary.sources.csvsrc import read_csv_files
    got = {tuple(r) for r in spark.read.parquet(f"{tmp}/lake").select("id", "note", "more").collect()}
    assert got == {tuple(r) for r in read_csv_files(spark, [f"{tmp}/in/a_2025-11-20.csv"]).collect()}
    assert got == {("1", "line one\nline two", "x"), ("2", None, None), ("3", None, None), ("4", 'say "hi", ok', None)}


def test_rows_that_do_not_fit_are_never_lost(spark, tmp):
    from tributary.streaming.landing import replay_dead_letters
    write(f"{tmp}/in/a_2025-11-20.csv", 'id,note\n1,a\n2,b,EXTRA\n3,"c\nd",more\n4\n')
    with pytest.raises(Exception, match="more cells than the header"):
        land_csv_stream(spark, f"{tmp}/in", f"{tmp}/strict", f"{tmp}/strict-ckpt", as_of="2025-12-01")
    for _ in range(2):          # a second run on the same checkpoint adds nothing
        land_csv_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ckpt", as_of="2025-12-01", dead_letter_path=f"{tmp}/dead")
    assert {tuple(r) for r in spark.read.parquet(f"{tmp}/lake").select("id", "note").collect()} == {("1", "a"), ("4", None)}
    dead = spark.read.parquet(f"{tmp}/dead").collect()
    assert len(dead) == 2 and all(r.file.endswith("a_2025-11-20.csv") and "more cells" in r.reason for r in dead)
    replayed = replay_dead_letters(spark, f"{tmp}/dead", ["id", "note", "late"]).collect()
    assert {(r.id, r.note, r.late) for r in replayed} == {("2", "b", "EXTRA"), ("3", "c\nd", "more")}


def test_malformed_json_goes_to_the_dead_letters(spark, tmp):
    from tributary.streaming.landing import land_json_stream
    write(f"{tmp}/in/a_2025-11-20.json", '{"id": 1, "t": "x"}\n{"id": 2, "t": \n{"id": 3, "t": "z"}\n')
    with pytest.raises(Exception, match="not JSON"):
        land_json_stream(spark, f"{tmp}/in", f"{tmp}/strict", f"{tmp}/strict-ckpt", as_of="2025-12-01")
    land_json_stream(spark, f"{tmp}/in", f"{tmp}/lake", f"{tmp}/ckpt", as_of="2025-12-01", dead_letter_path=f"{tmp}/dead")
    lake = spark.read.parquet(f"{tmp}/lake")
    assert "_corrupt_record" not in lake.columns and {r.id for r in lake.collect()} == {"1", "3"}
    assert [r.record for r in spark.read.parquet(f"{tmp}/dead").collect()] == ['{"id": 2, "t": ']
