"""safe_cast must equal try_cast on every string (it only skips work), but
for a time without a date, which is NULL instead of today."""

import re

from hypothesis import example, given, seed, settings
from hypothesis import strategies as st

from tributary.functions.casts import safe_cast

TYPES = ["int", "bigint", "tinyint", "double", "float", "decimal(10,2)", "boolean", "date", "timestamp",
         "timestamp_ntz"]

_alphabet = st.sampled_from(list("0123456789+-.eEdDfFxp :T") + ["\t", "\n", "\x01", "\x7f", "\u00a0", " ", "NaN", "Infinity", "inf",
                                                                "true", "no", "Y", "\u0661\u0662", "2024-01-05", "10:30"])
_strings = st.lists(_alphabet, max_size=8).map("".join)


def _starts_with_a_year(value):
    return re.match(r"[\x00-\x20\x7f]*[+-]?[0-9]{4}", value) is not None


@seed(20)
@given(st.lists(_strings, min_size=1, max_size=40))
@example(["T0", "T10:30", "10:30", "\x7f42", "0x1p3", "\u0661\u0662", "-0xAp2 ", "1e400", "+2024-01-05T10:30"])
@settings(max_examples=20, deadline=None)
def test_safe_cast_equals_try_cast(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    cols = []
    for i, t in enumerate(TYPES):
        cols.append(df["s"].try_cast(t).cast("string").alias(f"a{i}"))
        cols.append(safe_cast("s", t).cast("string").alias(f"b{i}"))
    for r in df.select("s", *cols).collect():
        for i, t in enumerate(TYPES):
            want = r[f"a{i}"] if not t.startswith("timestamp") or _starts_with_a_year(r["s"]) else None
            assert want == r[f"b{i}"], (t, repr(r["s"]), r[f"a{i}"], r[f"b{i}"])


def test_times_without_a_date_are_not_today(spark):
    df = spark.createDataFrame([("T0",), ("T10:30",), ("10:30",), ("2024-01-05 10:30",)], "s string")
    got = [r[0] for r in df.select(safe_cast("s", "timestamp_ntz").cast("string")).collect()]
    assert got == [None, None, None, "2024-01-05 10:30:00"]


def test_known_values(spark):
    rows = [(" 42 ",), ("4.2",), ("1e3",), ("x",), ("\t-7\n",), ("NaN",), ("2024-01-05",), ("yes",)]
    df = spark.createDataFrame(rows, "s string")
    got = [tuple(r) for r in df.select(safe_cast("s", "int"), safe_cast("s", "double"), safe_cast("s", "boolean"),
                                       safe_cast("s", "date")).collect()]
    assert got[0][0] == 42 and got[2][1] == 1000.0 and got[3] == (None, None, None, None)
    assert got[4][0] == -7 and got[7][2] is True and str(got[6][3]) == "2024-01-05"
