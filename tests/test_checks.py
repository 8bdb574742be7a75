from tributary.operators import checks as D
from tributary.operators.retention import expired_partitions, retention_tiers
from tributary.operators.union import union_by_name


def test_relationship_orphans_skip_null_keys(spark):  # D2, F12
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, cust int")
    parent = spark.createDataFrame([(10,), (None,)], "cust int")
    assert [r.id for r in D.relationship_orphans(child, "cust", parent).collect()] == [3]


def test_accepted_values_and_duplicate_groups(spark):  # D3, D4
    df = spark.createDataFrame([("Resolved", 1), ("Lost", 1), ("Lost", 2), (None, 2)], "s string, k int")
    assert [tuple(r) for r in D.accepted_values_violations(df, "s", ["Resolved"]).collect()] == [("Lost", 2)]
    assert sorted(tuple(r) for r in D.duplicate_key_groups(df, ["k"]).collect()) == [(1, 2), (2, 2)]


def test_type_conformance(spark):  # D5
    df = spark.createDataFrame([("1", 2), ("x", 3), (None, 4)], "a string, b int")
    out = {r.column: r for r in D.type_conformance(df, {"a": "int", "b": "int", "c": "string"}).collect()}
    assert out["a"].bad_values == 1 and out["a"].type_matches is False
    assert out["b"].type_matches is True and out["c"].actual_type is None


def test_completeness_uniqueness(spark):  # D6, D7
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "b"), (3, float("nan"))], "k int, v string")
    comp = {r.column: r.completeness for r in D.completeness(df, ["v"]).collect()}
    assert comp == {"v": 0.75}
    u = D.uniqueness(df, ["k"]).collect()[0]
    assert (u.rows, u.distinct_keys, u.duplicate_rows) == (4, 3, 1)
    a = D.uniqueness(df, ["k"], approximate=True).collect()[0]
    assert a.distinct_keys == 3


def test_consistency_statuses(spark):  # D8
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    got = {r.key: (r.n_a, r.n_b, r.status) for r in D.cross_source_consistency(a, "k", b, "k", "a", "b").collect()}
    assert got == {1: (2, None, "only_a"), 2: (1, 1, "both"), 3: (None, 1, "only_b")}


def test_freshness_and_rules(spark):  # D9, D10
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 5), (dt.datetime(2024, 1, 10), -1)], "ts timestamp_ntz, v int")
    f = D.freshness(df, "ts", "2024-01-12", max_age_days=1).collect()[0]
    assert f.age_days == 2 and f.fresh is False
    r = {x.rule: x.violations for x in D.business_rules(df, {"pos": "v >= 0", "big": "v < 100"}).collect()}
    assert r == {"pos": 1, "big": 0}


def test_union_by_name_promotes_types(spark):  # U1, F2
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("2", 3.5)], "id string, d double")
    out = union_by_name([a, b])
    assert dict(out.dtypes) == {"id": "string", "s": "string", "d": "double"}
    assert sorted(r.id for r in out.collect()) == ["1", "2"]


def test_retention_tiers(spark):  # R1
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 9, 1),), (dt.date(2024, 12, 1),)], "d date")
    tiers = [r.tier for r in retention_tiers(df, "d", "2025-01-05").orderBy("d").collect()]
    assert tiers == ["expired", "archive", "standard"]
    assert expired_partitions(df.selectExpr("d", "year(d) as year"), ["year"], "d", "2025-01-05").count() == 1


from hypothesis import given, settings
from hypothesis import strategies as st


@given(st.lists(st.dictionaries(st.sampled_from(["a", "b", "c"]), st.integers(0, 9), min_size=1), min_size=1,
                max_size=4))
@settings(max_examples=8, deadline=None)
def test_union_by_name_matches_python_model(spark, frames):  # U1 property
    dfs = []
    for d in frames:
        cols = sorted(d)
        dfs.append(spark.createDataFrame([tuple(d[c] for c in cols)], ", ".join(f"{c} int" for c in cols)))
    out = union_by_name(dfs)
    order = []
    for d in frames:
        for c in sorted(d):
            if c not in order:
                order.append(c)
    assert out.columns == order
    key = lambda t: tuple((v is None, v or 0) for v in t)
    got = sorted((tuple(r) for r in out.collect()), key=key)
    want = sorted((tuple(d.get(c) for c in order) for d in frames), key=key)
    assert got == want


def test_union_numeric_widening(spark):
    from decimal import Decimal
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([(Decimal("1.25"),)], "v decimal(10,2)")
    c = spark.createDataFrame([(5,)], "v bigint")
    assert dict(union_by_name([a, b]).dtypes)["v"] == "decimal(38,2)"
    assert dict(union_by_name([a, c]).dtypes)["v"] == "bigint"
    assert sorted(float(r.v) for r in union_by_name([a, b]).collect()) == [1.0, 1.25]


def test_profile_is_one_pass(spark):  # A1+A3+D5+D6+D10 fused
    from conftest import plan_text
    df = spark.createDataFrame([("1", 5.0), ("x", None), (None, float("nan"))], "a string, v double")
    p = D.profile(df, min_rows=2, not_null=["a", "v"], completeness_of=["v"], expected_types={"a": "int"},
                  rules={"v_pos": "v > 0"})
    got = {(r.metric, r.subject): (r.value, r.passed) for r in p.collect()}
    assert got[("row_count", "*")] == (3.0, True)
    assert got[("null_count", "a")] == (1.0, False) and got[("null_count", "v")] == (2.0, False)
    assert abs(got[("completeness", "v")][0] - 1 / 3) < 1e-12
    assert got[("bad_type_values", "a")] == (1.0, False)
    assert got[("rule_violations", "v_pos")] == (0.0, True)  # NULL is not a violation; NaN > 0 holds in Spark
    text = plan_text(p)
    assert "Exchange hashpartitioning" not in text and text.count("Scan ExistingRDD") + text.count("Scan") >= 1


def test_consistency_null_keys_meet_and_no_extra_shuffle(spark):
    from conftest import plan_text
    a = spark.createDataFrame([(None,), (1,)], "k int")
    b = spark.createDataFrame([(None,), (None,)], "k int")
    out = D.cross_source_consistency(a, "k", b, "k", "a", "b")
    text = plan_text(out)  # before execution: the plan is printed once
    assert text.count("Exchange hashpartitioning") == 2  # the join reuses the aggregates' partitioning
    got = {r.key: (r.n_a, r.n_b, r.status) for r in out.collect()}
    assert got == {None: (1, 2, "both"), 1: (1, None, "only_a")}


def test_empty_table(spark):  # D6, D7, profile
    none = spark.createDataFrame([], "a int, b string")
    c = D.completeness(none, ["a"]).first()
    assert (c.non_null, c.total, c.completeness) == (0, 0, None)
    u = D.uniqueness(none, ["a", "b"]).first()
    assert (u.rows, u.distinct_keys, u.uniqueness) == (0, 0, None)
    rows = {(r.metric, r.subject): (r.value, r.passed) for r in D.profile(none, min_rows=1, completeness_of=["a"], rules={"r": "a > 0"}).collect()}
    assert rows == {("row_count", "*"): (0.0, False), ("completeness", "a"): (None, True), ("rule_violations", "r"): (0.0, True)}
