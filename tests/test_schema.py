import hashlib
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

import tablecheck as tc
from tablecheck.operators.columns import shared_type

from conftest import SF_DIR


def frame(spark, schema):
    return spark.createDataFrame([], schema)


def test_supplier_schema(derived):
    spec = derived("supplier")
    rows = tc.schema_diff([("supplier", spec.source, spec.target)]).collect()
    assert {(r["column_name"], r["source_type"], r["target_type"], r["status"]) for r in rows} == {
        ("s_suppkey", "bigint", "int", "DATA TYPE MISMATCH"),
        ("s_nationkey", "int", None, "MISSING IN TARGET"),
        ("load_tag", None, "string", "MISSING IN SOURCE"),
    }


def test_all_pairs_in_one_table(derived):
    pairs = [(n, derived(n).source, derived(n).target) for n in ("customer", "supplier", "orders")]
    assert {r["pair"] for r in tc.schema_diff(pairs).collect()} == {"supplier"}


def test_catalog(spark):
    rows = tc.schema_catalog(frame(spark, "a int, b array<string>"), "p").collect()
    assert [tuple(r) for r in rows] == [("p", 0, "a", "int"), ("p", 1, "b", "array<string>")]


def test_strict_match_needs_name_case_and_type(spark):
    source = frame(spark, "id int, a int, B int, c string, d int")
    target = frame(spark, "d int, c string, b int, a bigint, id int")
    assert tc.common_columns(source, target, ["id"]) == ["c", "d"]
    assert tc.common_columns(source, target, ["ID"], "name") == ["a", "b", "c", "d"]


def test_relaxed_match_compares_in_a_shared_type(spark):
    source = spark.createDataFrame([(1, 5, "7", 1.5)], "ID long, a int, b string, c float")
    target = spark.createDataFrame([(1, 5, 7, 1.5)], "id int, A bigint, B int, c double")
    pair = tc.align(tc.PairSpec("x", source, target, ["ID"], match="name"))
    assert pair.keys == ["id"] and pair.columns == ["a", "b", "c"]
    assert [f.dataType.simpleString() for f in pair.schema] == ["bigint", "bigint", "string", "double"]
    assert tc.row_diff(pair).count() == 0


def test_shared_types(spark):
    cases = [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.DecimalType(10, 2), T.DecimalType(12, 4), T.DecimalType(12, 4)),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.StringType(), T.LongType(), T.StringType()),
        (T.BooleanType(), T.IntegerType(), T.StringType()),
    ]
    for left, right, expected in cases:
        assert shared_type(spark, left, right) == expected


def test_reserved_and_clashing_names_are_refused(spark):
    good = frame(spark, "a int")
    with pytest.raises(ValueError, match="__tc_"):
        tc.align(tc.PairSpec("x", frame(spark, "a int, __tc_b int"), good, ["a"]))
    clash = spark.createDataFrame([], T.StructType([T.StructField(n, T.IntegerType()) for n in "aA"]))
    with pytest.raises(ValueError, match="case"):
        tc.align(tc.PairSpec("x", good, clash, ["a"]))
    with pytest.raises(ValueError, match="no key column"):
        tc.align(tc.PairSpec("x", good, frame(spark, "b int"), ["a"]))


def test_key_names_are_found_in_any_case_when_relaxed(spark):
    source = spark.createDataFrame([(1, "a")], "KEY int, v string")
    target = spark.createDataFrame([(1, "a")], "key int, V string")
    pair = tc.align(tc.PairSpec("x", source, target, ["Key"], match="name"))
    assert pair.keys == ["key"] and pair.columns == ["v"]


def test_filters(spark):
    df = spark.range(10)
    for text in (None, "", " ", "1=1", "1 = 1"):
        assert tc.apply_filter(df, text).count() == 10
    assert tc.apply_filter(df, "id >= 4").count() == 6
    times = spark.sql("select timestamp'2026-06-01 00:00:01' as t")
    assert tc.apply_filter(times, "t >= TIMESTAMP('2026-06-01 00:00:00')").count() == 1


def test_filter_is_pushed_to_the_scan(derived, capsys):
    pair = tc.align(derived("orders", filter="o_totalprice > 1000"))
    tc.row_diff(pair).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if x.startswith("PushedFilters")]
    # Two of the digests, two of the first step, which both sides of the second read.
    assert len(pushed) == 6
    assert all("GreaterThan(o_totalprice,1000.0)" in x for x in pushed)


def test_key_and_group_filters(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "b")], "k int, g string")
    keys = spark.createDataFrame([(1,), (None,)], "id int")
    assert [r["k"] for r in tc.filter_keys(df, keys, {"id": "k"}).collect()] == [1]
    groups = spark.createDataFrame([(None,)], "g string")
    assert [r["k"] for r in tc.filter_groups(df, groups, ["g"]).collect()] == [1]


def test_numbers_of_other_types_are_compared_by_their_exact_text(spark):
    values = [1e-11, 0.0, -0.0, 1e30, 2.0**62, -(2.0**53), 0.1, 1.234e-20, float("nan"), float("inf"), 1e300, 100.0, None]
    source = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    exact = [Decimal("1e-11"), Decimal(0), Decimal(0), None, None, Decimal(-(2**53)), Decimal("0.1")]
    same = spark.createDataFrame(list(enumerate(exact)), "k int, v decimal(38,11)")
    pair = tc.align(tc.PairSpec("x", source, same, ["k"], match="name"))
    texts = {r["k"]: r["v"] for r in pair.source.collect()}
    assert [texts[i] for i in range(len(values))] == [
        "0.00000000001", "0", "0", "1" + "0" * 30, str(2**62), str(-(2**53)), "0.1", "0.00000000000000000001234", "NaN", "Infinity", "1.0E300", "100", None
    ]
    assert {r["k"]: r["v"] for r in pair.target.collect()} == {i: texts[i] if i not in (3, 4) else None for i in range(7)}
    large = spark.createDataFrame([(3, Decimal(10**30))], "k int, v decimal(38,4)")
    assert tc.align(tc.PairSpec("x", source, large, ["k"], match="name")).target.first()["v"] == texts[3]
    long = spark.createDataFrame([(0, 0), (1, 1), (4, 2**62), (5, -(2**53) + 1)], "k int, v long")
    different = tc.row_diff(tc.align(tc.PairSpec("x", source, long, ["k"], match="name"))).filter("mismatch_type = 'HASH_MISMATCH'")
    assert sorted(r["k"] for r in different.collect()) == [0, 1, 5]


def test_a_mapped_pair_has_no_schema_findings(spark, run):
    source = spark.createDataFrame([(1, "a", 2.0)], "ID int, Name string, v double")
    target = spark.createDataFrame([(1, "a", 2.0)], "id int, label string, v double")
    spec = tc.PairSpec("x", source, target, ["ID"], target_keys=["id"], column_map={"Name": "label"})
    for one in (spec, replace(spec, match="name")):
        assert {r["status"] for r in tc.validate_pair(one, run).results.collect()} == {"PASS"}
        assert {r["status"] for r in tc.validate_column(one, run).results.collect()} == {"PASS"}
    assert [r["column_name"] for r in tc.validate_schema(replace(spec, column_map={}), run).results.orderBy("column_name").collect()] == ["Name", "label"]
    with pytest.raises(ValueError):
        tc.align(replace(spec, column_map={"Name": "nowhere"}))


def test_each_side_may_have_its_own_filter(spark):
    source = spark.createDataFrame([(1, "keep"), (2, "drop")], "k int, v string")
    target = spark.createDataFrame([(1, "keep"), (3, "old")], "k int, v string")
    spec = tc.PairSpec("x", source, target, ["k"], filter="v = 'keep'")
    assert tc.row_diff(tc.align(spec)).count() == 0
    assert [r["k"] for r in tc.row_diff(tc.align(replace(spec, target_filter="k < 10"))).collect()] == [3]


def test_a_null_is_not_the_text_null(spark, run):
    source, target = (spark.createDataFrame([(1, v)], "k int, v string") for v in ("NULL", None))
    spec = tc.PairSpec("x", source, target, ["k"])
    assert {r["metric"]: r["status"] for r in tc.validate_row(spec, run).results.collect()}["HASH_MISMATCH"] == "FAIL"
    compat = tc.validate_row(replace(spec, hash_mode="compat"), run).results.collect()
    assert {r["status"] for r in compat} == {"PASS"}


def test_sample_takes_two_scans_whatever_repeats(spark):
    df = spark.range(200_000).selectExpr("if(id < 150000, 7, id % 4000) as k", "id as v")
    for n in (1, 5, 300, 3999, 5000):
        got = [r["k"] for r in tc.sample_keys(df, ["k"], n, seed=1).collect()]
        order = sorted({7, *range(4000)}, key=lambda k: hashlib.sha256(f"{k}:1".encode()).hexdigest())
        assert sorted(got) == sorted(order[:n])
    assert tc.sample_keys(df.filter("k < 0"), ["k"], 3).count() == 0


def test_counts_come_from_the_footers(spark):
    table = tc.load_with_footers(spark, f"{SF_DIR}/orders.parquet")
    told = table.agg(F.count("*"), F.min("o_orderkey"), F.max("o_custkey"))
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(o_orderkey), MAX(o_custkey)]" in plan
    assert told.first() == tc.load_table(spark, f"{SF_DIR}/orders.parquet").agg(F.count("*"), F.min("o_orderkey"), F.max("o_custkey")).first()
    # With a filter, or for text, the rows are read.
    some = table.filter("o_orderkey > 10").agg(F.count("*"), F.min("o_orderstatus"))
    assert "PushedAggregation: []" in some._jdf.queryExecution().executedPlan().toString() and some.first()[0] < told.first()[0]
    count = tc.count_check(table, table)
    assert count._jdf.queryExecution().executedPlan().toString().count("PushedAggregation: [COUNT(*)]") == 2
