import json
import math
import random
from decimal import Decimal, getcontext

import pytest

import tablecheck as tc
from tablecheck.functions.sums import exact_sum_sql

NAN, INF = float("nan"), float("inf")


def failed(pair, **tolerance):
    rows = tc.column_diff(pair, **tolerance).collect()
    return {(r["column_name"], r["metric"]) for r in rows}


@pytest.mark.parametrize(
    "source, target, same",
    [
        (None, None, True),
        (None, 1.0, False),
        (1.0, 1.0 + 9e-7, True),
        (1.0, 1.0 + 2e-6, False),
        (0.0, -0.0, True),
        (NAN, NAN, True),
        (NAN, 1.0, False),
        (INF, INF, True),
        (INF, -INF, False),
    ],
)
def test_float_values(pair_of, source, target, same):
    pair = pair_of([(1, source)], [(1, target)], ["k"], "k int, v double")
    assert (("v", "MAX") not in failed(pair)) is same


def test_relative_tolerance(pair_of):
    pair = pair_of([(1, 1e9)], [(1, 1e9 + 1)], ["k"], "k int, v double")
    assert ("v", "SUM") in failed(pair)
    assert failed(pair, rel_tol=1e-8) == set()
    endless = pair_of([(1, INF)], [(1, INF)], ["k"], "k int, v double")
    assert failed(endless, rel_tol=1e-8) == set()


def test_float_sums_agree_in_any_order(spark, pair_of):
    values = [(i, (i * 7919 % 1000) / 7 * 1e5) for i in range(20000)]
    pair = pair_of(values, values[::-1], ["k"], "k int, v double")
    assert failed(pair) == set()
    assert ("v", "SUM") in failed(pair_of(values, values[:-1] + [(19999, 1e5)], ["k"], "k int, v double"))


def test_decimals_and_text_are_exact(pair_of):
    schema = "k int, d decimal(20,10), t string, b boolean, x date"
    from datetime import date

    one = (1, Decimal("1.0000000001"), "a", True, date(2024, 1, 1))
    two = (1, Decimal("1.0000000002"), "b", False, date(2024, 1, 2))
    found = failed(pair_of([one], [two], ["k"], schema))
    assert {c for c, _ in found} == {"d", "t", "x"}
    assert {m for c, m in found if c == "d"} == {"SUM", "AVG", "MIN", "MAX"}
    assert {m for c, m in found if c == "t"} == {"MIN", "MAX"}


def test_metrics_by_type_class(spark):
    schema = "i int, d decimal(5,2), f float, t string, ts timestamp_ntz, b boolean, y binary, a array<int>"
    df = spark.createDataFrame([], schema)
    found = {}
    for r in tc.column_metrics(df, df.columns).orderBy("__tc_metric").collect():
        found.setdefault(r["column_name"], []).append(r["metric"])
    numeric = ["NULL_COUNT", "SUM", "AVG", "MIN", "MAX"]
    ordered = ["NULL_COUNT", "MIN", "MAX"]
    only = ["NULL_COUNT"]
    assert found == {
        "i": numeric, "d": numeric, "f": numeric, "t": ordered, "ts": ordered,
        "b": only, "y": only, "a": only,
    }


def test_integer_sums_do_not_overflow(spark):
    top, low = 2**63 - 1, -(2**63)
    df = spark.createDataFrame([(top, 2**31 - 1), (top, 2**31 - 1), (top - 1, 5)], "l long, i int")
    rows = {(r["column_name"], r["metric"]): r["text"] for r in tc.column_metrics(df, ["l", "i"]).collect()}
    assert rows["l", "SUM"] == str(3 * top - 1)
    assert rows["i", "SUM"] == str(2 * (2**31 - 1) + 5)
    for value in (low, -1, 0, 1, top, -(2**42), 2**21, -(2**21) - 1):
        one = spark.range(3).selectExpr(f"cast('{value}' as bigint) as v")
        assert one.selectExpr(exact_sum_sql("v", 64)).first()[0] == 3 * value
    for bits in (8, 16, 32):
        for value in (-(2 ** (bits - 1)), -1, 0, 2 ** (bits - 1) - 1):
            one = spark.range(3).selectExpr(f"cast('{value}' as bigint) as v")
            assert one.selectExpr(exact_sum_sql("v", bits)).first()[0] == 3 * value


def metric(df, name="x", which="SUM"):
    return next(r["text"] for r in tc.column_metrics(df, [name]).collect() if r["metric"] == which)


def test_floating_point_sums_do_not_depend_on_the_order_of_rows(spark):
    random.seed(3)
    kinds = [lambda: random.gauss(0, 1), lambda: random.uniform(-1e300, 1e300), lambda: 5e-324 * random.randint(1, 99),
             lambda: -1e-260 * random.random(), lambda: 0.0, lambda: -0.0, lambda: 2.0 ** random.randint(-1070, 1000)]
    values = [random.choice(kinds)() for _ in range(300)] + [2.0**k for k in range(-1074, 1000, 3)]

    def total(rows, parts):
        df = spark.createDataFrame([(v,) for v in rows], "x double").repartition(parts)
        return metric(df), metric(df, which="AVG")

    random.shuffle(values)
    one = total(values, 3)
    assert one == total(sorted(values), 1) and float(one[0]) == pytest.approx(math.fsum(values), rel=1e-15)
    cents = [random.randint(-(10**9), 10**9) / 100 for _ in range(2000)]
    assert float(total(cents, 2)[0]) == math.fsum(cents)
    inf, nan = float("inf"), float("nan")
    assert [total(v, 1)[0] for v in ([inf, 1.0], [inf, -inf], [nan, 1.0], [-inf], [None, None])] == ["Infinity", "NaN", "NaN", "-Infinity", None]
    grouped = spark.createDataFrame([("a", 0.1)] * 10 + [("b", None), (None, 2.5)], "g string, x double")
    found = {r["group_key"]: r["text"] for r in tc.column_metrics(grouped, ["x"], ["g"]).collect() if r["metric"] == "SUM"}
    assert found == {'{"g":"a"}': "1.0", '{"g":"b"}': None, '{"g":null}': "2.5"}


@pytest.mark.parametrize("precision, scale", [(38, 0), (38, 10), (38, 38), (30, 2), (29, 29), (28, 5), (18, 2)])
def test_decimal_sums_of_any_width_are_exact(spark, precision, scale):
    random.seed(precision + scale)
    getcontext().prec = 90
    unit = Decimal(10) ** -scale
    top = (10**precision - 1) * unit
    for values in ([top, top], [-top, -top, -top], [top, -top], [random.randrange(10**precision) * unit * random.choice([1, -1]) for _ in range(9)]):
        df = spark.createDataFrame([(v,) for v in values], f"x decimal({precision},{scale})").repartition(2)
        expected = sum(values, Decimal(0))
        assert metric(df) == f"{abs(expected) if not expected else expected:.{scale}f}"


def test_sum_of_nulls_is_null(spark):
    df = spark.createDataFrame([(None,)], "i int")
    rows = {r["metric"]: r["text"] for r in tc.column_metrics(df, ["i"]).collect()}
    assert rows == {"NULL_COUNT": "1", "SUM": None, "AVG": None, "MIN": None, "MAX": None}


def test_customer_values(derived):
    pair = tc.align(derived("customer"))
    rows = {(r["column_name"], r["metric"]): r for r in tc.column_comparison(pair).collect()}
    total = rows["c_acctbal", "SUM"]
    assert round(float(total["source_value"]), 2) == 652021.72
    assert round(float(total["target_value"]), 2) == 662308.42
    keys = rows["c_nationkey", "SUM"]
    assert (keys["source_value"], keys["target_value"]) == ("1853", "1876")
    nulls = rows["c_mktsegment", "NULL_COUNT"]
    assert (nulls["source_value"], nulls["target_value"]) == ("0", "2")
    for column in ("c_acctbal", "c_mktsegment"):
        assert rows[column, "MIN"]["status"] == rows[column, "MAX"]["status"] == "PASS"


def test_grouped_metrics_with_nulls_and_clashing_names(pair_of):
    schema = "k int, status string, text string, v int"
    source = [(1, "a", "x", 1), (2, None, "x", 2), (3, "b", "x", 3)]
    target = [(1, "a", "x", 1), (2, None, "x", 5), (4, "c", "x", 4)]
    pair = pair_of(source, target, ["k"], schema)
    rows = tc.grouped_column_diff(pair, ["status"]).collect()
    groups = {json.loads(r["group_key"])["status"] for r in rows}
    assert groups == {None, "b", "c"}
    only = [r for r in rows if json.loads(r["group_key"])["status"] == "b" and r["metric"] == "COUNT"]
    assert [(r["source_value"], r["target_value"]) for r in only] == [("1", None)]
    two = tc.grouped_column_diff(pair, ["status", "text"]).first()["group_key"]
    assert list(json.loads(two)) == ["status", "text"]


def test_nations_that_differ(derived):
    pair = tc.align(derived("customer"))
    rows = tc.grouped_column_diff(pair, ["c_nationkey"])
    wanted = rows.filter("(metric = 'COUNT') or (column_name = 'c_acctbal' and metric = 'SUM')")
    assert wanted.select("group_key").distinct().count() == 3


def test_count_check(pair_of):
    pair = pair_of([(1,), (2,)], [(1,)], ["k"], "k int")
    assert tuple(tc.count_check(pair.source, pair.target).first()) == (2, 1, 1)


def test_metrics_match_on_columns(spark):
    value = "struct<exact: boolean, number: double, text: string>"
    df = spark.createDataFrame(
        [((False, 1.0, "1.0"), (False, 1.0, "1")), ((True, None, "a"), (True, None, "b"))],
        f"s {value}, t {value}",
    )
    assert [r[0] for r in df.select(tc.metrics_match("s", "t")).collect()] == [True, False]


def test_one_pass_per_side_and_one_for_floating_point_sums(derived):
    found = tc.column_comparison(tc.align(derived("orders")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 4 and "SortMergeJoin" not in plan
    assert "o_orderkey" not in plan.split("FileScan")[1].split("]")[0]
    assert sum("ReadSchema: struct<o_totalprice:double>" in x for x in plan.splitlines()) == 1


def test_several_passes_give_the_same_metrics(derived):
    pair = tc.align(derived("events"))
    one = {tuple(r) for r in tc.column_comparison(pair, rows=True).collect()}
    for size in (1, 2, 100):
        found = tc.column_comparison(pair, rows=True, columns_per_pass=size)
        assert {tuple(r) for r in found.collect()} == one


def test_values_are_cut_whole_at_fixed_places(spark):
    from fractions import Fraction

    from pyspark.sql import functions as F

    from tablecheck.functions.sums import grid_steps, on_grid_sql

    values = [0.0, 900.01, -0.07, 1e6 / 3, -(2.0**36 - 2.0**-16), 2.0**-60, 0.004, 1e-30, 2.0**36, math.inf, math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").selectExpr("x", f"{on_grid_sql('x')} as g")
    assert [r["g"] for r in df.collect()] == [True] * 7 + [False] * 4 + [None]
    cut = df.filter("g")
    for step in grid_steps("x", "y"):
        cut = cut.withColumns({k: F.expr(e) for k, e in step.items()})
    for r in cut.collect():
        assert sum(r[f"yp{i}"] * Fraction(2) ** (12 - 24 * i) for i in range(4)) == Fraction(r["x"])


def test_common_values_are_summed_without_a_row_of_their_own(spark):
    """Rows with ordinary values in several columns: one row of sums for a task, whatever the exponents."""
    df = spark.sql("select id / 100 as a, -id * 3.07D as b from range(0, 1000, 1, 2)")
    found = tc.column_metrics(df, ["a", "b"])
    assert {r["column_name"]: float(r["text"]) for r in found.collect() if r["metric"] == "SUM"} == {
        "a": math.fsum(i / 100 for i in range(1000)), "b": math.fsum(-i * 3.07 for i in range(1000))}
    assert "v0p0" in found._jdf.queryExecution().executedPlan().toString()


def test_sums_of_very_many_floating_point_columns(spark):
    df = spark.sql("select " + ", ".join(f"id * {i}.25D as c{i}" for i in range(40)) + ", id % 2 as g from range(4)")
    rows = tc.column_metrics(df, [f"c{i}" for i in range(40)], ["g"]).filter("metric = 'SUM'").collect()
    assert {(r["group_key"], r["column_name"]): float(r["text"]) for r in rows} == {
        (f'{{"g":{g}}}', f"c{i}"): (2 + 2 * g) * (i + 0.25) for i in range(40) for g in (0, 1)}
