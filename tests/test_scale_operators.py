"""Buckets, samples and grouped drill-down."""

import json

import pytest
from pyspark.sql import functions as F

import tablecheck as tc


@pytest.mark.parametrize("table", ["customer", "events", "lineitem", "orders"])
@pytest.mark.parametrize("algo", ["xxhash64", "sha256"])
def test_narrowed_diff_equals_full_diff(derived, table, algo):
    pair = tc.align(derived(table))
    full = {tuple(r) for r in tc.row_diff(pair).collect()}
    assert {tuple(r) for r in tc.narrowed_row_diff(pair, 64, algo).collect()} == full


def test_narrowing_keeps_equal_rows_without_a_key(pair_of):
    rows = [(None, "a"), (1, "a"), (2, "b")]
    pair = pair_of(rows, rows, ["k"], "k int, v string")
    assert tc.row_diff(pair).count() == 2
    for algo in ("xxhash64", "sha256"):
        assert tc.narrowed_row_diff(pair, 64, algo).count() == 2


def test_equal_tables_have_no_differing_bucket(derived):
    spec = derived("lineitem")
    pair = tc.align(tc.PairSpec("x", spec.source, spec.source.repartition(5), spec.keys))
    assert tc.differing_buckets(pair, 64).count() == 0


@pytest.mark.parametrize("algo", ["xxhash64", "sha256"])
def test_fingerprints_see_what_a_plain_xor_misses(pair_of, algo):
    schema = "k int, v string"
    twice = pair_of([(1, "a"), (1, "a")], [(1, "b"), (1, "b")], ["k"], schema)
    assert tc.differing_buckets(twice, 1, algo).count() == 1
    swapped = pair_of([(1, "a"), (2, "b")], [(1, "b"), (2, "a")], ["k"], schema)
    assert tc.differing_buckets(swapped, 1, algo).count() == 1


def test_differing_buckets_of_the_customer_pair(derived):
    pair = tc.align(derived("customer"))
    by_key = F.expr("cast(c_custkey % 64 as int)")
    digest = tc.row_hash(pair.schema, pair.columns)

    def side(df):
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        return df.groupBy(by_key.alias("b")).agg(F.count("*").alias("n"), F.bit_xor(number).alias("x"))

    joined = side(pair.source).alias("s").join(side(pair.target).alias("t"), "b", "full_outer")
    different = joined.filter("not (s.n <=> t.n and s.x <=> t.x)").count()
    assert different == 7


def test_sample_is_repeatable_and_distinct(derived):
    spec = derived("customer")
    keys = [r[0] for r in tc.sample_keys(spec.source, ["c_custkey"], 5, 42).collect()]
    assert keys == [18, 86, 145, 40, 36]
    again = tc.sample_keys(spec.source.repartition(3), ["c_custkey"], 5, 42).collect()
    assert [r[0] for r in again] == keys
    assert [r[0] for r in tc.sample_keys(spec.source, ["c_custkey"], 5, 7).collect()] != keys


def test_sample_finds_enough_keys_behind_a_hot_one(spark):
    """Nearly all rows share a key, so the first guess of the threshold is too low."""
    df = spark.range(40_000).selectExpr("if(id < 39900, -1L, id) as k")
    drawn = tc.sample_keys(df, ["k"], 60, 1)
    assert drawn.distinct().count() == 60
    expected = (
        df.distinct()
        .orderBy(F.sha2(F.concat(F.col("k").cast("string"), F.lit(":1")), 256))
        .limit(60)
    )
    assert {r[0] for r in drawn.collect()} == {r[0] for r in expected.collect()}
    assert tc.sample_keys(df, ["k"], 500, 1).count() == 101


def test_sample_skips_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (1, 1), (2, None)], "a int, b int")
    assert [tuple(r) for r in tc.sample_keys(df, ["a", "b"], 5).collect()] == [(1, 1)]
    with pytest.raises(ValueError):
        tc.sample_keys(df, [], 5)


def test_sampling_all_keys_equals_the_full_diff_of_source_keys(derived):
    pair = tc.align(derived("customer"))
    part = {tuple(r) for r in tc.row_diff(tc.sampled(pair, 10_000)).collect()}
    full = {tuple(r) for r in tc.row_diff(pair).collect()}
    assert part == {r for r in full if r[1] != "MISSING_IN_SOURCE"}


def test_empty_sample_compares_nothing(pair_of):
    pair = pair_of([], [(1, "a")], ["k"], "k int, v string")
    assert tc.row_diff(tc.sampled(pair, 5)).count() == 0


def drill(pair, groups):
    found = tc.grouped_drilldown(pair, groups)
    outcome = {(r["level"], r["group_key"]): r["outcome"] for r in found.groups.collect()}
    rows = {
        (r["group_key"], r["primary_key_value"]): r["mismatch_type"] for r in found.rows.collect()
    } if found.rows is not None else None
    return outcome, rows, found


def test_drilldown(pair_of):
    schema = "k int, g string, h string, v int"
    source = [(1, "a", "x", 1), (2, "a", "y", 2), (3, "b", "x", 3), (4, None, "x", 4), (5, "c", "x", 5)]
    target = [(1, "a", "x", 1), (2, "a", "y", 9), (3, "b", "x", 3), (4, None, "x", 8), (6, "d", None, 6)]
    outcome, rows, found = drill(pair_of(source, target, ["k"], schema), ["g", "h"])
    assert outcome == {
        (1, '{"g":"b"}'): "PASS",
        (2, '{"g":"a","h":"x"}'): "PASS",
        (2, '{"g":"a","h":"y"}'): "FAIL",
        (2, '{"g":null,"h":"x"}'): "FAIL",
        (2, '{"g":"c","h":"x"}'): "FAIL",
        (2, '{"g":"d","h":null}'): "FAIL",
    }
    assert rows == {
        ('{"g":"a","h":"y"}', '{"k":2}'): "HASH_MISMATCH",
        ('{"g":null,"h":"x"}', '{"k":4}'): "HASH_MISMATCH",
        ('{"g":"c","h":"x"}', '{"k":5}'): "MISSING_IN_TARGET",
        ('{"g":"d","h":null}', '{"k":6}'): "MISSING_IN_SOURCE",
    }
    metrics = found.metrics.filter("group_key = '{\"g\":\"b\"}'").collect()
    assert {(r["column_name"], r["metric"]) for r in metrics} >= {("*", "COUNT"), ("v", "SUM")}


def test_drilldown_matches_failing_groups_of_any_size(pair_of):
    schema = "k int, g string, v int"
    source = [(i, "a" if i % 2 else "b", 1) for i in range(100)]
    target = [(i, g, 2 if i == 40 else v) for i, g, v in source]
    outcome, rows, _ = drill(pair_of(source, target, ["k"], schema), ["g"])
    assert outcome == {(1, '{"g":"a"}'): "PASS", (1, '{"g":"b"}'): "FAIL"}
    assert list(rows) == [('{"g":"b"}', '{"k":40}')]


def test_drilldown_without_keys_reports_failing_groups(pair_of):
    outcome, rows, found = drill(pair_of([("a", 1)], [("a", 2)], [], "g string, v int"), ["g"])
    assert outcome == {(1, '{"g":"a"}'): "FAIL"} and rows is None
    assert found.metrics.filter("status = 'FAIL'").count() > 0


def test_a_group_that_differs_in_a_repeated_row_only_is_reported(pair_of):
    schema = "k int, g string, v int"
    pair = pair_of([(1, "a", 1), (1, "a", 2)], [(1, "a", 1), (1, "a", 3)], ["k"], schema)
    assert drill(pair, ["g"])[0] == {(1, '{"g":"a"}'): "FAIL"}


def test_drilldown_finds_what_aggregates_can_show(derived):
    """Only a row that returned under another key goes unseen."""
    pair = tc.align(derived("customer"))
    found = tc.grouped_drilldown(pair, ["c_nationkey", "c_mktsegment"])
    keys = {json.loads(r["primary_key_value"])["c_custkey"] for r in found.rows.collect()}
    assert {r["c_custkey"] for r in tc.row_diff(pair).collect()} - keys == {0, 1_000_000}


def test_unknown_group_column(derived):
    with pytest.raises(ValueError, match="shared"):
        tc.grouped_drilldown(tc.align(derived("customer")), ["nope"])


def test_tree_finds_a_changed_row_in_one_leaf(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("id as k", "id * 7 as v")
    changed = rows.withColumn("v", F.expr("if(k = 4711, -1, v)"))
    one, two = (tc.stored_tree(df, ["k"], ["v"], str(tmp_path), name, depth=3, fanout=8) for df, name in ((rows, "v1"), (changed, "v2")))
    assert tc.differing_leaves(one, two).count() == 1
    diff = tc.tree_row_diff(one, two)
    assert [(r["k"], r["mismatch_type"]) for r in diff.collect()] == [(4711, "HASH_MISMATCH")]
    assert diff.select("source_row_hash", "target_row_hash").collect() == tc.row_diff(
        tc.align(tc.PairSpec("x", rows, changed, ["k"]))
    ).select("source_row_hash", "target_row_hash").collect()
    # Neither table is read, and of the stored keys only the folder of the leaf's first node.
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "dynamicpruning" in plan.lower()
    assert tc.differing_leaves(one, one).count() == 0 and tc.tree_row_diff(one, one).count() == 0


def test_tree_is_built_once_for_a_version(spark, tmp_path):
    rows = spark.range(100).selectExpr("id as k", "id as v")
    first = tc.stored_tree(rows, ["k"], ["v"], str(tmp_path), "v1", depth=2, fanout=4)
    # The version is there: the table given is not even looked at.
    again = tc.stored_tree(rows.limit(0), ["k"], ["v"], str(tmp_path), "v1", depth=2, fanout=4)
    assert again.rows.count() == 100 and tc.tree_row_diff(first, again).count() == 0
    with pytest.raises(ValueError):
        tc.differing_leaves(first, tc.stored_tree(rows, ["k"], ["v"], str(tmp_path), "deep", depth=3, fanout=4))


def test_tree_with_odd_rows(spark, tmp_path):
    schema = "k int, l string, v string"
    source = [(1, "a", "x"), (1, "a", "y"), (None, "a", "n"), (2, None, "z"), (3, "c", None), (4, "d", "same"), (4, "d", "same")]
    target = [(1, "a", "y"), (1, "a", "x"), (None, "a", "n"), (3, "c", "now"), (4, "d", "same"), (5, "e", "new")]
    pair = tc.align(tc.PairSpec("x", spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), ["k", "l"]))
    trees = [tc.stored_tree(df, pair.keys, pair.columns, str(tmp_path), name) for df, name in ((pair.source, "s"), (pair.target, "t"))]
    assert {tuple(r) for r in tc.tree_row_diff(*trees).collect()} == {tuple(r) for r in tc.row_diff(pair).collect()}
    empty = tc.stored_tree(pair.source.limit(0), pair.keys, pair.columns, str(tmp_path), "none")
    assert tc.tree_row_diff(trees[0], empty).count() == 5


def test_trees_keep_digests_as_bytes(spark, tmp_path):
    tree = tc.stored_tree(spark.range(5).selectExpr("id as k", "id as v"), ["k"], ["v"], str(tmp_path), "v1", depth=1, fanout=2)
    rows = tree.rows.selectExpr("octet_length(__tc_digest) as n", "lower(hex(__tc_digest)) = sha2(concat('V1:', k), 256) as same")
    assert {tuple(r) for r in rows.collect()} == {(32, True)}
