"""Sinks, whole validations, inventories and plans."""

import json
import uuid
from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tablecheck as tc
from tablecheck.plans.inventory import InventoryError, Rule
from tablecheck.plans.validate import audit_rows, stamp
from tablecheck.session import scratch_path, scratch_root
from tablecheck.sources.inventory import clean_inventory
from tablecheck.sources.tables import jdbc_options
from tablecheck.spec import AUDIT_SCHEMA, RESULT_SCHEMA

HEADER = "source_table,target_table,validation_type,primary_key,filter_condition"

# Ten pairs: six by row, four by column, eight with a filter, one with a composite key.
INVENTORY = f"""{HEADER}
SALES.ORDERS,dw.orders,row,o_orderkey,o_orderdate >= '2024-01-01'
SALES.REGION,dw.region,column,,
SALES.CUSTOMER,dw.customer,row,c_custkey,c_mktsegment = 'BUILDING'
SALES.PART,dw.part,column,,p_size > 3
SALES.SUPPLIER,dw.supplier,row,s_suppkey,s_nationkey = 7
SALES.NATION,dw.nation,column,,
WEB.PAGES,dw.pages,row,page_id,url like 'https%'
WEB.EVENTS,dw.events,row,event_id,ts >= TIMESTAMP('2024-01-01 06:00:00')
WEB.LABELS,dw.labels,column,,toxic = 0
SALES.LINEITEM,dw.lineitem,row,"l_orderkey,l_linenumber",l_quantity < 40
"""


def results(df):
    return {
        (r["check"], r["column_name"], r["metric"]): r for r in df.collect()
    }


@pytest.fixture
def targets(spark):
    return scratch_path(spark, "test-results"), scratch_path(spark, "test-audit")


# Sinks


def test_audit_round_trip(spark, derived, run, targets):
    spec = derived("customer")
    pair = tc.align(spec)
    rows = audit_rows(tc.with_details(pair, tc.row_diff(pair)), spec, run)
    tc.write_audit(rows, targets[1])
    tc.write_audit(rows.withColumn("run_id", F.lit("other")), targets[1])
    back = tc.first_mismatches(spark, targets[1], "run-1", 3)
    assert back.columns == AUDIT_SCHEMA.names
    keys = [r["primary_key_value"] for r in back.collect()]
    assert keys == sorted(keys) and len(keys) == 3
    assert tc.read_mismatches(spark, targets[1], "run-1").count() == 8
    assert str(back.first()["validation_time"]) == "2026-07-16 09:55:44"


def test_replacing_a_run_leaves_its_rows_once(spark, derived, run, targets):
    result = tc.validate_pair(derived("customer"), run).results
    other = result.withColumn("pair", F.lit("other"))
    for _ in range(2):
        tc.write_results(result, targets[0], "replace")
        tc.write_results(other, targets[0], "replace")
    assert spark.read.parquet(targets[0]).count() == 2 * result.count()
    tc.write_results(result, targets[0], "append")
    assert spark.read.parquet(targets[0]).count() == 3 * result.count()
    with pytest.raises(ValueError):
        tc.write_results(result, targets[0], "truncate")


def test_catalog_tables_as_targets(spark, derived, run):
    name = f"results_{uuid.uuid4().hex[:8]}"
    result = tc.validate_pair(derived("orders"), run).results
    for _ in range(2):
        tc.write_results(result, name, "replace")
    assert spark.table(name).count() == result.count()
    tc.write_results(result, name)
    assert spark.table(name).count() == 2 * result.count()
    assert tc.load_table(spark, name).count() == 2 * result.count()


def test_required_audit_columns_may_not_be_null(spark, run, targets):
    row = ("r", "p", run.run_ts, None, "HASH_MISMATCH", None, None, None)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_SCHEMA)
    with pytest.raises(PySparkException):
        tc.write_audit(spark.createDataFrame([row], schema), targets[1])


def test_run_history(spark, derived, run, targets):
    for run_id in ("a", "b"):
        tc.run_pair(derived("orders"), tc.Run(run_id, run.run_ts), *targets)
    rows = tc.run_history(spark, targets[0]).collect()
    assert {r["run_id"] for r in rows} == {"a", "b"}
    assert {r["status"] for r in rows} == {"PASS", "FAIL"}


# Whole validations


def test_validate_pair(derived, run):
    found = tc.validate_pair(derived("customer"), run)
    assert [f.dataType for f in found.results.schema] == [f.dataType for f in RESULT_SCHEMA]
    rows = results(found.results)
    count = rows["count", None, "ROW_COUNT"]
    assert (count["source_value"], count["target_value"], count["status"]) == ("150", "151", "FAIL")
    assert count["difference"] == -1 and count["labels"] == {"team": "dwh"}
    assert rows["duplicates", None, "DUPLICATE_ROWS"]["target_value"] == "1"
    assert rows["row", None, "HASH_MISMATCH"]["difference"] == 4
    assert rows["schema", None, None]["status"] == "PASS"
    assert rows["column", "c_mktsegment", "NULL_COUNT"]["status"] == "FAIL"
    assert found.mismatches.count() == 8
    assert {r["metric"] for r in found.drift.collect()} == {"SUM", "AVG", "NULL_COUNT"}
    assert found.schema.count() == 0


def test_identical_pair_passes(derived, run):
    spec = derived("orders")
    same = tc.PairSpec("same", spec.source, spec.source.filter("true"), spec.keys)
    assert {r["status"] for r in tc.validate_pair(same, run).results.collect()} == {"PASS"}


def test_run_pair_gives_the_same_results(spark, derived, run, targets):
    for name in ("customer", "lineitem", "supplier", "events"):
        spec = derived(name, match="name" if name == "supplier" else "strict")
        results_target, audit_target = (f"{t}-{name}" for t in targets)
        tc.run_pair(spec, run, results_target, audit_target)
        lazy = tc.validate_pair(spec, run)
        drop = ("difference", "run_ts", "labels")
        stored = spark.read.parquet(results_target).select(lazy.results.columns)
        one = {tuple(r) for r in lazy.results.drop(*drop, "source_value", "target_value").collect()}
        two = {tuple(r) for r in stored.drop(*drop, "source_value", "target_value").collect()}
        assert one == two
        keys = ("primary_key_value", "mismatch_type", "source_row_hash", "target_row_hash")
        if lazy.mismatches.isEmpty():
            continue
        audit = tc.read_mismatches(spark, audit_target, "run-1")
        assert {tuple(r) for r in audit.select(*keys).collect()} == {
            tuple(r) for r in lazy.mismatches.select(*keys).collect()
        }


def test_run_with_odd_names(spark, run, targets):
    schema = "`my key` int, `a,b;c` string, `x=y (z)` string, `p.q` double"
    source = spark.createDataFrame([(1, "k", "v", 1.0), (2, "k", "v", 1.0)], schema)
    target = spark.createDataFrame([(1, "k", "w", 1.0), (3, "k", "v", None)], schema)
    spec = tc.PairSpec("odd/name = 1", source, target, ["my key", "a,b;c"])
    tc.run_pair(spec, run, *targets)
    rows = spark.read.parquet(targets[0])
    assert rows.filter("status = 'ERROR'").count() == 0
    assert {r["pair"] for r in rows.collect()} == {"odd/name = 1"}
    found = tc.read_mismatches(spark, targets[1], run.run_id)
    assert [r["mismatch_type"] for r in found.collect()] == [
        "HASH_MISMATCH", "MISSING_IN_TARGET", "MISSING_IN_SOURCE"
    ]


def test_broken_check_is_an_error_row(spark, derived, run, targets):
    spec = derived("customer", filter="no_such_column > 1")
    rows = tc.validate_pair(spec, run).results.collect()
    assert {(r["check"], r["status"]) for r in rows} == {("setup", "ERROR"), ("schema", "PASS")}
    tc.run_pair(spec, run, *targets)
    stored = {(r["check"], r["status"]) for r in spark.read.parquet(targets[0]).collect()}
    assert stored == {
        ("count", "ERROR"), ("row", "ERROR"), ("column", "ERROR"), ("schema", "PASS")
    }


def test_check_that_breaks_while_running(spark, run, targets):
    """A value that cannot be cast stops its check; the others are written."""
    base = spark.createDataFrame([(1, "x")], "k int, t string")
    source = base.selectExpr("k", "cast(t as int) as v")
    spec = tc.PairSpec("bad", source, source, ["k"])
    tc.run_pair(spec, run, *targets)
    rows = spark.read.parquet(targets[0]).collect()
    stored = {(r["check"], r["status"]) for r in rows}
    assert ("row", "ERROR") in stored and ("count", "PASS") in stored
    assert all(r["message"] for r in rows if r["status"] == "ERROR")


def test_no_shared_columns_are_skipped(spark, run):
    source = spark.createDataFrame([(1, 2)], "k int, a int")
    target = spark.createDataFrame([(1, 2)], "k int, b int")
    rows = results(tc.validate_pair(tc.PairSpec("x", source, target, ["k"]), run).results)
    assert rows["column", None, None]["status"] == "SKIPPED"
    assert rows["row", None, "HASH_MISMATCH"]["status"] == "PASS"
    assert rows["schema", "a", "MISSING IN TARGET"]["status"] == "FAIL"


def test_without_keys_rows_are_counted_only(spark, derived, run):
    spec = derived("orders")
    found = tc.validate_pair(tc.PairSpec("x", spec.source, spec.target), run)
    assert found.mismatches is None
    assert ("count", None, "ROW_COUNT") in results(found.results)
    with pytest.raises(ValueError):
        tc.validate_row(tc.PairSpec("x", spec.source, spec.target), run)


def test_extra_checks_and_labels(derived, run):
    def weekend_orders(spec):
        found = tc.count_check(spec.source, spec.target)
        return found.selectExpr("'weekend' as check", "'PASS' as status", "source_count as source_value")

    def broken(spec):
        return spec.source.select("nothing")

    spec = derived("orders", extra_checks=[weekend_orders])
    rows = tc.validate_pair(spec, run, extra_checks=[broken]).results.collect()
    own = {r["check"]: r for r in rows}
    assert own["weekend"]["source_value"] == "1500" and own["weekend"]["labels"] == {"team": "dwh"}
    assert own["broken"]["status"] == "ERROR"


def test_row_check_on_a_sample(derived, run):
    spec = derived("customer")
    rows = results(tc.validate_row(spec, run, sample=10).results)
    assert rows["count", None, "ROW_COUNT"]["source_value"] == "10"


def test_column_check_on_a_sample(derived, run):
    rows = results(tc.validate_column(derived("customer"), run, sample=10).results)
    assert rows["count", None, "ROW_COUNT"]["source_value"] == "10"
    assert ("column", "c_custkey", "SUM") in rows


def test_grouped_check(derived, run):
    found = tc.validate_grouped(derived("customer"), run, ["c_nationkey"])
    rows = found.results.collect()
    assert {r["check"] for r in rows} == {"group"} and all(r["group_key"] for r in rows)
    verdict = {r["group_key"]: r["status"] for r in rows if r["metric"] == "GROUP"}
    assert set(verdict.values()) == {"PASS", "FAIL"}
    failing = {r["group_key"] for r in rows if r["metric"] != "GROUP" and r["status"] == "FAIL"}
    assert failing == {g for g, status in verdict.items() if status == "FAIL"}
    assert all("c_nationkey" in json.loads(r["details"]) for r in found.mismatches.collect())
    with pytest.raises(ValueError):
        tc.validate_grouped(tc.PairSpec("x", found.results, found.results), run, [])


def test_run_leaves_no_scratch_tables(spark, derived, run, targets):
    import glob

    root = scratch_root(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/flagged-*") + glob.glob(f"{root}/results-*"))
    tc.run_pair(derived("orders"), run, *targets)
    assert set(glob.glob(f"{root}/flagged-*") + glob.glob(f"{root}/results-*")) == before


def test_column_check_takes_keys_as_columns(derived, run):
    rows = results(tc.validate_column(derived("orders"), run).results)
    assert ("column", "o_orderkey", "SUM") in rows
    assert rows["column", "o_orderkey", "SUM"]["difference"] == 2


def test_custom_queries(spark, derived, run):
    orders = derived("orders").source
    sql = "select o_custkey, count(*) as n from {orders} where o_orderkey % 31 <> 0 group by 1"
    whole = sql.replace("where o_orderkey % 31 <> 0", "")
    row = tc.validate_custom(spark, "q", whole, sql, "row", run, ["o_custkey"], orders=orders)
    assert row.mismatches.count() > 0
    column = tc.validate_custom(spark, "q", whole, whole, "column", run, orders=orders)
    assert {r["status"] for r in column.results.collect()} == {"PASS"}
    with pytest.raises(ValueError):
        tc.validate_custom(spark, "q", sql, sql, "cell", run, orders=orders)


def test_batch(derived, run):
    rows = tc.validate_batch([derived("customer"), derived("orders")], run).collect()
    assert {r["pair"] for r in rows} == {"customer", "orders"}
    assert {r["run_id"] for r in rows} == {"run-1"}


def test_parallel_batch_goes_on_past_a_broken_pair(spark, derived, run, targets):
    jobs = [
        (derived("customer"), ("count", "row", "schema", "column")),
        (derived("orders", filter="broken ("), ("row",)),
        (derived("supplier"), ("schema",)),
        (derived("orders"), ("count", "row")),
    ]
    jobs[3] = (tc.PairSpec("orders2", jobs[3][0].source, jobs[3][0].target, ["o_orderkey"]), jobs[3][1])
    tc.run_batch(jobs, run, *targets, workers=3)
    stored = spark.read.parquet(targets[0])
    status = {(r["pair"], r["check"], r["status"]) for r in stored.collect()}
    assert ("orders", "row", "ERROR") in status
    assert ("orders2", "count", "FAIL") in status
    assert ("supplier", "schema", "FAIL") in status
    audit = spark.read.parquet(targets[1])
    assert {r[0]: r[1] for r in audit.groupBy("pair").count().collect()} == {"customer": 8, "orders2": 1}


def test_stamp_completes_rows(spark, derived, run):
    row = stamp(spark.sql("select 'x' as check"), derived("orders"), run).first()
    assert row["check"] == "x" and row["status"] is None and row["pair"] == "orders"


# Inventories and plans


def write_text(spark, text):
    path = scratch_path(spark, "inventory")
    import os

    os.makedirs(path.replace("file:", ""))
    with open(f"{path.replace('file:', '')}/inventory.csv", "w", encoding="utf-8") as out:
        out.write(text)
    return path


def test_example_inventory(spark):
    rows = tc.load_inventory(spark, write_text(spark, INVENTORY))
    found = sorted(rows.collect())
    assert [r["line"] for r in found] == list(range(2, 12))
    assert [r["validation_type"] for r in found].count("row") == 6
    assert sum(1 for r in found if r["filter_condition"]) == 8
    assert found[-1]["primary_key"] == "l_orderkey,l_linenumber"
    findings = tc.lint_inventory(rows)
    assert findings.count() == 0
    tc.require_clean(findings)
    plan = {r["source"]: r for r in tc.compile_plan(rows).collect()}
    assert plan["SALES.LINEITEM"]["primary_keys"] == ["l_orderkey", "l_linenumber"]
    assert plan["SALES.REGION"]["primary_keys"] is None
    assert plan["SALES.REGION"]["concat"] is None
    assert plan["SALES.REGION"]["filters"] is None
    assert not {"password", "host", "user"} & set(tc.compile_plan(rows).columns)


def test_byte_order_mark_blanks_and_case(spark):
    text = "﻿ source_table , target_table,validation_type,primary_key ,filter_condition\n a , b ,ROW, id ,\n"
    rows = tc.load_inventory(spark, write_text(spark, text)).collect()
    assert [tuple(r) for r in rows] == [(2, "a", "b", "row", "id", "")]


def test_missing_header_is_the_only_finding(spark):
    text = INVENTORY.splitlines()[-1] + "\n"
    rows = tc.lint_inventory(tc.load_inventory(spark, write_text(spark, text))).collect()
    assert {r["rule"] for r in rows} == {"R1"}
    assert len(rows) == 5
    with pytest.raises(InventoryError):
        tc.require_clean(tc.lint_inventory(tc.load_inventory(spark, write_text(spark, text))))


def test_lines_are_numbered_across_blocks(spark):
    lines = [f"S{i},t{i},column,," for i in range(5000)]
    path = write_text(spark, "\n".join([HEADER, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = tc.load_inventory(spark, path)
        blocks = spark.read.text(path).select(F.spark_partition_id()).distinct().count()
        assert blocks > 2
        found = {r["line"]: r["source_table"] for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {i + 2: f"S{i}" for i in range(5000)}


def inventory(spark, *rows):
    columns = HEADER.split(",")
    schema = "line int, " + ", ".join(f"{c} string" for c in columns)
    return clean_inventory(
        spark.createDataFrame([(i + 2, *r) for i, r in enumerate(rows)], schema)
    )


def test_every_rule(spark):
    rows = inventory(
        spark,
        ("", "t", "table", "", ";"),
        ("s", " ", "row", "", ""),
        ("s", "t", "cell", "", ""),
        ("s", "t", "row", " ", ""),
        ("s", "t", "column", "id", ""),
        ("s", "t", "schema", "", "a = 1 /* x */"),
        ("s", "t", "row", "id", "a = 1 -- b; c"),
        ("s", "t", "Row ", "id", None),
    )
    findings = tc.lint_inventory(rows)
    found = sorted((r["line"], r["rule"], r["severity"]) for r in findings.collect())
    assert found == [
        (2, "R2", "ERROR"),
        (3, "R2", "ERROR"),
        (4, "R3", "ERROR"),
        (5, "R4", "ERROR"),
        (6, "R5", "WARNING"),
        (7, "R6", "ERROR"),
        (8, "R6", "ERROR"),
    ]
    assert tuple(tc.lint_summary(findings).first()) == (6, 1)
    with pytest.raises(InventoryError):
        tc.require_clean(findings)
    tc.require_clean(findings.filter("severity = 'WARNING'"))


def test_rules_for_any_table(spark, derived):
    rules = [Rule("N1", "WARNING", F.col("c_acctbal") < 0, "negative balance")]
    table = derived("customer").source
    found = tc.lint(table, rules, F.col("c_custkey"), F.col("c_name"))
    assert found.count() == table.filter("c_acctbal < 0").count()


def test_plan_keys_differ_by_type_and_filter(spark):
    rows = inventory(
        spark,
        ("s", "t", "row", "id", ""),
        ("s", "t", "column", "", ""),
        ("s", "t", "row", "id", "a = 1"),
        ("", "t", "row", "id", ""),
    )
    plan = tc.compile_plan(rows)
    assert plan.count() == 3 and plan.select("plan_key").distinct().count() == 3


def test_run_plan(spark, derived, run, targets):
    rows = inventory(
        spark,
        ("src.customer", "tgt.customer", "row", "c_custkey", "c_acctbal >= 0"),
        ("src.orders", "tgt.orders", "column", "", ""),
        ("src.supplier", "tgt.supplier", "schema", "", ""),
    )

    def resolver(name):
        side, table = name.split(".")
        spec = derived(table)
        return spec.source if side == "src" else spec.target

    tc.run_plan(tc.compile_plan(rows), resolver, run, *targets)
    stored = spark.read.parquet(targets[0]).collect()
    by_table = {}
    for r in stored:
        by_table.setdefault(r["pair"].split("=")[0], set()).add(r["check"])
    assert by_table == {
        "src.customer": {"count", "duplicates", "row"},
        "src.orders": {"count", "column"},
        "src.supplier": {"schema"},
    }
    bad = inventory(spark, ("src.orders", "tgt.orders", "cell", "", ""))
    tc.run_plan(tc.compile_plan(bad), resolver, run, *targets)
    assert spark.read.parquet(targets[0]).filter("status = 'ERROR'").count() == 1


# Sources and session


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "db.table")
    assert plain["dbtable"] == "db.table" and "numPartitions" not in plain
    assert jdbc_options("jdbc:x", "select 1 as a")["query"] == "select 1 as a"
    split = jdbc_options("jdbc:x", "select * from t", "id", 1, 1000, 8)
    assert split["dbtable"] == "(select * from t) tc_query"
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "8")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark).startswith(shared)


def test_light_details(derived):
    pair = tc.align(derived("orders"))
    row = tc.with_light_details(pair, tc.row_diff(pair)).first()
    assert json.loads(row["details"]) == {"pk": {"o_orderkey": 2}, "status": "MISSING_IN_TARGET"}


def test_a_clean_repeat_leaves_no_mismatch(spark, pair_of, run, tmp_path):
    results, audit = f"file://{tmp_path}/results", f"file://{tmp_path}/audit"
    schema = "k int, v string"
    for source, expected in (([(1, "b")], 1), ([(1, "a")], 0)):
        left, right = spark.createDataFrame(source, schema), spark.createDataFrame([(1, "a")], schema)
        tc.run_pair(tc.PairSpec("p = q", left, right, ["k"]), run, results, audit, mode="replace")
        assert tc.read_mismatches(spark, audit, run.run_id).count() == expected


def test_a_clean_first_run_can_be_read(spark, run, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tc.run_pair(tc.PairSpec("p", df, df, ["k"]), run, f"{tmp_path}/results", f"{tmp_path}/audit")
    assert tc.read_mismatches(spark, f"{tmp_path}/audit", run.run_id).count() == 0


def test_plan_rows_with_other_keys_are_kept_apart(spark):
    rows = [("a", "b", "row", "k", ""), ("a", "b", "row", "l", ""), ("a|b", "c", "row", "k", ""), ("a", "b|c", "row", "k", "")]
    inventory = spark.createDataFrame(rows, "source_table string, target_table string, validation_type string, primary_key string, filter_condition string")
    assert tc.compile_plan(inventory).select("plan_key").distinct().count() == 4


def test_a_missing_table_and_an_unknown_type_leave_the_other_rows(spark, run, tmp_path):
    tables = {"t": spark.createDataFrame([(1, "a")], "k int, v string")}
    rows = [("k1", "t", "t", "row", ["k"], None), ("k2", "gone", "t", "row", ["k"], None), ("k3", "t", "t", "odd", None, None)]
    plan = spark.createDataFrame(rows, "plan_key string, source string, target string, type string, primary_keys array<string>, filters string")
    tc.run_plan(plan, tables.__getitem__, run, f"{tmp_path}/results")
    found = spark.read.parquet(f"{tmp_path}/results")
    status = {p: {r["status"] for r in found.filter(found["pair"] == p).collect()} for p in {r["pair"] for r in found.collect()}}
    assert status == {"t=t#k1": {"PASS"}, "gone=t#k2": {"ERROR"}, "t=t#k3": {"ERROR"}}


def test_columns_of_other_nullability_are_compared(spark, run):
    left = spark.sql("select 1 as k, array(1, 2) as v")
    right = spark.sql("select 1 as k, array(3, cast(null as int)) as v")
    assert tc.row_diff(tc.align(tc.PairSpec("p", left, right, ["k"]))).count() == 1


def test_a_batch_goes_on_past_what_fails_while_it_runs(spark, derived, run):
    good = derived("customer")
    cast = good.target.withColumn("c_nationkey", F.expr("cast(c_name as int)"))
    wide = spark.createDataFrame([(1, Decimal(10**38 - 1)), (2, Decimal(10**38 - 1))], "k int, d decimal(38,0)")
    pairs = [replace(good, name="cast", target=cast), good, tc.PairSpec("wide", wide, wide, ["k"]), replace(good, name="keyless", keys=["nokey"])]
    rows = tc.validate_batch(pairs, run).collect()
    status = {(r["pair"], r["check"]) for r in rows if r["status"] == "ERROR"}
    assert status == {("cast", "row"), ("cast", "column"), ("keyless", "count"), ("keyless", "row"), ("keyless", "column")}
    alone = tc.validate_batch([good], run).collect()
    assert Counter(r["status"] for r in rows if r["pair"] == "customer") == Counter(r["status"] for r in alone)
    assert {r["status"] for r in rows if r["pair"] == "wide"} == {"PASS"}


def test_repeated_keys_are_compared_row_by_row_on_demand(spark, run, targets):
    source, target = (spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "A"), (1, "B")], [(1, "A"), (1, "C")]))
    spec = tc.PairSpec("x", source, target, ["k"])
    every = replace(spec, repeats="all")
    assert {r["metric"]: r["difference"] for r in tc.validate_row(every, run).results.collect()}["HASH_MISMATCH"] == 2
    tc.run_pair(every, run, *targets)
    rows = spark.read.parquet(targets[1]).collect()
    assert sorted((r["source_row_hash"] is None, r["details"]) for r in rows) == [
        (False, '{"source_record":{"v":"B"},"target_record":null}'),
        (True, '{"source_record":null,"target_record":{"v":"C"}}'),
    ]


def test_unsafe_plan_rows_are_not_run(spark, run, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    filters = ["v > 1 -- and the rest", "v /* x */ > 1", "v > 1; drop table t", "v > 1"]
    plan = spark.createDataFrame([(f"p{i}", "a", "b", "row", ["k"], "*", f) for i, f in enumerate(filters)],
                                 "plan_key string, source string, target string, type string, primary_keys array<string>, concat string, filters string")
    tc.run_plan(plan, lambda name: df, run, str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["pair"][-2:]: r["message"] for r in rows if r["status"] == "ERROR"} == {
        f"p{i}": "R6: the filter holds an unsafe sequence" for i in range(3)
    }
    assert {r["status"] for r in rows if r["pair"].endswith("p3")} == {"PASS"}


def test_a_custom_check_takes_the_hash_mode(spark, run):
    one = "select 1 as k, 'a' as v, cast(null as string) as w"
    two = "select 1 as k, 'b' as v, cast(null as string) as w"
    found = tc.validate_custom(spark, "q", one, two, "row", run, ["k"], options={"hash_mode": "compat"}).mismatches.first()
    assert found["source_row_hash"] == spark.sql("select sha2('a||NULL', 256)").first()[0]


def test_planned_runs_choose_among_repeated_keys_by_the_golden_hash(spark, tmp_path):
    """The smallest hash stands for a repeated key, so the count of differing keys hangs on the hash."""
    import duckdb

    from conftest import SF_DIR
    from tablecheck.testbed.oracle import ORACLES
    from tablecheck.testbed.queries import QUERIES

    for table in ("lineitem", "supplier"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SF_DIR}/{table}.parquet")
    # Keys that the pair both changes and repeats.
    named = "concat('Customer#', 4150 * id) as c_name, cast(id as int) as c_nationkey, 100.5D + id as c_acctbal, 'AUTO' as c_mktsegment"
    rows = spark.sql(f"select 4150 * id as c_custkey, {named} from range(1, 41)")
    rows.toPandas().to_parquet(tmp_path / "customer.parquet")
    duck = duckdb.connect()
    for table in ("customer", "lineitem", "supplier"):
        duck.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    wanted = duck.execute(f"select metric, source_value from ({ORACLES['run_plan']}) where \"check\" = 'row' and pair like '%CUSTOMER%'")
    found = QUERIES["run_plan"](spark, str(tmp_path)).where("check = 'row' and pair like '%CUSTOMER%'")
    assert {(r["metric"], r["source_value"]) for r in found.collect()} == set(wanted.fetchall())
