"""The registered queries: every operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import key_json, normalise_keys, row_hash
from ..operators.buckets import bucket_fingerprints, narrowed_row_diff
from ..operators.columns import Aligned, align
from ..operators.filters import filter_keys
from ..operators.fingerprint_tree import stored_tree, tree_row_diff
from ..operators.grouped import grouped_drilldown
from ..operators.metrics import (
    column_comparison,
    column_metrics,
    count_check,
    grouped_column_diff,
)
from ..operators.rowdiff import (
    cell_diff,
    compared,
    dedupe,
    duplicate_count,
    duplicate_groups,
    hash_groups,
    hash_mismatch,
    mismatch_summary,
    missing_in_source,
    missing_in_target,
    row_diff,
    row_diff_all,
    row_surplus,
    with_details,
    with_light_details,
)
from ..operators.sampling import sample_keys, sampled
from ..plans.inventory import compile_plan, lint_inventory
from ..plans.run import run_plan, validate_batch
from ..plans.validate import (
    audit_rows,
    run_pair,
    stamp,
    union_results,
    validate_column,
    validate_custom,
    validate_grouped,
    validate_pair,
    validate_row,
    validate_schema,
)
from ..session import configure, materialise, scratch_path
from ..sinks import first_mismatches, read_mismatches, run_history, write_audit, write_results
from ..sources import INVENTORY_COLUMNS, load_inventory, load_query, load_table, load_with_footers
from ..sources.inventory import clean_inventory
from ..spec import PairSpec, Run
from .pairs import (
    BROKEN,
    CUSTOM_COLUMN,
    CUSTOM_ROW,
    CUSTOMER,
    DISJOINT,
    DRILL_GROUPS,
    EVENTS,
    EVENTS_FILTER,
    FILTERED,
    INVENTORY,
    LINEITEM,
    N_BUCKETS,
    MIXED_NUMBERS,
    ORDERS,
    OTHER_NAMES,
    PADDED,
    PAIRS,
    RELAXED,
    SAMPLE_SEED,
    SAMPLE_SIZE,
    SUPPLIER,
    DerivedPair,
)

RUN = Run("run-1", datetime(2026, 1, 1, tzinfo=timezone.utc), {"suite": "testbed"})
# The row hash of the golden record, in which the SQL counterparts are written.
GOLDEN = {"hash_mode": "compat"}


def spec_of(spark: SparkSession, sf_dir: str, pair: DerivedPair, **options) -> PairSpec:
    """The pair with the row hash of the golden record, which SQL writes down as it is."""
    configure(spark)
    source, target = pair.load(spark, sf_dir)
    return PairSpec(pair.table, source, target, pair.keys, **{**GOLDEN, **options})


def aligned(spark: SparkSession, sf_dir: str, pair: DerivedPair, **options) -> Aligned:
    return align(spec_of(spark, sf_dir, pair, **options))


def shown_value(metric: str, value: str) -> str:
    """A metric value as text, whole; sums and means of floating point numbers, which depend on the
    engine's order of adding up, to nine digits, shifted a little so that none lies between two."""
    rounded = f"format_string('%.8e', try_cast({value} as double) * 1.0000000002929D)"
    return f"if({metric} in ('SUM', 'AVG') and not rlike({value}, '^-?[0-9]+$'), {rounded}, {value})"


def shown(results: DataFrame, *lead: str) -> DataFrame:
    """Metric rows with the values of both sides."""
    sides = [f"{shown_value('metric', f'{side}_value')} as {side}_value" for side in ("source", "target")]
    return results.selectExpr(*lead, "column_name", "metric", *sides, "status")


def results_of(results: DataFrame) -> DataFrame:
    """Result rows; a row class has no sides, so its count is shown as the source's value."""
    value = "if(check = 'row', cast(cast(difference as bigint) as string), source_value)"
    return shown(
        results.withColumn("source_value", F.expr(value)), "pair", "check"
    )


# Sources and sinks -------------------------------------------------------------------------


def scan_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in sorted(PAIRS):
        table = load_table(spark, f"{sf_dir}/{name}.parquet")
        rows = table.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        out = rows if out is None else out.unionAll(rows)
    return out


FOOTER_KEYS = {"customer": "c_custkey", "events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey", "supplier": "s_suppkey"}


def footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count, smallest and largest key of whole tables, as their footers tell them."""
    configure(spark)
    out = None
    for name, key in FOOTER_KEYS.items():
        table = load_with_footers(spark, f"{sf_dir}/{name}.parquet")
        told = table.agg(F.count("*").alias("n_rows"), F.min(key).alias("low"), F.max(key).alias("high"))
        row = told.select(F.lit(name).alias("table_name"), "n_rows", *[F.col(c).cast("bigint").alias(c) for c in ("low", "high")])
        out = row if out is None else out.unionAll(row)
    return out


def _custom(spark: SparkSession, sf_dir: str, pair: DerivedPair, kind: str):
    configure(spark)
    table = load_table(spark, f"{sf_dir}/{pair.table}.parquet")
    views = {pair.table: table}
    return validate_custom(
        spark, "custom", pair.source, pair.target, kind, RUN, pair.keys, options=GOLDEN, **views
    )


def custom_query_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _custom(spark, sf_dir, CUSTOM_ROW, "row").mismatches
    return rows.select("primary_key_value", "mismatch_type", "source_row_hash", "target_row_hash")


def custom_query_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_of(_custom(spark, sf_dir, CUSTOM_COLUMN, "column").results)


def _audited(spark: SparkSession, sf_dir: str) -> str:
    spec = spec_of(spark, sf_dir, CUSTOMER)
    pair = align(spec)
    diff = materialise(row_diff(pair), "diff")
    target = scratch_path(spark, "audit")
    write_audit(audit_rows(with_details(pair, diff), spec, RUN), target)
    other = replace(RUN, run_id="run-2")
    write_audit(audit_rows(with_light_details(pair, diff), spec, other), target)
    return target


_AUDIT = ("run_id", "pair", "primary_key_value", "mismatch_type", "source_row_hash",
          "target_row_hash", "details")


def audit_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_mismatches(spark, _audited(spark, sf_dir), RUN.run_id)
    return rows.select(*_AUDIT)


def top_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = first_mismatches(spark, _audited(spark, sf_dir), RUN.run_id, 10)
    return rows.select("primary_key_value", "mismatch_type")


def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, CUSTOMER)
    target = scratch_path(spark, "results")
    write_results(validate_pair(spec, RUN).results, target)
    return results_of(load_table(spark, target))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, CUSTOMER)
    target, audit = scratch_path(spark, "results"), scratch_path(spark, "audit")
    for run_id in ("run-1", "run-2"):
        run_pair(spec, replace(RUN, run_id=run_id), target, audit)
    return run_history(spark, target).select("run_id", "pair", "status", "n_rows")


# Filters and projections -------------------------------------------------------------------


def _diff_columns(pair: DerivedPair, diff: DataFrame) -> DataFrame:
    return diff.select(*pair.keys, "mismatch_type", "source_row_hash", "target_row_hash")


def pair_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff_columns(EVENTS, row_diff(aligned(spark, sf_dir, EVENTS, filter=EVENTS_FILTER)))


def key_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, LINEITEM)
    return sample_keys(pair.source, pair.keys, SAMPLE_SIZE, SAMPLE_SEED)


def random_row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = sampled(aligned(spark, sf_dir, CUSTOMER), SAMPLE_SIZE, SAMPLE_SEED)
    return _diff_columns(CUSTOMER, row_diff(pair))


def key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of the orders that differ; key names differ between list and table."""
    orders = aligned(spark, sf_dir, CUSTOM_ROW)
    changed = hash_mismatch(orders).select("o_custkey")
    table = load_table(spark, f"{sf_dir}/orders.parquet").withColumnRenamed("o_custkey", "cust")
    kept = filter_keys(table, changed, {"o_custkey": "cust"})
    return kept.groupBy("cust").agg(F.count("*").alias("n_orders"))


def _null_counts(pair: Aligned) -> DataFrame:
    rows = column_comparison(pair).filter(F.col("metric") == "NULL_COUNT")
    return rows.select(
        "column_name",
        F.col("source_value").cast("bigint").alias("source_nulls"),
        F.col("target_value").cast("bigint").alias("target_nulls"),
    )


def shared_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = replace(spec_of(spark, sf_dir, SUPPLIER), keys=())
    return _null_counts(align(spec))


def shared_columns_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_counts(aligned(spark, sf_dir, RELAXED, match="name"))


def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, CUSTOMER)
    return pair.target.select("c_custkey", row_hash(pair.schema, pair.columns).alias("row_hash"))


def row_hashes_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, EVENTS)
    digest = row_hash(pair.schema, pair.columns, mode="strict")
    return pair.target.select("event_id", digest.alias("row_hash"))


def row_hashes_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    diff = row_diff(aligned(spark, sf_dir, CUSTOMER, hash_algo="xxhash64"))
    return diff.select("c_custkey", "mismatch_type")


def key_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, LINEITEM)
    return row_diff(pair).select(
        key_json(pair.keys).alias("primary_key_value"), "mismatch_type"
    )


def row_diff_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, CUSTOMER)
    return with_details(pair, materialise(row_diff(pair), "diff"))


def row_diff_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, CUSTOMER)
    return with_light_details(pair, row_diff(pair))


def normalised_key_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, PADDED)
    tidy = replace(
        spec,
        source=normalise_keys(spec.source, spec.keys),
        target=normalise_keys(spec.target, spec.keys),
    )
    return _diff_columns(PADDED, row_diff(align(tidy)))


# Row comparison ----------------------------------------------------------------------------


def _row_diff(pair: DerivedPair) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _diff_columns(pair, row_diff(aligned(spark, sf_dir, pair)))

    return query


def row_diff_nodedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = row_diff_all(aligned(spark, sf_dir, LINEITEM))
    return rows.withColumn("n_pairs", F.col("n_pairs").cast("string"))


def rows_left_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = row_surplus(aligned(spark, sf_dir, LINEITEM))
    return rows.select(*LINEITEM.keys, "mismatch_type", "source_row_hash", "target_row_hash", "n_rows")


def relaxed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles against decimals and integers; the columns that differ, with both texts."""
    pair = aligned(spark, sf_dir, MIXED_NUMBERS, match="name", hash_mode="strict")
    return cell_diff(pair, materialise(row_diff(pair), "diff"))


def row_hash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_groups(aligned(spark, sf_dir, LINEITEM))


def absent_in_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_in_source(aligned(spark, sf_dir, LINEITEM))


def absent_in_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_in_target(aligned(spark, sf_dir, LINEITEM))


def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff_columns(LINEITEM, hash_mismatch(aligned(spark, sf_dir, LINEITEM)))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, CUSTOMER)
    return cell_diff(pair, materialise(row_diff(pair), "diff"))


def dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, LINEITEM)
    rows = dedupe(pair.source, pair.keys)
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in ("customer", "orders", "events", "lineitem"):
        found = mismatch_summary(compared(aligned(spark, sf_dir, PAIRS[name]))[1])
        rows = found.select(F.lit(name).alias("pair"), "mismatch_type", "n_keys")
        out = rows if out is None else union_results(out, rows)
    return out


# Aggregates and metrics --------------------------------------------------------------------


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, LINEITEM)
    return count_check(spec.source, spec.target)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in ("customer", "events", "lineitem"):
        spec = spec_of(spark, sf_dir, PAIRS[name])
        for side, df in (("source", spec.source), ("target", spec.target)):
            row = duplicate_count(df, spec.keys).select(
                F.lit(name).alias("pair"), F.lit(side).alias("side"), "n_duplicates"
            )
            out = row if out is None else out.unionAll(row)
    return out


def duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, LINEITEM)
    return duplicate_groups(spec.target, spec.keys)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = aligned(spark, sf_dir, LINEITEM)
    rows = column_metrics(pair.target, pair.columns, rows=True)
    return rows.selectExpr(
        "column_name",
        "metric",
        f"{shown_value('metric', 'text')} as value",
    )


def column_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = column_comparison(aligned(spark, sf_dir, CUSTOMER))
    return shown(rows.filter(F.col("status") == "FAIL"))


def column_drift_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_of(validate_column(spec_of(spark, sf_dir, DISJOINT), RUN).results)


def grouped_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grouped_column_diff(aligned(spark, sf_dir, CUSTOMER), ["c_nationkey"])
    return shown(rows.withColumn("status", F.lit("FAIL")), "group_key")


def drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grouped_drilldown(aligned(spark, sf_dir, CUSTOMER), DRILL_GROUPS)
    groups = found.groups.select(
        F.col("level").cast("bigint").alias("level"),
        "group_key",
        "outcome",
        F.lit(None).cast("string").alias("primary_key_value"),
    )
    rows = found.rows.select(
        F.lit(len(DRILL_GROUPS) + 1).cast("bigint").alias("level"),
        "group_key",
        F.col("mismatch_type").alias("outcome"),
        "primary_key_value",
    )
    return union_results(groups, rows)


def grouped_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metric rows of the final groups, and the verdict of each group."""
    found = validate_grouped(spec_of(spark, sf_dir, CUSTOMER), RUN, DRILL_GROUPS).results
    return shown(found, "group_key")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bucket_fingerprints(aligned(spark, sf_dir, LINEITEM), N_BUCKETS, "sha256")
    return rows.select(
        F.col("bucket").cast("bigint").alias("bucket"),
        "source_rows",
        "source_xor",
        F.col("source_sum").cast("string").alias("source_sum"),
        "target_rows",
        "target_xor",
        F.col("target_sum").cast("string").alias("target_sum"),
    )


def bucket_narrowed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff_columns(LINEITEM, narrowed_row_diff(aligned(spark, sf_dir, LINEITEM)))


def tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of both sides, stored and compared from the top down."""
    pair = aligned(spark, sf_dir, LINEITEM)
    folder = scratch_path(spark, "trees")
    trees = [
        stored_tree(df, pair.keys, pair.columns, folder, version, hash_mode=pair.hash_mode)
        for df, version in ((pair.source, "source-1"), (pair.target, "target-1"))
    ]
    return _diff_columns(LINEITEM, tree_row_diff(*trees))


# Schema ------------------------------------------------------------------------------------


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure of the supplier pair beside the row counts of both tables."""
    spec = spec_of(spark, sf_dir, SUPPLIER)
    counted = count_check(spec.source, spec.target).select(
        F.lit("count").alias("check"),
        F.lit("ROW_COUNT").alias("metric"),
        F.col("source_count").cast("string").alias("source_value"),
        F.col("target_count").cast("string").alias("target_value"),
        F.when(F.col("difference") == 0, "PASS").otherwise("FAIL").alias("status"),
    )
    rows = union_results(validate_schema(spec, RUN).results, stamp(counted, spec, RUN))
    return rows.select("check", "column_name", "metric", "source_value", "target_value", "status")


# Jobs --------------------------------------------------------------------------------------


def whole_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_of(validate_pair(spec_of(spark, sf_dir, CUSTOMER), RUN).results)


def whole_pair_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_of(validate_pair(spec_of(spark, sf_dir, LINEITEM), RUN).results)


def whole_pair_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys compared row by row, in place of one row for each key."""
    return results_of(validate_pair(spec_of(spark, sf_dir, LINEITEM, repeats="all"), RUN).results)


def mapped_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target has its own column names and its own predicate."""
    spec = spec_of(spark, sf_dir, CUSTOMER, filter="c_acctbal >= 0", target_filter="c_acctbal >= 1")
    target = spec.target.toDF(*[OTHER_NAMES[c] for c in spec.target.columns])
    names = {k: v for k, v in OTHER_NAMES.items() if k not in spec.keys}
    keys = [OTHER_NAMES[k] for k in spec.keys]
    return results_of(validate_pair(replace(spec, target=target, target_keys=keys, column_map=names), RUN).results)


def batch_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which pairs fail while they run, and one that has no such key: rows by status."""
    good = spec_of(spark, sf_dir, CUSTOMER)
    bad_cast = replace(good, name="bad cast", target=spark.sql(BROKEN, customer=load_table(spark, f"{sf_dir}/customer.parquet")))
    no_key = replace(good, name="no key", keys=["c_nokey"])
    rows = validate_batch([bad_cast, good, no_key, spec_of(spark, sf_dir, ORDERS)], RUN)
    return rows.groupBy("pair", "check", "status").agg(F.count("*").alias("n"))


def batch_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [spec_of(spark, sf_dir, p) for p in (CUSTOMER, ORDERS, EVENTS, LINEITEM)]
    return results_of(validate_batch(specs, RUN))


def plan_row_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, EVENTS, filter=EVENTS_FILTER)
    return results_of(validate_row(spec, RUN).results)


def plan_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, CUSTOMER, filter="c_acctbal >= 0")
    return results_of(validate_column(spec, RUN).results)


def negative_balances(spec: PairSpec) -> DataFrame:
    """An own check: customers with a negative balance on each side."""
    negative = "c_acctbal < 0"
    found = count_check(spec.source.filter(negative), spec.target.filter(negative))
    return found.select(
        F.lit("negative_balances").alias("check"),
        F.lit("COUNT").alias("metric"),
        F.col("source_count").alias("source_value"),
        F.col("target_count").alias("target_value"),
        F.when(F.col("difference") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def extra_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spec_of(spark, sf_dir, CUSTOMER)
    return results_of(validate_pair(spec, RUN, extra_checks=[negative_balances]).results)


def inventory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory with planted faults, a line per part."""
    configure(spark)
    return load_query(spark, INVENTORY, part=load_table(spark, f"{sf_dir}/part.parquet"))


def inventory_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "inventory")
    rows = inventory_rows(spark, sf_dir).select(*INVENTORY_COLUMNS)
    rows.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    loaded = load_inventory(spark, path).groupBy(*INVENTORY_COLUMNS).agg(F.count("*").alias("n"))
    return loaded


def inventory_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lint_inventory(clean_inventory(inventory_rows(spark, sf_dir))).select(
        "line", "subject", "rule", "severity"
    )


def plan_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = compile_plan(clean_inventory(inventory_rows(spark, sf_dir)))
    return plan.withColumn("primary_keys", F.concat_ws("+", "primary_keys")).select(
        "plan_key", "source", "target", "type", "primary_keys", "concat", "filters"
    )


def planned_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compile the plan of two pairs and run it: rows, columns and schema of whole tables."""
    configure(spark)
    listed = [
        ("SRC.CUSTOMER", "tgt.customer", "row", "c_custkey", "c_acctbal >= 0"),
        ("SRC.CUSTOMER", "tgt.customer", "column", "", ""),
        ("SRC.LINEITEM", "tgt.lineitem", "row", "l_orderkey, l_linenumber", ""),
        ("SRC.SUPPLIER", "tgt.supplier", "schema", "", ""),
    ]
    schema = ", ".join(f"{c} string" for c in INVENTORY_COLUMNS)
    plan = compile_plan(clean_inventory(spark.createDataFrame(listed, schema)))

    def resolver(name: str) -> DataFrame:
        side, table = name.lower().split(".")
        source, target = PAIRS[table].load(spark, sf_dir)
        return source if side == "src" else target

    results, audit = scratch_path(spark, "results"), scratch_path(spark, "audit")
    run_plan(plan, resolver, RUN, results, audit, **GOLDEN)
    rows = results_of(load_table(spark, results))
    return rows.withColumn("pair", F.element_at(F.split("pair", "#"), 1))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_row_count": scan_row_count,
    "count_from_footers": footer_counts,
    "custom_query_row": custom_query_row,
    "custom_query_column": custom_query_column,
    "schema_diff": schema_check,
    "inventory_load": inventory_load,
    "audit_roundtrip": audit_roundtrip,
    "results_roundtrip": results_roundtrip,
    "top_mismatches": top_mismatches,
    "run_history": history,
    "pair_filter": pair_filter,
    "key_filter": key_filter,
    "key_sample": key_sample,
    "random_row_sample": random_row_sample,
    "common_columns": shared_columns,
    "common_columns_relaxed": shared_columns_relaxed,
    "row_hash": row_hashes,
    "row_hash_strict": row_hashes_strict,
    "row_hash_fast": row_hashes_fast,
    "pk_json": key_objects,
    "row_diff_details": row_diff_details,
    "row_diff_light": row_diff_light,
    "normalised_key_diff": normalised_key_diff,
    "row_diff": _row_diff(CUSTOMER),
    "row_diff_composite": _row_diff(LINEITEM),
    "row_diff_null_keys": _row_diff(EVENTS),
    "row_diff_one_missing": _row_diff(ORDERS),
    "row_diff_nodedupe": row_diff_nodedupe,
    "row_hash_groups": row_hash_groups,
    "row_surplus": rows_left_over,
    "relaxed_numbers": relaxed_numbers,
    "missing_in_source": absent_in_source,
    "missing_in_target": absent_in_target,
    "hash_mismatch": changed_rows,
    "cell_diff": cells,
    "dedupe_keys": dedupe_keys,
    "mismatch_summary": summary,
    "count_check": counts,
    "duplicate_keys": duplicate_keys,
    "duplicate_groups": duplicated,
    "column_metrics": metrics,
    "column_drift": column_drift,
    "column_drift_empty": column_drift_empty,
    "grouped_column_diff": grouped_drift,
    "grouped_drilldown": drilldown,
    "bucket_fingerprint": fingerprints,
    "bucket_narrowed_diff": bucket_narrowed_diff,
    "fingerprint_tree_diff": tree_diff,
    "validate_pair": whole_pair,
    "validate_pair_composite": whole_pair_composite,
    "validate_pair_all_rows": whole_pair_all_rows,
    "validate_pair_mapped": mapped_pair,
    "validate_grouped": grouped_check,
    "batch_validate": batch_validate,
    "batch_isolated": batch_isolated,
    "plan_row_check": plan_row_check,
    "plan_column_check": plan_column_check,
    "inventory_lint": inventory_lint,
    "plan_compile": plan_compile,
    "run_plan": planned_run,
    "extra_check": extra_check,
}
