"""Reconciliation of tables on Spark: find out where a target differs from its source."""

from .functions import key_json, normalise_keys, row_hash
from .operators.buckets import bucket_fingerprints, differing_buckets, narrowed_row_diff
from .operators.columns import Aligned, align, common_columns, schema_diff
from .operators.fingerprint_tree import differing_leaves, stored_tree, tree_row_diff
from .operators.filters import apply_filter, filter_groups, filter_keys
from .operators.grouped import GroupedResult, grouped_drilldown
from .operators.metrics import (
    column_comparison,
    column_diff,
    column_metrics,
    count_check,
    grouped_column_diff,
    metrics_match,
)
from .operators.rowdiff import (
    cell_diff,
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
from .operators.sampling import sample_keys, sampled
from .plans.inventory import compile_plan, lint, lint_inventory, lint_summary, require_clean
from .plans.run import run_batch, run_plan, validate_batch
from .plans.validate import (
    run_pair,
    union_results,
    validate_column,
    validate_custom,
    validate_grouped,
    validate_pair,
    validate_row,
    validate_schema,
)
from .session import configure, materialise
from .sinks import first_mismatches, read_mismatches, read_results, run_history, write_audit, write_results
from .sources import load_inventory, load_jdbc, load_query, load_table, load_with_footers, schema_catalog
from .spec import PairSpec, Run, ValidationResult

__all__ = [name for name in dir() if not name.startswith("_")]
