"""Rule checks over any table, the rules of an inventory, and its compilation into a plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import field
from ..sources.inventory import INVENTORY_COLUMNS, missing_columns
from ..spec import FINDING_SCHEMA

# Severities, allowed types and the sequences not allowed in a filter.
LINT_ERROR, LINT_WARNING = "ERROR", "WARNING"
VALIDATION_TYPES = ("row", "column", "schema")
UNSAFE_SEQUENCES = (";", "--", "/*", "*/")


@dataclass(frozen=True)
class Rule:
    """A condition on a row that makes a finding.

    ``stops`` keeps the later rules from being applied to a row that this one has caught.
    """

    name: str
    severity: str
    condition: Column
    message: str
    stops: bool = False


class InventoryError(Exception):
    """The inventory has errors and must not be compiled."""


def inventory_rules() -> list[Rule]:
    kind, key, condition = field("validation_type"), field("primary_key"), field("filter_condition")
    unsafe = F.lit(False)
    for sequence in UNSAFE_SEQUENCES:
        unsafe = unsafe | F.contains(condition, F.lit(sequence))
    nameless = (field("source_table") == "") | (field("target_table") == "")
    return [
        Rule("R2", LINT_ERROR, nameless, "source or target name is blank", stops=True),
        Rule("R3", LINT_ERROR, ~kind.isin(*VALIDATION_TYPES), "unknown validation type"),
        Rule("R4", LINT_ERROR, (kind == "row") & (key == ""), "a row check needs a key"),
        Rule("R5", LINT_WARNING, (kind == "column") & (key != ""), "a column check ignores keys"),
        Rule("R6", LINT_ERROR, unsafe, "the filter holds an unsafe sequence"),
    ]


def lint(df: DataFrame, rules: Sequence[Rule], line: Column, subject: Column) -> DataFrame:
    """One finding per broken rule and row, in one narrow pass."""
    findings, stopped = [], F.lit(False)
    for rule in rules:
        broken = F.coalesce(rule.condition, F.lit(False))
        findings.append(
            F.when(
                broken & ~stopped,
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.severity).alias("severity"),
                    F.lit(rule.message).alias("message"),
                ),
            )
        )
        if rule.stops:
            stopped = stopped | broken
    found = F.filter(F.array(*findings), lambda x: x.isNotNull())
    return df.select(
        line.cast("bigint").alias("line"), subject.alias("subject"), F.explode(found).alias("f")
    ).select("line", "subject", "f.*")


def lint_inventory(inventory: DataFrame, subject: str = "source_table") -> DataFrame:
    """Findings of an inventory; a missing column is the only finding of a file that lacks it."""
    absent = missing_columns(inventory.columns)
    if absent:
        spark = inventory.sparkSession
        rows = [(1, c, "R1", LINT_ERROR, "required column is missing") for c in absent]
        return spark.createDataFrame(rows, FINDING_SCHEMA)
    return lint(inventory, inventory_rules(), field("line"), field(subject))


def lint_summary(findings: DataFrame) -> DataFrame:
    """Number of errors and warnings, in one row."""
    return findings.agg(
        F.count_if(F.col("severity") == LINT_ERROR).alias("n_errors"),
        F.count_if(F.col("severity") == LINT_WARNING).alias("n_warnings"),
    )


def require_clean(findings: DataFrame) -> None:
    """Stop when there is an error; warnings pass."""
    errors = lint_summary(findings).first()["n_errors"]
    if errors:
        raise InventoryError(f"the inventory has {errors} error(s)")


def compile_plan(inventory: DataFrame) -> DataFrame:
    """One plan row per inventory row that names both tables.

    Keys and the all-columns mark are for row checks only.  The plan key is made of both
    tables, the type, the keys and the filter, so checks of one table do not replace one another.  Plan
    rows carry no credentials.
    """
    source, target = field("source_table"), field("target_table")
    kind, condition = field("validation_type"), field("filter_condition")
    is_row = kind == "row"
    keys = F.transform(F.split(field("primary_key"), ","), lambda k: F.trim(k))
    keys = F.filter(keys, lambda k: k != "")
    # Lengths keep apart what separators inside the fields could mix up.
    fields = (source, target, kind, field("primary_key"), condition)
    identity = F.concat(*[part for f in fields for part in (F.length(f), F.lit(":"), f)])
    return inventory.filter((source != "") & (target != "")).select(
        F.sha2(identity, 256).alias("plan_key"),
        source.alias("source"),
        target.alias("target"),
        kind.alias("type"),
        F.when(is_row, keys).alias("primary_keys"),
        F.when(is_row, F.lit("*")).alias("concat"),
        F.when(condition != "", condition).alias("filters"),
    )


__all__ = [
    "INVENTORY_COLUMNS",
    "InventoryError",
    "Rule",
    "compile_plan",
    "inventory_rules",
    "lint",
    "lint_inventory",
    "lint_summary",
    "require_clean",
]
