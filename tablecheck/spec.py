"""What a check is given and what it returns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, types as T

from .functions import literal

# The class and status words of the result tables.
MISSING_IN_SOURCE = "MISSING_IN_SOURCE"
MISSING_IN_TARGET = "MISSING_IN_TARGET"
HASH_MISMATCH = "HASH_MISMATCH"
SCHEMA_MISSING_IN_SOURCE = "MISSING IN SOURCE"
SCHEMA_MISSING_IN_TARGET = "MISSING IN TARGET"
SCHEMA_TYPE_MISMATCH = "DATA TYPE MISMATCH"
PASS, FAIL, ERROR, SKIPPED = "PASS", "FAIL", "ERROR", "SKIPPED"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("pair", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("group_key", T.StringType()),
        T.StructField("source_value", T.StringType()),
        T.StructField("target_value", T.StringType()),
        T.StructField("difference", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("pair", T.StringType(), False),
        T.StructField("validation_time", T.TimestampType(), False),
        T.StructField("primary_key_value", T.StringType(), False),
        T.StructField("mismatch_type", T.StringType(), False),
        T.StructField("source_row_hash", T.StringType()),
        T.StructField("target_row_hash", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

FINDING_SCHEMA = T.StructType(
    [
        T.StructField("line", T.LongType()),
        T.StructField("subject", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Run:
    """Identity shared by every row that one run writes."""

    run_id: str
    run_ts: datetime
    labels: dict[str, str] = field(default_factory=dict)

    def columns(self, pair: str) -> dict[str, str]:
        """The identity columns as SQL."""
        ts = self.run_ts if self.run_ts.tzinfo else self.run_ts.replace(tzinfo=timezone.utc)
        labels = ", ".join(literal(x) for item in sorted(self.labels.items()) for x in item)
        return {
            "run_id": literal(self.run_id),
            "run_ts": f"timestamp'{ts.astimezone(timezone.utc):%Y-%m-%d %H:%M:%S.%f}+00:00'",
            "pair": literal(pair),
            "labels": f"map({labels})" if labels else "cast(map() as map<string,string>)",
        }


@dataclass(frozen=True)
class PairSpec:
    """A source and a target to reconcile.

    ``target_keys`` names the key columns of the target where they differ from the source's;
    ``column_map`` does the same for other columns, from source name to target name.  The target
    is renamed before anything else is done with it, so filters, schema, metrics and rows all see
    the names of the source.  ``filter`` is for both sides, ``target_filter`` replaces it on the target.
    ``match`` is ``"strict"`` (same name and type) or ``"name"`` (same name ignoring case).
    ``hash_mode="compat"`` joins the values of a row as other tools do, where a null equals the
    text ``NULL``.
    ``columns_per_pass`` splits the column metrics of wide columnar tables, see
    ``column_metrics``.  ``screen=False`` compares digests of all rows in one pass, see
    ``operators.rowdiff``.  ``repeats`` says what a key with several rows is compared by:
    ``"smallest"``, the row of smallest hash, or ``"all"``, every row as often as it is there.
    """

    name: str
    source: DataFrame
    target: DataFrame
    keys: Sequence[str] = ()
    target_keys: Sequence[str] | None = None
    filter: str | None = None
    target_filter: str | None = None
    column_map: Mapping[str, str] = field(default_factory=dict)
    match: str = "strict"
    hash_mode: str = "strict"
    hash_algo: str = "sha256"
    abs_tol: float = 1e-6
    rel_tol: float | None = 1e-10
    columns_per_pass: int | None = None
    screen: bool = True
    repeats: str = "smallest"
    extra_checks: Sequence[Callable[[PairSpec], DataFrame]] = ()

    def named_alike(self) -> PairSpec:
        """The same pair with the target under the names of the source."""
        target_keys = list(self.target_keys or self.keys)
        if len(target_keys) != len(self.keys):
            raise ValueError("source and target need the same number of key columns")
        names = {**{t: s for s, t in self.column_map.items()}, **dict(zip(target_keys, self.keys))}
        if self.match == "name":
            names = {t.lower(): s for t, s in names.items()}
            new = [names.get(c.lower(), c) for c in self.target.columns]
        else:
            new = [names.get(c, c) for c in self.target.columns]
        absent = [c for c in self.column_map.values() if c not in self.target.columns and self.match != "name"]
        if absent:
            raise ValueError(f"target has no column {absent}")
        target = self.target if new == self.target.columns else self.target.toDF(*new)
        return replace(self, target=target, target_keys=None, column_map={})


@dataclass(frozen=True)
class ValidationResult:
    """The four tables that one validation gives."""

    results: DataFrame
    mismatches: DataFrame | None = None
    drift: DataFrame | None = None
    schema: DataFrame | None = None
