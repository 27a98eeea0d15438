"""Many validations under one run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from ..sinks import read_results, write_results
from ..spec import ERROR, PairSpec, Run
from .inventory import LINT_ERROR, lint_inventory
from .validate import ALL_CHECKS, note, run_pair, stamp

# Which checks of ``run_pair`` a validation type stands for.
CHECKS = {"row": ("count", "row"), "column": ("count", "column"), "schema": ("schema",)}


def run_batch(
    jobs: Sequence[tuple[PairSpec, Sequence[str]]],
    run: Run,
    results_target: str,
    audit_target: str | None = None,
    workers: int = 3,
) -> None:
    """Validate pairs side by side, at most ``workers`` at a time.

    Each pair is its own set of Spark jobs in a scheduler pool of its own, so a failing pair takes
    no other along, and with ``spark.scheduler.mode=FAIR`` a slow one holds up no other.  A pair
    replaces its own partition of the targets: unlike appends, such writes may run at the same time,
    and a repeated run leaves its rows once.
    """
    if not jobs:
        return
    spark = jobs[0][0].source.sparkSession

    def one(job: tuple[PairSpec, Sequence[str]]) -> None:
        spec, checks = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            run_pair(spec, run, results_target, audit_target, checks, mode="replace")
        except Exception as problem:  # noqa: BLE001 - any failure is a result row
            failed = stamp(note(spark, "run", ERROR, str(problem)), spec, run)
            write_results(failed, results_target, "replace")
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    # The first pair runs alone, as it creates the targets where they are catalog tables.
    first, rest = jobs[0], jobs[1:]
    one(first)
    with ThreadPoolExecutor(max_workers=workers) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), rest))


def validate_batch(specs: Sequence[PairSpec], run: Run, workers: int = 3) -> DataFrame:
    """The results of all checks of several pairs under one run, as a table that is written first.

    Every pair and every check of a pair runs by itself: what fails while it runs is an ERROR row,
    and the other rows are all there.
    """
    if not specs:
        raise ValueError("no pairs")
    spark = specs[0].source.sparkSession
    target = scratch_path(spark, "batch")
    run_batch([(spec, ALL_CHECKS) for spec in specs], run, target, None, workers)
    return read_results(spark, target, run.run_id)


def _faults(plan: DataFrame) -> dict[str, str]:
    """What the rules of an inventory say against rows of a plan, by plan key."""
    rows = plan.select(
        F.col("plan_key").alias("line_key"),
        F.lit(0).alias("line"),
        F.coalesce("source", F.lit("")).alias("source_table"),
        F.coalesce("target", F.lit("")).alias("target_table"),
        F.coalesce("type", F.lit("")).alias("validation_type"),
        F.coalesce(F.concat_ws(",", "primary_keys"), F.lit("")).alias("primary_key"),
        F.coalesce("filters", F.lit("")).alias("filter_condition"),
    )
    # The subject of a finding is the plan row.
    found = lint_inventory(rows, subject="line_key").filter(F.col("severity") == LINT_ERROR)
    told: dict[str, str] = {}
    for row in found.orderBy("subject", "rule").toLocalIterator():
        told[row["subject"]] = "; ".join(filter(None, [told.get(row["subject"]), f"{row['rule']}: {row['message']}"]))
    return told


def run_plan(
    plan: DataFrame,
    resolver: Callable[[str], DataFrame],
    run: Run,
    results_target: str,
    audit_target: str | None = None,
    workers: int = 3,
    **options: Any,
) -> None:
    """Run every row of a compiled plan; ``resolver`` turns a table name into a DataFrame.

    Rows that break a rule of the inventory, such as an unsafe filter, are not run: each is an ERROR
    row that names the rule.  A plan is configuration, a row per validation, and is read by the driver; table rows are
    not.  ``options`` are passed on to every pair.
    """
    jobs, broken, faults = [], [], _faults(plan)
    for row in plan.dropDuplicates(["plan_key"]).orderBy("plan_key").toLocalIterator():
        name = f"{row['source']}={row['target']}#{row['plan_key']}"
        try:
            if row["plan_key"] in faults:
                raise ValueError(faults[row["plan_key"]])
            if row["type"] not in CHECKS:
                raise ValueError(f"unknown validation type {row['type']!r}")
            spec = PairSpec(
                name,
                resolver(row["source"]),
                resolver(row["target"]),
                keys=tuple(row["primary_keys"] or ()),
                filter=row["filters"],
                **options,
            )
        except Exception as problem:  # noqa: BLE001 - the other plan rows run all the same
            broken.append((name, str(problem)))
        else:
            jobs.append((spec, CHECKS[row["type"]]))
    for name, problem in broken:
        empty = plan.sparkSession.range(0)
        failed = stamp(note(plan.sparkSession, "setup", ERROR, problem), PairSpec(name, empty, empty), run)
        write_results(failed, results_target, "replace", (run.run_id, name))
    run_batch(jobs, run, results_target, audit_target, workers)
