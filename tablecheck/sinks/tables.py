"""Audit and result tables, partitioned by run and pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import literal
from ..sources import load_table
from ..spec import AUDIT_SCHEMA, RESULT_SCHEMA

PARTITIONS = ("run_id", "pair")
MODES = ("append", "replace")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of ``schema``; a null in a required column stops the write."""

    def one(f: T.StructField):
        value = F.col(f.name).cast(f.dataType)
        if f.nullable:
            return value.alias(f.name)
        stop = F.raise_error(F.lit(f"{f.name} is required")).cast(f.dataType)
        return F.coalesce(value, stop).alias(f.name)

    return df.select(*[one(f) for f in schema.fields])


def _drop_partition(spark: SparkSession, target: str, run_id: str, pair: str, schema: T.StructType) -> None:
    """Delete what an earlier attempt of this run left for this pair."""
    if "/" not in target:
        if spark.catalog.tableExists(target):
            spark.sql(f"alter table {target} drop if exists partition (run_id = {literal(run_id)}, pair = {literal(pair)})")
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(target)
    if not place.getFileSystem(conf).exists(place):
        return
    old = spark.read.schema(schema).parquet(target).filter((F.col("run_id") == run_id) & (F.col("pair") == pair))
    for row in old.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).distinct().collect():
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(row.folder))
        folder.getFileSystem(conf).delete(folder, True)


def _write(df: DataFrame, target: str, mode: str, only: tuple[str, str] | None, schema: T.StructType) -> None:
    """Append, or replace exactly the (run, pair) partitions at hand, so that a run repeated
    after a failure leaves its rows once.  ``only`` names the partition that the rows belong to:
    without rows it is emptied, which an overwrite of the partitions found in the rows is not."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "replace" and only and df.isEmpty():
        _drop_partition(df.sparkSession, target, *only, schema)
    writer = df.write.partitionBy(*PARTITIONS).format("parquet")
    if mode == "append":
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if "/" in target:
        writer.save(target)
    elif mode == "append" or not df.sparkSession.catalog.tableExists(target):
        writer.saveAsTable(target)
    else:
        order = df.sparkSession.table(target).columns
        df.select(*order).write.option("partitionOverwriteMode", "dynamic").insertInto(
            target, overwrite=True
        )


def write_audit(df: DataFrame, target: str, mode: str = "append", only: tuple[str, str] | None = None) -> None:
    """One row per mismatch; the table is created by the first write, also without rows."""
    _write(conform(df, AUDIT_SCHEMA), target, mode, only, AUDIT_SCHEMA)


def write_results(df: DataFrame, target: str, mode: str = "append", only: tuple[str, str] | None = None) -> None:
    """One row per run, pair, check and metric."""
    _write(conform(df, RESULT_SCHEMA), target, mode, only, RESULT_SCHEMA)


def _read(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The table under its own schema, as a folder of a clean run holds no file to tell it."""
    return spark.read.schema(schema).parquet(target) if "/" in target else load_table(spark, target)


def read_results(spark: SparkSession, target: str, run_id: str) -> DataFrame:
    """All result rows of exactly this run."""
    rows = _read(spark, target, RESULT_SCHEMA).filter(F.col("run_id") == run_id)
    return rows.select(*RESULT_SCHEMA.names)


def read_mismatches(spark: SparkSession, target: str, run_id: str) -> DataFrame:
    """All mismatches of exactly this run."""
    rows = _read(spark, target, AUDIT_SCHEMA).filter(F.col("run_id") == run_id)
    return rows.select(*AUDIT_SCHEMA.names)


def first_mismatches(spark: SparkSession, target: str, run_id: str, n: int) -> DataFrame:
    """The first ``n`` mismatches of a run by key text, for a report."""
    rows = read_mismatches(spark, target, run_id)
    return rows.orderBy("primary_key_value", "mismatch_type", "pair").limit(n)


def run_history(spark: SparkSession, target: str) -> DataFrame:
    """Past runs: number of result rows per run, pair and status."""
    rows = _read(spark, target, RESULT_SCHEMA)
    return rows.groupBy("run_id", "run_ts", "pair", "status").agg(F.count("*").alias("n_rows"))
