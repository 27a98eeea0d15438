"""The inventory of table pairs, a CSV file of five text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import field

# The header of an inventory file.
INVENTORY_COLUMNS = (
    "source_table",
    "target_table",
    "validation_type",
    "primary_key",
    "filter_condition",
)

BYTE_ORDER_MARK = "﻿"


def missing_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in INVENTORY_COLUMNS if c not in columns]


def clean_inventory(df: DataFrame) -> DataFrame:
    """Trim every field, lower-case the type, and turn blanks into empty text."""
    tidy = {c: F.trim(F.coalesce(field(c), F.lit(""))) for c in INVENTORY_COLUMNS}
    tidy["validation_type"] = F.lower(tidy["validation_type"])
    return df.withColumns(tidy)


def load_inventory(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """The rows of the inventory with their line numbers, the first data row being line 2.

    Header names are trimmed and lose a byte-order mark.  A file that lacks a required column
    comes back as read, without line numbers; the lint reports what is missing.

    A quoted line break stays in its field; a file is therefore read in one task, which suits
    configuration, and the numbers count records.

    Lines are numbered per file without gathering the rows: rows are counted per input block,
    the block counts are summed up in file order, and each row adds its place in its block.
    """
    raw = spark.read.csv(path, header=True, sep=delimiter, quote='"', escape='"', multiLine=True)
    names = [c.lstrip(BYTE_ORDER_MARK).strip() for c in raw.columns]
    rows = raw.toDF(*names)
    if missing_columns(names):
        return rows
    placed = raw.select(
        *[raw[f"`{old}`"].alias(new) for old, new in zip(raw.columns, names)],
        F.col("_metadata.file_path").alias("__tc_file"),
        F.col("_metadata.file_block_start").alias("__tc_block"),
        F.monotonically_increasing_id().alias("__tc_id"),
    )
    block = ["__tc_file", "__tc_block"]
    sizes = placed.groupBy(*block).agg(F.min("__tc_id").alias("__tc_first"), F.count("*").alias("n"))
    before = Window.partitionBy("__tc_file").orderBy("__tc_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        *block, "__tc_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__tc_before")
    )
    line = F.col("__tc_before") + F.col("__tc_id") - F.col("__tc_first") + 2
    numbered = placed.join(starts, block).withColumn("line", line)
    return clean_inventory(numbered.select("line", *INVENTORY_COLUMNS))
