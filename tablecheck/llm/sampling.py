"""Bounded samples for training, without sending rows of every task to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least(rows: DataFrame, order: Column, most: int) -> DataFrame:
    """Up to ``most`` rows, those of least ``order``, a 64-bit hash; rows that share a hash count once.

    The row count gives a threshold below which some ``2 * most`` rows are expected, however large the
    table is; only these are de-duplicated and ordered.  The same table gives the same rows.
    """
    n = rows.count()
    hashed = rows.withColumn("_order", order)
    if n > 2 * most:
        hashed = hashed.where(F.col("_order") < F.lit(-(2**63) + 2**64 * 2 * most // n))
    return hashed.dropDuplicates(["_order"]).orderBy("_order").limit(most).drop("_order")
