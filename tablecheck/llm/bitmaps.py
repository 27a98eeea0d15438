"""Sets of hashed things as bitmaps of a fixed size.

A bitmap tells for certain what is not in the set; what it admits wrongly has to be removed by an exact
step behind it.  It has ``2 ** BITS`` bits whatever the data are, so it may go through the driver and
to every task; a larger corpus needs more bits to keep pruning well, and stays right without.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 ** 26 bits are 8 MB.
BITS = 26

#: Fixed value: the positions of one row that ``bitmap_construct_agg`` makes (4,096 bytes).
_ROW_BITS = 32_768


def empty(bits: int = BITS) -> np.ndarray:
    return np.zeros(1 << (bits - 3), dtype=np.uint8)


def bitmap(slots: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap of the column ``slot``, integers from 0 to ``2 ** bits - 1``.

    Built by aggregation on the executors; the driver gets at most ``2 ** bits`` bits.
    """
    rows = slots.select(F.floor(F.col("slot") / _ROW_BITS).alias("row"), (F.col("slot") % _ROW_BITS).alias("position"))
    found = empty(bits)
    for row in rows.groupBy("row").agg(F.bitmap_construct_agg("position").alias("map")).collect():
        part = np.frombuffer(row["map"], dtype=np.uint8)
        start = row["row"] * (_ROW_BITS // 8)
        found[start : start + len(part)] = part[: len(found) - start]
    return found


def admits(found: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of the slots are in the bitmap."""
    return (found[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def slots_of(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The slots of 64-bit hashes."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)
