"""Helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one slice: what a task holds as Python objects at once.
SLICE_ROWS = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text alone, under fixed names; a missing text is empty."""
    return df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def map_slices(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int = SLICE_ROWS
) -> DataFrame:
    """``make`` runs once in each task and returns what is applied to each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for piece in slices(batches, rows):
            out = step(piece)
            if out.num_rows:
                yield out

    return df.mapInArrow(run, schema)
