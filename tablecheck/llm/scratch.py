"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only in a plain local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def drop(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, codec: str = "lz4") -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts the lineage: a lost
    executor costs no recomputation of what went before.  Dropped when the driver ends, or
    earlier with ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch_path = path
    return kept


def release(df: DataFrame) -> None:
    """Drop a table made by ``materialise`` that no result reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        _made[:] = [x for x in _made if x[1] != path]
        drop(df.sparkSession, path)


def _clean() -> None:
    for spark, path in _made:
        try:
            drop(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before
            return
