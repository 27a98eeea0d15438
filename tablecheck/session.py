"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings on which the text of a value, and so its hash, depends.

    Timestamps are written as text before they are hashed, hence the fixed zone.  ANSI mode
    stays on so that an overflow stops the check instead of turning into a null that matches.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, which every executor must be able to read."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/") + "/tablecheck"
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the whole cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tablecheck-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and lets Catalyst see the true
    size, so that a later join broadcasts the table only when it is under the session's limit.
    The table stays until the folder is cleaned, as its readers may still be lazy.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Materialised tables of a run that writes its results; dropped when it ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *failure: object) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for text in self.paths:
            path = jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(conf).delete(path, True)
