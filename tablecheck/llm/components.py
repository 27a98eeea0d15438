"""Connected components of a graph that no single machine need hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.scratch import materialise, release


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of ``edges`` (``a``, ``b``).

    Each round takes the smallest label among the neighbours and then the label of that label, so
    that long chains shorten by half; each round is kept in the shared folder.  It ends when no label
    changes.  Null nodes are left out; a table without edges has no nodes.
    """
    ends = edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct()
    both = materialise(ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    # The first round needs no labels: every node is its own.
    first = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label"))
    labels = materialise(first)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("low"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label")
        )
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        now = materialise(
            hooked.join(up, "label", "left").select("node", "old", F.coalesce(F.least("above", "label"), "label").alias("label"))
        )
        changed = now.where("old <> label").limit(1).count()
        release(labels)
        labels = now
        if not changed:
            release(both)
            return labels.select("node", "label")
