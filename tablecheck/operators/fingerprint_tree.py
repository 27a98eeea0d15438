"""A tree of fingerprints for each version of a table, kept beside it.

Rows are dealt by a hash of their key to ``fanout ** depth`` leaves; a node's fingerprint is the number of
rows below it and sums over the halves of two 64-bit hashes of their keys and digests, so that a parent is
the sum of its children.  Two trees are compared from the root down, children only of nodes that
differ; then the keys of the leaves that differ are matched.

A tree is built once for a version: one scan of the table and one shuffle of its keys and digests,
which are stored in the order of the leaves, digests as 32 bytes.  Comparing two versions that have trees reads no
table: it reads a few node rows for each level and the stored keys of the differing leaves.  A new
version of one side costs one scan of that side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import quoted
from ..functions.hashing import hash_sql, row_sql
from .columns import Aligned
from .rowdiff import STORED, row_diff

LEAF, TOP, DIGEST = "__tc_leaf", "__tc_top", "__tc_digest"
_SUMS = [f"s{i}" for i in range(4)]


@dataclass(frozen=True)
class Tree:
    """A stored tree: its folder and its shape."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    depth: int
    fanout: int
    row_schema: T.StructType

    @property
    def nodes(self) -> DataFrame:
        """``level``, ``node``, ``n``, ``keyless`` and the sums; the leaves are the last level."""
        sums = ", ".join(f"{s} bigint" for s in _SUMS)
        return self.spark.read.schema(f"node int, n bigint, keyless bigint, {sums}, level int").parquet(f"{self.path}/nodes")

    @property
    def rows(self) -> DataFrame:
        """The keys of the table with the digest of each row, by leaf."""
        return self.spark.read.schema(self.row_schema).parquet(f"{self.path}/rows")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stored_tree(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    path: str,
    version: str,
    depth: int = 3,
    fanout: int = 16,
    hash_mode: str = "strict",
) -> Tree:
    """The tree of ``df`` under ``path`` and ``version``, built if it is not there yet.

    The caller's version must change when the table, the columns or the shape do.  The nodes are written
    last, so a build that failed half-way is done again.
    """
    spark = df.sparkSession
    own = [T.StructField(LEAF, T.IntegerType()), T.StructField(DIGEST, T.BinaryType()), T.StructField(TOP, T.IntegerType())]
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys] + own)
    tree = Tree(spark, f"{path.rstrip('/')}/{version}/binary", tuple(keys), depth, fanout, schema)
    if _exists(spark, f"{tree.path}/nodes/_SUCCESS"):
        return tree
    n_leaves = fanout**depth
    leaf = f"cast(pmod(xxhash64({row_sql(df.schema, keys, 'strict')}), {n_leaves}L) as int) as {LEAF}"
    digest = f"unhex({hash_sql(df.schema, columns, hash_mode)}) as {DIGEST}"
    rows = df.selectExpr(*map(quoted, keys), leaf, digest)
    # Ranges of leaves and keys: rows of one key, however many, may lie in several ranges.
    spread = rows.repartitionByRange(F.col(LEAF), F.xxhash64(DIGEST)).sortWithinPartitions(LEAF)
    spread.withColumn(TOP, F.expr(f"cast({LEAF} div {fanout ** (depth - 1)} as int)")).write.mode("overwrite").partitionBy(TOP).parquet(f"{tree.path}/rows")

    hashes = [f"xxhash64({salt}, {', '.join(map(quoted, (*keys, DIGEST)))}, {' , '.join(f'{quoted(k)} is null' for k in keys)})" for salt in (0, 1)]
    halves = [half.format(h) for h in hashes for half in ("shiftright({}, 32)", "({}) & 4294967295L")]
    keyless = " or ".join(f"{quoted(k)} is null" for k in keys)
    parts = tree.rows.selectExpr(LEAF, f"if({keyless}, 1L, 0L) as keyless", *[f"{h} as {s}" for h, s in zip(halves, _SUMS)])
    sums = [F.sum("keyless").alias("keyless"), *[F.sum(s).alias(s) for s in _SUMS]]
    leaves = parts.groupBy(F.col(LEAF).alias("node")).agg(F.count("*").alias("n"), *sums)
    # Every level from the leaves: at most ``n_leaves`` rows.
    up = F.explode(F.sequence(F.lit(1), F.lit(depth))).alias("level")
    raised = leaves.select(up, "*").withColumn("node", F.expr(f"cast(node div cast(power({fanout}, {depth} - level) as bigint) as int)"))
    levels = raised.groupBy("level", "node").agg(F.sum("n").alias("n"), *sums)
    levels.write.mode("overwrite").partitionBy("level").parquet(f"{tree.path}/nodes")
    return tree


def _differs() -> str:
    same = " and ".join(f"s.{c} = t.{c}" for c in ("n", *_SUMS))
    return f"s.n is null or t.n is null or s.keyless > 0 or t.keyless > 0 or not ({same})"


def differing_leaves(source: Tree, target: Tree) -> DataFrame:
    """``node``: the leaves whose fingerprints differ, found from the top down.

    A leaf with rows that lack a part of their key differs always, as these match nothing.
    """
    if (source.keys, source.depth, source.fanout) != (target.keys, target.depth, target.fanout):
        raise ValueError("trees of different keys or shapes cannot be compared")
    found = None
    for level in range(1, source.depth + 1):
        s, t = (tree.nodes.filter(F.col("level") == level).drop("level") for tree in (source, target))
        if found is not None:
            above = found.withColumnRenamed("node", "parent")
            s, t = (side.join(above, F.expr(f"node div {source.fanout}") == F.col("parent"), "left_semi") for side in (s, t))
        both = s.alias("s").join(t.alias("t"), F.col("s.node") == F.col("t.node"), "full_outer")
        found = both.filter(_differs()).select(F.coalesce("s.node", "t.node").alias("node"))
    return found


def tree_row_diff(source: Tree, target: Tree) -> DataFrame:
    """The rows of ``row_diff`` of the two tables, from the stored trees alone."""
    shift = source.fanout ** (source.depth - 1)
    leaves = differing_leaves(source, target).select(F.col("node").alias("__tc_w"), F.expr(f"cast(node div {shift} as int)").alias("__tc_w_top"))
    on = [F.col(TOP) == F.col("__tc_w_top"), F.col(LEAF) == F.col("__tc_w")]
    cut = [tree.rows.join(leaves, reduce(lambda a, b: a & b, on), "left_semi") for tree in (source, target)]
    keys = list(source.keys)
    s, t = (df.selectExpr(*map(quoted, keys), f"lower(hex({DIGEST})) as {DIGEST}") for df in cut)
    return row_diff(Aligned(s, t, keys, [DIGEST], hash_algo=STORED, screen=False))
