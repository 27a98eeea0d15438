"""Shards of near equal size through a fixed number of virtual slots.

A record's slot is a hash of the whole record (key, size, check sum, and the number of the copy among
equal ones) and never changes, so rows that share a key spread over all slots.  The bytes of all slots are summed, and a
table maps slots to shards: the heaviest slot goes first, each to the lightest shard.  The map has a
version; when data or the number of shards change, an edited copy with the next version is written,
which moves as few slots as the new balance needs.  Only the map moves records.

Everything is DataFrame and SQL functions.  The map has as many rows as there are slots, a fixed
number, so folding over it in one row is bounded whatever the table holds.

Defined results: a null text has no bytes, its check sum is that of no bytes; records without a key
are spread like others; repeated rows are sharded one by one; an empty table has no rows and all slots of its
map are empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096


#: Equal records that are written out together.
COPIES = 4096


def slot_of(*record: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record."""
    return F.pmod(F.xxhash64(*record), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones as well.  ``records`` has ``virtual_slot`` and ``size``."""
    spark = records.sparkSession
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(sums, "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("rows", F.lit(0)).alias("rows")
    )


def _lightest(loads: Column) -> Column:
    return F.array_position(loads, F.array_min(loads)).cast("int")


def new_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map: ``version``, ``virtual_slot`` and ``shard``."""
    return _assign(sizes.withColumn("shard", F.lit(None).cast("int")), shards, 1)


def rebalanced(mapped: DataFrame, sizes: DataFrame, shards: int, tolerance: float = 0.01) -> DataFrame:
    """The next version: slots stay where they are unless their shard exceeds its share.

    In each shard slots are kept from the lightest on while they fit into the even share plus the
    tolerance, so the few heaviest leave; these, and those of shards that are gone, are given out
    anew.
    """
    version = mapped.agg(F.max("version")).first()[0]
    now = mapped.where(F.col("version") == version).select("virtual_slot", "shard")
    joined = sizes.join(now, "virtual_slot", "left")
    share = sizes.agg(F.sum("size")).first()[0] / shards * (1 + tolerance)
    held = Window.partitionBy("shard").orderBy("size", "virtual_slot")
    stays = (F.sum("size").over(held) <= share) & (F.col("shard") < shards)
    kept = joined.withColumn("shard", F.when(stays, F.col("shard")))
    return _assign(kept, shards, version + 1)


def _assign(sizes: DataFrame, shards: int, version: int) -> DataFrame:
    """Slots without a shard go, heaviest first, to the shard that is lightest so far."""
    slot = F.struct((-F.col("size")).alias("minus"), "virtual_slot", "shard")
    one = sizes.agg(F.sort_array(F.collect_list(slot)).alias("slots"))
    fixed = F.filter("slots", lambda s: s["shard"].isNotNull())
    free = F.filter("slots", lambda s: s["shard"].isNull())
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.aggregate(F.filter(F.col("fixed"), lambda s: s["shard"] == i), F.lit(0).cast("long"), lambda a, s: a - s["minus"]),
    )
    one = one.select(fixed.alias("fixed"), free.alias("free")).select("fixed", "free", loads.alias("loads"))

    def give(state: Column, s: Column) -> Column:
        to = _lightest(state["loads"])
        return F.struct(
            F.transform(state["loads"], lambda x, i: F.when(i + 1 == to, x - s["minus"]).otherwise(x)).alias("loads"),
            F.concat(state["given"], F.array(to - 1)).alias("given"),
        )

    start = F.struct(F.col("loads").alias("loads"), F.array().cast("array<int>").alias("given"))
    one = one.select("fixed", "free", F.aggregate("free", start, give)["given"].alias("given"))
    given = F.transform(F.arrays_zip("free", "given"), lambda x: F.struct(x["free"]["virtual_slot"].alias("virtual_slot"), x["given"].alias("shard")))
    held = F.transform("fixed", lambda s: F.struct(s["virtual_slot"].alias("virtual_slot"), s["shard"].alias("shard")))
    return one.select(F.inline(F.concat(given, held))).select(F.lit(version).alias("version"), "virtual_slot", "shard")


def write_map(mapped: DataFrame, path: str) -> None:
    """Append a version to the stored map; earlier versions stay readable."""
    mapped.write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the last one by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def records(df: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size in bytes, check sum and virtual slot of every row; texts go no further.

    Equal records are counted and written out again with a number each, in bounded runs that are
    dealt over the tasks: the number does not depend on how the table is read.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    own = ["doc_id", "size", "text_crc32"]
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    counted = rows.groupBy(*own).agg(F.count("*").alias("n"))
    runs = counted.select(*own, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))).alias("run"))
    runs = runs.repartition(*own, "run")
    low = F.col("run") * COPIES
    copies = runs.select(*own, F.explode(F.sequence(low, F.least(F.col("n"), low + COPIES) - 1)).alias("copy"))
    return copies.select(*own, slot_of(F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("copy"), slots=slots).alias("virtual_slot"))


def place(rows: DataFrame, mapped: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each record with its shard and its number there, from 0 without gaps.

    Records are numbered within their virtual slot; the rows of the slots before it in the same
    shard come from the map, so no shard comes together in one task.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = mapped.join(sizes, "virtual_slot").select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("number", F.row_number().over(within) - 1)
        .join(F.broadcast(bases), "virtual_slot")  # as many rows as slots, a fixed number
        .withColumn("slot", (F.col("base") + F.col("number")).cast("long"))
        .drop("base", "number")
    )


def shard(df: DataFrame, shards: int, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All records by the law ``bytes``: doc_id, size, text_crc32, shard, slot and virtual_slot."""
    from tablecheck.llm.scratch import materialise

    rows = materialise(records(df, slots, key, text))
    sizes = materialise(slot_sizes(rows, slots))
    mapped = materialise(new_map(sizes, shards))
    return place(rows, mapped, sizes)
