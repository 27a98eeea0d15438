"""Tables, files, databases, queries and schemas as DataFrames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("pair", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
    ]
)


# Which formats are read by the older readers, which know no footers.
V1_READERS = "spark.sql.sources.useV1SourceList"


def load_table(spark: SparkSession, ref: str, format: str = "parquet") -> DataFrame:
    """A path (anything with a slash) or a catalog table such as ``catalog.schema.table``."""
    if "/" in ref:
        return spark.read.format(format).load(ref)
    return spark.table(ref)


def load_with_footers(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files through the reader that can answer from their footers.

    Counts, and smallest and largest values of numbers and dates, over all rows without a filter read no
    data, given the setting that ``configure`` makes; everything else reads like ``load_table``.
    """
    readers = spark.conf.get(V1_READERS)
    spark.conf.set(V1_READERS, ",".join(x for x in readers.split(",") if x.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(V1_READERS, readers)


def load_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """A query in place of a table; ``views`` fill ``{name}`` places in the text."""
    return spark.sql(sql, **views)


def jdbc_options(
    url: str,
    table_or_query: str,
    partition_col: str | None = None,
    lower: Any = None,
    upper: Any = None,
    n: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a database scan.

    With a partition column the scan is split into ``n`` ranges that are read in parallel.
    Spark allows a partitioned read of a table or sub-select, not of the ``query`` option.
    """
    is_query = table_or_query.lstrip().lower().startswith(("select", "with"))
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partition_col is None:
        options["query" if is_query else "dbtable"] = table_or_query
        return options
    if lower is None or upper is None or n is None:
        raise ValueError("a partitioned scan needs lower, upper and n")
    options["dbtable"] = f"({table_or_query}) tc_query" if is_query else table_or_query
    options["partitionColumn"] = partition_col
    options["lowerBound"] = str(lower)
    options["upperBound"] = str(upper)
    options["numPartitions"] = str(n)
    return options


def load_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    partition_col: str | None = None,
    lower: Any = None,
    upper: Any = None,
    n: int | None = None,
    **extra: str,
) -> DataFrame:
    """A table or query of another database.

    Credentials belong in ``extra`` or the session's connector settings and are never copied
    into plan or result rows.  Filters on the result are pushed to the database.
    """
    options = jdbc_options(url, table_or_query, partition_col, lower, upper, n)
    return spark.read.format("jdbc").options(**options, **extra).load()


def catalog_rows(df: DataFrame, pair: str) -> list[tuple[str, int, str, str]]:
    return [(pair, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]


def schema_catalog(df: DataFrame, pair: str) -> DataFrame:
    """The columns of ``df`` as rows, one per column."""
    return df.sparkSession.createDataFrame(catalog_rows(df, pair), CATALOG_SCHEMA)
