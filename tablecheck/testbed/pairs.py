"""Source and target of each test pair, as one SQL text for Spark and DuckDB.

The source is a driver table; the target is derived from it by fixed rules that lose, add,
repeat and change rows.  ``{table}`` places hold the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class DerivedPair:
    table: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    source: str
    target: str

    def sql(self, side: str) -> str:
        """The text for an engine in which the tables are views."""
        return getattr(self, side).replace("{" + self.table + "}", self.table)

    def load(self, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
        table = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        return tuple(spark.sql(text, **{self.table: table}) for text in (self.source, self.target))


CUSTOMER = DerivedPair(
    "customer",
    ("c_custkey",),
    ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "select * from {customer}",
    """
    select c_custkey, c_name, c_nationkey,
           case when c_custkey%50=0 then c_acctbal+1 else c_acctbal end as c_acctbal,
           case when c_custkey%61=0 then null else c_mktsegment end as c_mktsegment
    from {customer} where c_custkey%97<>0
    union all
    select c_custkey+1000000, c_name, c_nationkey, c_acctbal, c_mktsegment
    from {customer} where c_custkey%89=0
    union all
    select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    from {customer} where c_custkey%83=0 and c_custkey%97<>0
    """,
)

ORDERS = DerivedPair(
    "orders",
    ("o_orderkey",),
    ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "select * from {orders}",
    "select * from {orders} where o_orderkey<>2",
)

EVENTS = DerivedPair(
    "events",
    ("event_id",),
    ("ts", "user_id", "event_type", "value", "props"),
    "select * from {events}",
    """
    select case when event_id%500=0 then null else event_id end as event_id,
           case when event_id%70=0 then ts + interval '1' second else ts end as ts, user_id,
           case when event_id%55=0 then upper(event_type) else event_type end as event_type,
           value,
           case when event_id%45=0 then null else props end as props
    from {events} where event_id%211<>0
    """,
)

LINEITEM = DerivedPair(
    "lineitem",
    ("l_orderkey", "l_linenumber"),
    ("l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"),
    """
    select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate
    from {lineitem}
    """,
    """
    select l_orderkey, l_linenumber, l_quantity,
           case when l_orderkey%100=0 and l_linenumber=1 then l_extendedprice*2
                else l_extendedprice end as l_extendedprice,
           l_returnflag, l_shipdate
    from {lineitem} where not (l_orderkey%211=0 and l_linenumber=2)
    union all
    select l_orderkey+10000000, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
           l_shipdate
    from {lineitem} where l_orderkey%307=0
    """,
)

SUPPLIER = DerivedPair(
    "supplier",
    ("s_suppkey",),
    ("s_name", "s_acctbal"),
    "select * from {supplier}",
    """
    select cast(s_suppkey as int) as s_suppkey, s_name, s_acctbal, 'x' as load_tag
    from {supplier}
    """,
)

PAIRS = {p.table: p for p in (CUSTOMER, ORDERS, EVENTS, LINEITEM, SUPPLIER)}

# Names in another case and a narrower key type, for the relaxed match.
RELAXED = DerivedPair(
    "supplier",
    (),
    ("s_suppkey", "s_name", "s_acctbal"),
    "select * from {supplier}",
    """
    select cast(s_suppkey as int) as S_SUPPKEY, upper(s_name) as S_NAME,
           case when s_suppkey%9=0 then null else s_acctbal end as s_acctbal, 'x' as load_tag
    from {supplier}
    """,
)

# Nothing in common but the number of rows.
DISJOINT = DerivedPair(
    "orders",
    (),
    (),
    "select o_orderkey as a, o_custkey as b from {orders}",
    "select o_orderkey as c, o_custkey as d from {orders} where o_orderkey<>2",
)

# Fixed-width text keys on the source side.
PADDED = DerivedPair(
    "customer",
    ("c_name",),
    ("c_acctbal",),
    "select rpad(c_name, 25, ' ') as c_name, c_acctbal from {customer}",
    """
    select c_name, case when c_custkey%50=0 then c_acctbal+1 else c_acctbal end as c_acctbal
    from {customer} where c_custkey%97<>0
    """,
)

# Queries in place of tables.
CUSTOM_ROW = DerivedPair(
    "orders",
    ("o_custkey",),
    ("n_orders", "last_day"),
    """
    select o_custkey, count(*) as n_orders, max(o_orderdate) as last_day
    from {orders} group by o_custkey
    """,
    """
    select o_custkey, count(*) as n_orders, max(o_orderdate) as last_day
    from {orders} where o_orderkey%31<>0 group by o_custkey
    """,
)
CUSTOM_COLUMN = DerivedPair(
    "lineitem",
    (),
    ("l_quantity", "l_discount", "l_linenumber", "l_returnflag"),
    "select l_quantity, l_discount, l_linenumber, l_returnflag from {lineitem}",
    """
    select l_quantity, l_discount, l_linenumber, l_returnflag
    from {lineitem} where l_orderkey%211<>0
    """,
)

# Numbers of one value under several types, beside values that no common type holds.
MIXED_NUMBERS = DerivedPair(
    "supplier",
    ("s_suppkey",),
    ("amount", "large", "whole"),
    """
    select s_suppkey,
           case when s_suppkey%10=0 then 1e-11 when s_suppkey%10=1 then cast('NaN' as double)
                else s_acctbal end as amount,
           case when s_suppkey%7=0 then 1e30 else s_acctbal end as large,
           cast(s_suppkey as double) as whole
    from {supplier}
    """,
    """
    select s_suppkey,
           case when s_suppkey%10=0 then cast(0 as decimal(20,11))
                when s_suppkey%10=1 then cast(null as decimal(20,11))
                else cast(s_acctbal as decimal(20,11)) end as amount,
           case when s_suppkey%7=0 then cast('1000000000000000000000000000000' as decimal(38,4))
                else cast(s_acctbal as decimal(38,4)) end as large,
           s_suppkey + case when s_suppkey%13=0 then 1 else 0 end as whole
    from {supplier}
    """,
)

# The customer pair with another predicate on each side, and its target under names of its own.
FILTERED = DerivedPair(
    "customer",
    CUSTOMER.keys,
    CUSTOMER.columns,
    "select * from {customer} where c_acctbal >= 0",
    f"select * from ({CUSTOMER.target}) x where c_acctbal >= 1",
)
OTHER_NAMES = {"c_custkey": "id", "c_name": "full name", "c_nationkey": "nation", "c_acctbal": "balance", "c_mktsegment": "segment"}

# Text where a number is asked for: fails in the rows, not before.
BROKEN = "select c_custkey, c_name, cast(c_name as int) as c_nationkey, c_acctbal, c_mktsegment from {customer}"

# An inventory line per part; one part in so many breaks one of the rules.
INVENTORY = """
    select p_partkey + 2 as line,
           case when p_partkey%50=0 then '  '
                else ' SRC.T' || cast(p_partkey as string) end as source_table,
           case when p_partkey%70=0 then '' else 'tgt.t' || cast(p_partkey as string) end
               as target_table,
           case when p_partkey%40=1 then 'table' when p_partkey%3=0 then ' Column '
                when p_partkey%17=0 then 'schema' else 'ROW' end as validation_type,
           case when p_partkey%3=0 and p_partkey%4<>0 then ''
                when p_partkey%45=2 then '  '
                when p_partkey%5=0 then 'order_id, line_num' else ' id ' end as primary_key,
           case when p_partkey%60=3 then 'a = 1; drop table t'
                when p_partkey%61=4 then 'a = 1 -- all'
                when p_partkey%62=5 then 'a /* x */ = 1'
                when p_partkey%2=0 then 'p_size > ' || cast(p_size as string)
                else '' end as filter_condition
    from {part}
"""

EVENTS_FILTER = "ts >= TIMESTAMP('2024-01-01 12:00:00') and event_type <> 'error'"
DRILL_GROUPS = ("c_nationkey", "c_mktsegment")
N_BUCKETS = 64
SAMPLE_SIZE = 200
SAMPLE_SEED = 42
