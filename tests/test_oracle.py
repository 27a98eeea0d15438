"""Every registered query against its SQL counterpart in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as registry

from tablecheck.testbed.oracle import ORACLES
from tablecheck.testbed.queries import QUERIES

from conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(value):
        if isinstance(value, float) and math.isnan(value):
            return None
        return float(value) if isinstance(value, int) and not isinstance(value, bool) else value

    return sorted(columns), sorted((tuple(one(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = registry.queries()[name](spark, SF_DIR)
    expected = duck.execute(registry.oracle_sql()[name])
    columns, rows = [c[0] for c in expected.description], expected.fetchall()
    assert comparable(found.columns, [tuple(r) for r in found.collect()]) == comparable(columns, rows)


def test_entry(spark):
    assert registry.entry(spark).count() == 22
