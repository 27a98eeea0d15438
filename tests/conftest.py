import os
import sys

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tablecheck as tc  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tablecheck-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    if not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    tc.configure(session)
    yield session
    session.stop()


@pytest.fixture
def pair_of(spark):
    """Two literal tables as an aligned pair."""

    def build(source, target, keys, schema, target_schema=None, **options):
        s = spark.createDataFrame(source, schema)
        t = spark.createDataFrame(target, target_schema or schema)
        return tc.align(tc.PairSpec("pair", s, t, keys, **{"hash_mode": "compat", **options}))

    return build


@pytest.fixture
def derived(spark):
    """A derived pair of the driver tables."""
    from tablecheck.testbed.pairs import PAIRS

    def build(table, **options):
        pair = PAIRS[table]
        source, target = pair.load(spark, SF_DIR)
        return tc.PairSpec(table, source, target, pair.keys, **{"hash_mode": "compat", **options})

    return build


@pytest.fixture
def run():
    from datetime import datetime, timezone

    return tc.Run("run-1", datetime(2026, 7, 16, 9, 55, 44, tzinfo=timezone.utc), {"team": "dwh"})
