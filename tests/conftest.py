import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("larder-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from larder.sources.scratch import discard_scratch

    discard_scratch(session)
    session.stop()


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def uncoalesced(setting):
    """Keep small shuffles in as many partitions as large ones would have."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


@pytest.fixture(scope="session")
def golden(spark, tmp_path_factory):
    """The golden files taken through every stage."""
    import golden_data

    return golden_data.build(spark, str(tmp_path_factory.mktemp("golden")))
