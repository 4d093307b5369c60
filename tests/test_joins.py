"""The split join: same rows as a plain left join, and even tasks under skew."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from larder.operators import joins
from larder.operators.joins import join_dimension, join_listed_dimension, split_join
from larder.sources.scratch import store

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def same_rows(df, expected):
    assert df.columns == expected.columns
    assert Counter(map(tuple, df.collect())) == Counter(map(tuple, expected.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    facts = [(i, k) for i, k in enumerate([None] * 300 + [""] * 200 + ["hot"] * 500 + ["lost"] * 100 + [f"k{i % 90}" for i in range(400)])]
    dimension = [(f"k{i}", i, "x") for i in range(60)] + [("hot", -1, "y"), ("hot", -2, None), (None, -3, "z"), ("many", 0, "m")]
    dimension += [("k5", 100 + i, "many") for i in range(40)]
    return (
        store(spark.createDataFrame(facts, "id long, key string").repartition(4), "facts"),
        store(spark.createDataFrame(dimension, "key string, value long, `odd.name` string"), "dimension"),
    )


def test_rows_match_a_plain_join(tables):
    fact, dimension = tables
    same_rows(split_join(fact, dimension, "key", "key"), fact.join(dimension, fact["key"] == dimension["key"], "left"))


def test_other_types_and_empty_tables(spark, tables):
    fact = spark.createDataFrame([(1, 7), (2, 7), (3, None), (4, 9)], "id long, n int")
    dimension = spark.createDataFrame([(7, "seven"), (8, "eight")], "m long, name string")
    expected = fact.join(dimension, fact["n"] == dimension["m"], "left")
    same_rows(split_join(fact, dimension, "n", "m"), expected)
    none = dimension.limit(0)
    same_rows(split_join(fact, none, "n", "m"), fact.join(none, fact["n"] == none["m"], "left"))
    assert split_join(fact.limit(0), dimension, "n", "m").count() == 0


def test_an_empty_key_that_the_dimension_knows(spark):
    fact = spark.createDataFrame([("",)] * 5 + [(None,)] * 3, "k string")
    dimension = spark.createDataFrame([("", 1), ("a", 2)], "k string, v int")
    assert Counter(r.v for r in split_join(fact, dimension, "k", "k").collect()) == {1: 5, None: 3}


def test_keys_of_many_rows_are_not_broadcast(spark, monkeypatch, tables):
    monkeypatch.setattr(joins, "ROWS_PER_KEY", 1)
    fact, dimension = tables
    joined = split_join(fact, dimension, "key", "key")
    same_rows(joined, fact.join(dimension, fact["key"] == dimension["key"], "left"))


@pytest.mark.parametrize("threshold", ["-1", "1", "10MB"])
def test_with_and_without_broadcast(setting, tables, threshold):
    fact, dimension = tables
    expected = fact.join(dimension, fact["key"] == dimension["key"], "left")
    rows = Counter(map(tuple, expected.collect()))
    setting(THRESHOLD, threshold)
    joined = join_dimension(fact, dimension, "key", "key")
    plan = joined._jdf.queryExecution().toString()
    assert ("Union" in plan) == (threshold == "1")
    assert Counter(map(tuple, joined.collect())) == rows


def test_listed_items(setting, spark):
    fact = spark.createDataFrame([(1, "a, b,,a"), (2, None), (3, ""), (4, "c")], "id long, list string")
    dimension = spark.createDataFrame([("a", 1), ("c", 3)], "name string, v int")
    expected = Counter(map(tuple, join_listed_dimension(fact, dimension, "list", "item", "name").collect()))
    setting(THRESHOLD, "1")
    assert Counter(map(tuple, join_listed_dimension(fact, dimension, "list", "item", "name").collect())) == expected


def test_no_task_has_over_twice_the_median(spark, setting, uncoalesced):
    """Four fifths of the rows have one key, a tenth none; adaptive execution is off."""
    setting("spark.sql.adaptive.enabled", "false")
    setting(THRESHOLD, "1")
    setting("spark.sql.shuffle.partitions", "16")
    key = F.when(F.col("id") % 10 < 8, F.lit(-1)).when(F.col("id") % 10 == 8, F.lit(None)).otherwise(F.col("id"))
    fact = store(spark.range(400_000).withColumn("key", key.cast("bigint")).repartition(16), "skewed")
    dimension = store(spark.range(-1, 400_000, 3).select(F.col("id").alias("of"), (F.col("id") * 2).alias("v")), "wide")
    joined = join_dimension(fact, dimension, "key", "of")
    rows = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    rare, still = [n for n in rows if n < 10_000], [n for n in rows if n >= 10_000]
    assert sum(rows) == 400_000 and len(rare) == 16 and sum(still) == 360_000
    assert max(rare) <= 2 * median(rare) and max(still) <= 2 * median(still)
    assert joined.where("v is not null and key = -1").count() == 320_000
