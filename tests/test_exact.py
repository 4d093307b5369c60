"""Means from exact sums: equal bits for any partitioning, and right ones."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from larder.operators.aggregates import group_summary
from larder.operators.exact import exact_means
from larder.sources.scratch import store


def mixed(seed, n=4000):
    draw = random.Random(seed)
    kinds = {
        "tenths": lambda: draw.randrange(1, 1000) / 10,
        "mixed": lambda: draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randrange(-300, 300),
        "small": lambda: draw.random() * 1e-9,
        "cancel": lambda: draw.choice([1e16, -1e16, 1.0, 0.1, 1e-12]),
        "tiny": lambda: draw.randrange(1, 50) * 5e-324,
        "borders": lambda: 2.0 ** draw.randrange(-60, 60) * draw.choice([1, 1 - 2**-53, 1 + 2**-52]),
    }
    names = list(kinds)
    return [(names[i % len(names)], None if draw.random() < 0.05 else kinds[names[i % len(names)]](), i) for i in range(n)]


def decimal_value(x):
    """The number a value stands for in the sums: its shortest decimal if that has 18 places."""
    shortest = Fraction(repr(x))
    return shortest if abs(x) < 1e9 and (shortest * 10**18).denominator == 1 else Fraction(x)


@pytest.fixture(scope="module")
def values(spark):
    rows = mixed(1)
    return rows, store(spark.createDataFrame(rows, "k string, v double, i long"), "values")


def test_equal_bits_at_any_width(spark, setting, values):
    rows, df = values
    found = set()
    for width in (1, 3, 17):
        setting("spark.sql.shuffle.partitions", str(width))
        setting("spark.sql.adaptive.enabled", "false")
        means = group_summary(df.repartition(width, "i"), ["k"], {"m": "v"}, counted="v")
        found.add(frozenset((r.k, r.rows, r.m.hex()) for r in means.collect()))
    assert len(found) == 1


def test_means_are_right(values):
    rows, df = values
    for r in exact_means(df, ["k"], {"m": "v"}, {"n": "*", "filled": "v"}).collect():
        mine = [v for k, v, _ in rows if k == r.k]
        filled = [decimal_value(v) for v in mine if v is not None]
        exact = sum(filled) / len(filled)
        assert (r.n, r.filled) == (len(mine), len(filled))
        assert math.isclose(r.m, float(exact), rel_tol=4e-16, abs_tol=5e-324), (r.k, r.m, float(exact))


def test_plain_values_round_once(spark):
    df = spark.createDataFrame([(x / 10,) for x in (501, 505, 507, 509)] * 10, "v double")
    assert exact_means(df, [], {"m": "v"}, {}).first().m == 50.55


@pytest.mark.parametrize(
    "numbers, expected",
    [
        ([1.0, math.inf], math.inf),
        ([math.inf, -math.inf, 1e300], math.nan),
        ([math.nan, 1.0], math.nan),
        ([None, None], None),
        ([], None),
        ([1.7e308, 1.7e308], math.inf),
        ([-0.0, 0.0], 0.0),
        ([1e300, -1e300, 3.0], 1.0),
    ],
)
def test_odd_values(spark, numbers, expected):
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    got = exact_means(df, [], {"m": "v"}, {}).first().m
    assert got == expected or (expected is not None and math.isnan(expected) and math.isnan(got))


def test_several_means_null_keys_and_odd_names(spark):
    rows = [(None, 1.5, 2, "x"), (None, 2.5, None, None), ("a", None, 7, "y")]
    df = spark.createDataFrame(rows, "`the.key` string, `v 1` double, `n-2` int, s string")
    means = {"m.1": "v 1", "m-2": "n-2"}
    got = {tuple(r) for r in exact_means(df, ["the.key"], means, {"rows": "*", "named": "s"}).collect()}
    assert got == {(None, 2, 1, 2.0, 2.0), ("a", 1, 1, None, 7.0)}
    assert exact_means(df.limit(0), ["the.key"], means, {"rows": "*"}).collect() == []


def test_both_plans_give_equal_bits_on_plain_values(values):
    tenths = values[1].where("k = 'tenths'")
    both = [
        [(r.k, r.n, r.m.hex()) for r in exact_means(tenths, ["k"], {"m": "v"}, {"n": "v"}, plain).collect()]
        for plain in (True, False, None)
    ]
    assert both[0] == both[1] == both[2]


def test_whole_numbers(spark):
    rows = [("a", 9007199254740993), ("a", 1), ("a", None), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {tuple(r) for r in exact_means(df, ["k"], {"m": "v"}, {"n": "*"}).collect()}
    assert got == {("a", 3, 4503599627370497.0), ("b", 1, None)}


def test_sums_combine_before_the_shuffle(values):
    plan = group_summary(values[1], ["k"], {"m": "v"})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_sum" in plan
