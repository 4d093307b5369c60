"""Grouped counts, means and shares.  All combine partially before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import percent_of
from larder.functions.text import as_column
from larder.operators.exact import exact_means


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def group_summary(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, str] | None = None,
    counted: str | None = None,
    count_name: str = "rows",
    digits: int | None = None,
) -> DataFrame:
    """Count and means per group.

    ``means`` maps output to input column; a mean ignores NULL.  It is taken from exact sums,
    so it has the same bits for any partitioning of the rows.  ``counted`` counts the
    non-NULL values of that column, else all rows.  ``digits`` rounds the means.
    """
    counts = {count_name: counted or "*"}
    if not means:
        return df.groupBy(*keys).agg(F.count(counted or "*").alias(count_name))
    summary = exact_means(df, keys, means, counts)
    if digits is None:
        return summary
    return summary.withColumns({target: F.round(as_column(target), digits) for target in means})


def item_frequency(
    items: DataFrame, item: str, distinct: str, count_name: str, distinct_name: str
) -> DataFrame:
    """Occurrences per item and the distinct non-NULL values of another column beside it."""
    return items.groupBy(item).agg(
        F.count("*").alias(count_name), F.count_distinct(distinct).alias(distinct_name)
    )


def class_share(df: DataFrame, key: str, count_name: str = "rows", digits: int | None = None) -> DataFrame:
    """Rows per class and their percentage of all rows.

    The total is a scalar subquery over the class counts, so the input is read once and
    no window gathers the classes into one task.
    """
    counts = df.groupBy(key).agg(F.count("*").alias(count_name))
    total = counts.agg(F.sum(count_name)).scalar()
    return counts.withColumn("pct", percent_of(F.col(count_name), total, digits))


def with_percent_of_rows(
    df: DataFrame, part: str, whole: DataFrame, target: str, digits: int = 4
) -> DataFrame:
    """``part`` in percent of the row count of ``whole``, a scalar subquery."""
    total = whole.agg(F.count("*")).scalar()
    return df.withColumn(target, percent_of(F.col(part), total, digits))


def mean_of_means(
    df: DataFrame, key: str, mean: str, count_name: str, mean_name: str, digits: int = 2
) -> DataFrame:
    """Groups and the unweighted average of their means, per outer key."""
    return group_summary(
        df, [key], means={mean_name: mean}, count_name=count_name, digits=digits
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def labelled_counts(frames: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """One row per frame: its label and row count."""
    rows = [
        row_count(frame).select(F.lit(name).alias(label), "rows") for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, rows)
