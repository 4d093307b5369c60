"""Joins of large fact tables to dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import percent_of
from larder.functions.text import as_column
from larder.operators.shape import explode_items
from larder.sources.scratch import store

#: Frequent keys that are split off at most, counters of the sketch that proposes them, and
#: dimension rows of such a key at most; so at most ``HEAVY * ROWS_PER_KEY`` rows are broadcast.
HEAVY, COUNTERS, ROWS_PER_KEY = 1024, 16384, 16


def join_dimension(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Left outer join that keeps every fact row; both key columns stay.

    There is no broadcast hint for the dimension: a stored one has a known size, and Spark
    broadcasts it up to ``spark.sql.autoBroadcastJoinThreshold``.  A larger one would be
    joined by a shuffle on the key, where a frequent key, or the many rows without one, end
    in a single task; so it is joined by ``split_join``.  Where the session forbids broadcasts
    (-1), every dimension is joined by a shuffle, split by adaptive execution at most.
    """
    if _needs_split(dimension):
        return split_join(fact, dimension, fact_key, dimension_key)
    return fact.join(dimension, fact[fact_key] == dimension[dimension_key], "left")


def _needs_split(dimension: DataFrame) -> bool:
    """Whether the planner takes ``dimension`` for larger than what it may broadcast."""
    most = dimension.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= most < int(dimension._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def split_join(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """``join_dimension`` for a dimension of any size and a fact of any skew.

    Rows without a key match nothing and do not move.  Frequent keys, proposed by a
    frequent-items sketch of the fact's keys, meet a broadcast of their few dimension rows;
    those that the dimension does not know, the empty text say, have none, and their rows do
    not move either.  All other keys are rare and are joined by a shuffle.  A key with more
    than ``ROWS_PER_KEY`` dimension rows counts as rare, since its result is large anyway.

    Which keys are split off affects the plan only.  The fact is read three times: give a
    stored one, or one that is cheap to derive from one.
    """
    facts = fact.toDF(*(f"_f{i}" for i in range(len(fact.columns))))
    rows = dimension.toDF(*(f"_d{i}" for i in range(len(dimension.columns))))
    key, other = f"_f{fact.columns.index(fact_key)}", f"_d{dimension.columns.index(dimension_key)}"

    frequent = store(frequent_keys(facts.select(key).dropna(), key), "frequent_keys")
    per_key = rows.join(F.broadcast(frequent), rows[other] == frequent["key"])  # HEAVY rows at most
    many = per_key.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > ROWS_PER_KEY)
    hot = store(frequent.join(many, "key", "left_anti"), "hot_keys")
    hot_rows = store(rows.join(F.broadcast(hot), rows[other] == hot["key"], "left_semi"), "hot_rows")

    is_hot = facts[key] == hot["key"]
    still = facts.join(F.broadcast(hot), is_hot, "left").where(F.col("key").isNotNull() | F.col(key).isNull())
    still = still.drop("key").join(F.broadcast(hot_rows), F.col(key) == hot_rows[other], "left")
    rare = facts.dropna(subset=[key]).join(F.broadcast(hot), is_hot, "left_anti")
    rare = rare.hint("merge").join(rows, F.col(key) == rows[other], "left")
    return still.unionByName(rare).toDF(*fact.columns, *dimension.columns)


def frequent_keys(keys: DataFrame, key: str) -> DataFrame:
    """The keys (``key``) that a sketch gives a ``HEAVY``-th of the rows or more; it never gives too few."""
    top = keys.agg(F.expr(f"approx_top_k({key}, {HEAVY}, {COUNTERS})").alias("top"), F.count("*").alias("rows"))
    top = top.select("rows", F.explode("top").alias("top")).where(F.col("top.count") * HEAVY >= F.col("rows"))
    return top.select(F.col("top.item").alias("key")).dropna()


def join_listed_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    list_column: str,
    item_column: str,
    dimension_key: str,
) -> DataFrame:
    """One row per listed item, joined to the dimension.

    Facts without a list keep one row.  Empty and repeated items keep theirs: the
    former never match, the latter count again.
    """
    items = explode_items(fact, list_column, item_column, keep_missing=True, keep_empty=True)
    return join_dimension(items, dimension, item_column, dimension_key)


def keep_matched(joined: DataFrame, dimension_key: str) -> DataFrame:
    return joined.where(F.col(dimension_key).isNotNull())


def match_rate(joined: DataFrame, dimension_key: str) -> DataFrame:
    """One row: total, matched, unmatched and matched percent, in a single aggregate."""
    counts = joined.agg(F.count("*").alias("total"), F.count(dimension_key).alias("matched"))
    return counts.select(
        "total",
        "matched",
        (F.col("total") - F.col("matched")).alias("unmatched"),
        percent_of(F.col("matched"), F.col("total"), 4).alias("matched_pct"),
    )
