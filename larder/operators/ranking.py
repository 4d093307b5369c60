"""Deterministic ranks, duplicate removal and top-n.

Orders are lists of columns that together leave no ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import as_column
from larder.operators.joins import frequent_keys
from larder.operators.shape import partitions_for
from larder.sources.scratch import store

WINDOW_ROWS = 2_000_000  # larger groups are split over several tasks

_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"

_STEP_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition below bit 33


def ordering(*columns: str) -> list[Column]:
    """Sort columns with NULLs last; a leading ``-`` sorts descending."""
    return [
        as_column(c[1:]).desc_nulls_last() if c.startswith("-") else as_column(c).asc_nulls_last()
        for c in columns
    ]


def total_order(df: DataFrame, *first: str) -> list[Column]:
    """``first``, then every remaining column: rows that still tie are identical."""
    named = {c.lstrip("-") for c in first}
    return ordering(*first, *(c for c in df.columns if c not in named))


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str
) -> DataFrame:
    """First ``n`` rows of each group, with their rank.

    Up to the session's group limit threshold Spark plans the rank filter as a group limit
    that also runs before the shuffle, so a task sends at most ``n`` rows per key however
    frequent the key is.  Larger cuts are taken from a full ranking that splits large
    groups.
    """
    if n > int(df.sparkSession.conf.get(_GROUP_LIMIT)):
        ranked = rank_in_group(df, keys, order, rank).where(F.col(rank) <= n)
        return ranked.withColumn(rank, F.col(rank).cast("int"))
    window = Window.partitionBy(*(as_column(k) for k in keys)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key; all NULL keys count as one key."""
    return top_n_per_group(df, keys, order, 1, "_place").drop("_place")


def keep_one_of_rare(
    df: DataFrame, key: str, order: Sequence[Column], partitions: int | None = None
) -> DataFrame:
    """``keep_one`` on one key that seldom repeats: rows are dealt by key first and sorted once.

    Sorting wide rows before the shuffle, as the group limit does, then drops next to nothing
    and needs memory for all rows of a task.  Here the number of partitions follows the size of
    the input.  Frequent keys, proposed by a sketch, and NULL keep the group limit, so no task
    gathers more than a small share of the rows; which keys these are affects the plan only.
    The frame is read three times: give a stored one.
    """
    partitions = partitions or partitions_for(df)
    column = as_column(key)
    found = frequent_keys(df.select(column.alias("_key")).dropna(), "_key").select(F.col("key").alias("_hot"))
    hot = store(found, "frequent_keys")
    known = df.where(column.isNotNull())
    rare = known.join(F.broadcast(hot), column == F.col("_hot"), "left_anti").repartition(partitions, column)
    often = known.join(F.broadcast(hot), column == F.col("_hot"), "left_semi")
    often = often.unionByName(df.where(column.isNull()))
    return keep_one(rare, [key], order).unionByName(keep_one(often, [key], order))


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str,
    skip_null_groups: bool = False,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Row number of every row within its group, as a long; a NULL key is a group too.

    A window gathers each group into one task.  Groups of more than ``window_rows`` rows,
    of which there are at most rows / ``window_rows``, are therefore ranked across tasks, and
    all others by a window; the ranks do not depend on ``window_rows``.  The frame is read
    once for the group sizes and once for each way: give a stored one.
    """
    if skip_null_groups:
        df = df.dropna(subset=list(keys))
    if not keys:
        return _rank_across_tasks(df, keys, order, rank)
    names = [f"_hot{i}" for i in range(len(keys))]
    hot = store(
        df.groupBy(*(as_column(k).alias(n) for k, n in zip(keys, names)))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > window_rows)
        .select(*names),
        "large_groups",
    )
    window = Window.partitionBy(*(as_column(k) for k in keys)).orderBy(*order)
    number = F.row_number().over(window).cast("bigint")
    if hot.isEmpty():
        return df.withColumn(rank, number)
    is_hot = [as_column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    large = _rank_across_tasks(df.join(hot, is_hot, "left_semi"), keys, order, rank)
    return df.join(hot, is_hot, "left_anti").withColumn(rank, number).unionByName(large)


def rank_overall(df: DataFrame, order: Sequence[Column], rank: str) -> DataFrame:
    """Row number over the whole frame, as a long, ranked across tasks."""
    return _rank_across_tasks(df, [], order, rank)


def _rank_across_tasks(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str
) -> DataFrame:
    """Ranks without gathering a group.

    Rows are range-partitioned by group and order, so a large group spans several tasks,
    and each row notes its place in its partition.  Two small tables turn places into
    ranks: the rows before each partition, one row per partition, and the first position
    of each group.  The sorted rows are stored once, since a second evaluation could
    draw other range bounds.
    """
    columns = df.columns
    groups = [as_column(k).asc_nulls_first() for k in keys]
    placed = store(
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "ranked",
    ).select(
        *(as_column(c) for c in columns),
        F.shiftright("_id", _STEP_BITS).alias("_part"),
        F.col("_id").bitwiseAND((1 << _STEP_BITS) - 1).alias("_step"),
    )

    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = store(
        sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")),
        "partition_starts",
    )
    positions = placed.join(starts, "_part").withColumn("_position", F.col("_before") + F.col("_step"))

    kept = [as_column(c) for c in columns]
    if not keys:
        return positions.select(*kept, (F.col("_position") + 1).alias(rank))
    # The start of a group is noted beside each partition that holds a part of it, so that
    # the join below splits a large group as its partitions do.
    names = [f"_group{i}" for i in range(len(keys))]
    parts = store(
        positions.groupBy("_part", *(as_column(k).alias(n) for k, n in zip(keys, names)))
        .agg(F.min("_position").alias("_start")),
        "group_parts",
    )
    whole = [f"_whole{i}" for i in range(len(keys))]
    firsts = parts.groupBy(*(F.col(n).alias(w) for n, w in zip(names, whole))).agg(
        F.min("_start").alias("_first")
    )
    same = [F.col(n).eqNullSafe(F.col(w)) for n, w in zip(names, whole)]
    starts_of_groups = store(
        parts.join(firsts, same).select(F.col("_part").alias("_in"), *names, "_first"), "group_starts"
    )
    same_part = [
        F.col("_part") == F.col("_in"),
        *(as_column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)),
    ]
    return positions.join(starts_of_groups, same_part).select(
        *kept, (F.col("_position") - F.col("_first") + 1).alias(rank)
    )
