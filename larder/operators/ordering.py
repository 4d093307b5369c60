"""Sorted extracts: top-k, pages and samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import as_column
from larder.operators.ranking import rank_overall


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def first_by(df: DataFrame, key: str, order: Sequence[Column], n: int, one_in: int = 64) -> DataFrame:
    """First ``n`` rows in ``order``, which begins with ``key``, without gathering ``n`` rows of every task.

    The keys whose hash falls in one of ``one_in`` classes show about where the n-th row
    lies; only rows up to that key are sorted, and the key is moved on while it leaves
    fewer than ``n``.  Where there are not enough keys to tell, the frame is small itself.
    """
    wanted = 4 * n // one_in + 100
    sampled = df.where(F.crc32(as_column(key).cast("string")) % one_in == 0).select(as_column(key).alias("k"))
    while True:
        found = sampled.orderBy("k").limit(wanted).agg(F.count("*"), F.max("k")).first()
        if found[0] < wanted:
            return top_k(df, order, n)
        upto = df.where(as_column(key) <= found[1])
        if upto.count() >= n:
            return top_k(upto, order, n)
        wanted *= 4


@dataclass(frozen=True)
class Page:
    """One page of a sorted result and the row count of the whole result."""

    page: int
    limit: int
    total: DataFrame
    items: DataFrame

    def with_total(self) -> DataFrame:
        """The items with the total beside each."""
        return self.items.withColumn("total", self.total.scalar())


NEAR_ROWS = 10_000  # rows up to here are found by a partial sort in every task


def page_of(
    df: DataFrame,
    order: Sequence[Column],
    page: int,
    limit: int,
    max_limit: int = 500,
    place: str | None = None,
    key: str | None = None,
    after=None,
) -> Page:
    """Rows ``(page - 1) * limit`` to ``page * limit`` of ``df`` in ``order``.

    ``place`` names a column that holds each row's place from 1 on: the page is a filter.
    ``after`` is the last ``key`` of the page before: the page is the next ``limit`` rows.
    Otherwise a partial sort keeps ``page * limit`` rows in every task, so pages that end
    beyond ``NEAR_ROWS`` are taken by rank across tasks instead.
    """
    if page < 1:
        raise ValueError("page starts at 1")
    if not 1 <= limit <= max_limit:
        raise ValueError(f"limit must be 1 to {max_limit}")
    first, last = (page - 1) * limit, page * limit
    if place is not None:
        items = df.where(F.col(place).between(first + 1, last)).orderBy(*order)
    elif after is not None:
        items = df.where(F.col(key) > after).orderBy(*order).limit(limit)
    elif last <= NEAR_ROWS:
        items = df.orderBy(*order).offset(first).limit(limit)
    else:
        ranked = rank_overall(df, order, "_place")
        items = ranked.where(F.col("_place").between(first + 1, last)).orderBy("_place").drop("_place")
    return Page(page=page, limit=limit, total=df.agg(F.count("*").alias("total")), items=items)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows drawn at random by a hash of key and seed; the same seed repeats the draw."""
    draw = F.md5(F.concat(F.coalesce(as_column(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")
