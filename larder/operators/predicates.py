"""Row conditions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import as_column


def all_of(conditions: Iterable[Column]) -> Column:
    """Conjunction; no condition at all is true."""
    return reduce(and_, conditions, F.lit(True))


def one_of(value: str | Column, allowed: Iterable) -> Column:
    return as_column(value).isin(*allowed)


def within_or_null(value: str | Column, low: float, high: float) -> Column:
    column = as_column(value)
    return column.isNull() | column.between(low, high)


def at_least_or_null(value: str | Column, low: float) -> Column:
    """NaN sorts above every number, so it passes here and fails ``within_or_null``."""
    column = as_column(value)
    return column.isNull() | (column >= low)


def on_date(ingest_date: date) -> Column:
    """Equality on the three partition columns, which Spark turns into partition pruning."""
    return (
        (F.col("year") == ingest_date.year)
        & (F.col("month") == ingest_date.month)
        & (F.col("day") == ingest_date.day)
    )


def equal_if_given(column: str, value: str | None) -> list[Column]:
    """``column = value``, or no condition for None and the empty text."""
    return [F.col(column) == value] if value else []


def equal_upper_if_given(column: str, value: str | None) -> list[Column]:
    """For columns that are upper-case by contract; a plain comparison reaches the scan."""
    return [F.col(column) == value.upper()] if value else []


def equal_ignoring_case_if_given(column: str, value: str | None) -> list[Column]:
    """For columns of small tables: the scan cannot filter by it."""
    return [F.lower(column) == F.lower(F.lit(value))] if value else []


def at_least_if_given(column: str, low: float | None) -> list[Column]:
    """``column >= low``; zero is a real bound, and any bound drops NULLs."""
    return [F.col(column) >= low] if low is not None else []
