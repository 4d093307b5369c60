"""Text expressions.  Spark's ``trim`` strips the ASCII space only; that is wanted here."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    """A column from a name; names may hold dashes, dots and parentheses."""
    if isinstance(value, Column):
        return value
    return F.col("`" + value.replace("`", "``") + "`")


def normal_lower(value: str | Column) -> Column:
    return F.lower(F.trim(as_column(value)))


def normal_upper(value: str | Column) -> Column:
    return F.upper(F.trim(as_column(value)))


def is_present(value: str | Column, trimmed: bool = True) -> Column:
    """Neither NULL nor empty; with ``trimmed`` a run of spaces counts as empty."""
    column = as_column(value)
    return column.isNotNull() & ((F.trim(column) if trimmed else column) != "")


def list_items(value: str | Column, separator: str = ",") -> Column:
    """A delimited text as an array; empty items are kept, NULL stays NULL."""
    return F.split(as_column(value), re.escape(separator))
