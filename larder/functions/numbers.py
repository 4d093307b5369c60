"""Number expressions that give NULL instead of failing on malformed input.

Sessions run in ANSI mode by default, where a plain cast or division raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import as_column


def lenient_double(value: str | Column) -> Column:
    return as_column(value).try_cast("double")


def lenient_long(value: str | Column) -> Column:
    """Whole part of a number or numeric text, exact up to the largest long.

    The fraction is cut off as text, so no number of decimals rounds it up.
    """
    text = as_column(value).cast("string")
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(F.nullif(whole, F.lit("")), text).try_cast("decimal(38,18)").try_cast("bigint")


def lenient_int(value: str | Column) -> Column:
    """Whole part of a number or numeric text: '3', '3.0' and '3.7' all give 3."""
    return as_column(value).try_cast("double").try_cast("int")


def comma_decimal(value: str | Column) -> Column:
    """Decimal-comma text as a double; '1.234,5' has two points after the swap, so NULL."""
    return F.translate(as_column(value).cast("string"), ",", ".").try_cast("double")


def typed_null(kind) -> Column:
    return F.lit(None).cast(kind)


def percent_of(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole`` in percent; NULL when ``whole`` is zero."""
    share = F.try_divide(part, whole) * 100
    return share if digits is None else F.round(share, digits)
