"""Ingest dates: parsing on the driver and year/month/day columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import as_column


def parse_iso_date(text: str) -> date:
    """A ``YYYY-MM-DD`` argument as a date; raises ValueError on anything else."""
    return datetime.strptime(text, "%Y-%m-%d").date()


def date_parts(value: str | Column) -> dict[str, Column]:
    """year, month and day of a date or timestamp column, as ints."""
    moment = as_column(value)
    return {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}


def path_text(value: str | Column) -> Column:
    """Zero-padded directory text of a date, such as ``year=2024/month=05/day=14``."""
    parts = date_parts(value)
    return F.concat(
        F.lit("year="), F.lpad(parts["year"].cast("string"), 4, "0"),
        F.lit("/month="), F.lpad(parts["month"].cast("string"), 2, "0"),
        F.lit("/day="), F.lpad(parts["day"].cast("string"), 2, "0"),
    )
