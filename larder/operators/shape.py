"""Column-level reshaping: select, cast, rename, stamp."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import lenient_int, list_items, typed_null
from larder.functions.text import as_column

log = logging.getLogger(__name__)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name, cast leniently.

    Malformed values become NULL, absent columns typed NULLs, other columns are
    dropped, so a columnar or CSV source reads the named columns only.
    """
    present = set(df.columns)
    absent = [f.name for f in schema.fields if f.name not in present]
    if absent:
        log.warning("source lacks columns, filled with NULL: %s", ", ".join(absent))

    def cast(field: T.StructField) -> Column:
        if field.name not in present:
            value = typed_null(field.dataType)
        elif isinstance(field.dataType, T.StringType):
            value = as_column(field.name).cast("string")
        elif isinstance(field.dataType, T.IntegerType):
            value = lenient_int(field.name)
        else:
            value = as_column(field.name).try_cast(field.dataType)
        return value.alias(field.name)

    return df.select(*(cast(field) for field in schema.fields))


def stamp_date(df: DataFrame, ingest_date: date) -> DataFrame:
    """Append constant year, month and day columns."""
    return df.withColumns(
        {part: F.lit(getattr(ingest_date, part)) for part in ("year", "month", "day")}
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present; absent names are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def replace_columns(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Overwrite columns in place, skipping those the frame lacks."""
    present = set(df.columns)
    return df.withColumns({name: value for name, value in changes.items() if name in present})


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select under new names: target name to source column or expression."""
    return df.select(*(as_column(source).alias(target) for target, source in columns.items()))


def with_null_column(df: DataFrame, name: str, kind) -> DataFrame:
    """Stand-in for an optional column that could not be computed."""
    return df.withColumn(name, typed_null(kind))


#: Bytes of stored input for each partition of a shuffle of wide rows; in memory it is some 25 times as much.
PART_BYTES, MOST_PARTS = 4 << 20, 10_000


def partitions_for(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Partitions for a shuffle of ``df``, in proportion to the files it is read from."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return min(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // part_bytes)), MOST_PARTS)


def explode_items(
    df: DataFrame,
    source: str,
    target: str,
    separator: str = ",",
    keep_missing: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per trimmed item of a delimited column.

    ``keep_missing`` keeps a row with a NULL item for a NULL list; ``keep_empty`` keeps
    the empty items that doubled or trailing separators give.
    """
    items = list_items(source, separator)
    spread = F.explode_outer(items) if keep_missing else F.explode(items)
    result = df.withColumn(target, spread).withColumn(target, F.trim(as_column(target)))
    return result if keep_empty else result.where(F.col(target).isNull() | (F.col(target) != ""))
