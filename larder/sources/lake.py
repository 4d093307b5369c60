"""Parquet datasets partitioned by ingest date, and mart files laid out for lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.predicates import on_date
from larder.schemas import DATE_COLUMNS
from larder.sources.staging import Replacement


def write_dated(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Replace only the ingest dates present in ``df``; other dates stay.

    ``rebalance`` gathers the rows of each date before writing when ``df`` spans many
    dates, so a date does not get one small file per task.  It is adaptive: a date too
    large for one task is split over several.
    """
    if rebalance:
        df = df.hint("rebalance", *DATE_COLUMNS)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DATE_COLUMNS)
        .parquet(path)
    )


def write_date(df: DataFrame, path: str, ingest_date: date) -> None:
    """Replace one ingest date by ``df``, with no rows too; other dates stay.

    The date's own folder is written, date columns of ``df`` aside, so a run without rows
    leaves an empty date and its schema instead of the rows of the run before.  The rows are
    written beside the date and take its place when they are complete: a run that fails
    leaves the rows of the run before.
    """
    replacement = replace_date(df.sparkSession, path, ingest_date)
    try:
        stage_date(df, replacement)
    except Exception:
        replacement.drop()
        raise
    replacement.commit()


def replace_date(spark: SparkSession, path: str, ingest_date: date) -> Replacement:
    """A replacement of the date, after finishing or dropping what an earlier run left."""
    replacement = Replacement(spark, path, ingest_date, dated_folder(path, ingest_date))
    replacement.settle()
    return replacement


def stage_date(df: DataFrame, replacement: Replacement) -> None:
    df.drop(*DATE_COLUMNS).write.mode("overwrite").parquet(replacement.folder)


def read_dated(
    spark: SparkSession, path: str, ingest_date: date, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of one ingest date; the date is a partition filter, other folders are not listed into tasks.

    Give the declared ``schema`` of the columns (date columns aside or not) wherever it is
    known: without it Spark infers the types from a file of any date.
    """
    if schema is None:
        return spark.read.parquet(path).where(on_date(ingest_date))
    columns = [f for f in schema.fields if f.name not in DATE_COLUMNS]
    dates = [T.StructField(name, T.IntegerType()) for name in DATE_COLUMNS]
    return spark.read.schema(T.StructType(columns + dates)).parquet(path).where(on_date(ingest_date))


def dated_folder(path: str, ingest_date: date) -> str:
    """Folder Spark writes for a date; partition values are plain ints, not padded."""
    return f"{path}/year={ingest_date.year}/month={ingest_date.month}/day={ingest_date.day}"


def write_clustered(df: DataFrame, path: str, column: str, spread: Sequence[str] = ()) -> None:
    """Write ``df`` so that each file covers a narrow range of ``column``.

    Parquet min/max statistics then let a lookup on ``column`` skip most files.  The
    ``spread`` columns come second in the range key, so one frequent value of
    ``column`` can still fill several files.
    """
    keys = [F.col(column).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in spread)]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
