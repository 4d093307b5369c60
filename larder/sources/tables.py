"""Catalog databases and managed tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from larder.functions.text import as_column
from larder.operators.shape import stamp_date
from larder.schemas import DATE_COLUMNS
from larder.sources.lake import replace_date, stage_date
from larder.sources.staging import check_same, next_table


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tables_exist(spark: SparkSession, names: Iterable[str]) -> dict[str, bool]:
    return {name: spark.catalog.tableExists(name) for name in names}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace the whole managed table, schema included; it is not partitioned."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def publish_twice(df: DataFrame, path: str, table: str, ingest_date: date) -> int:
    """Publish all rows of ``df`` under ``ingest_date``: to the dated path, and to the table.

    The path keeps every date, the table holds this one alone.  The date goes in as
    constants, which spares the sort by partition columns before the write.  The next
    version of the table is filled from the files just written, so ``df`` is computed once,
    and compared with them.  Only then do both copies change, under one commit marker: a run
    that fails before leaves both as they were, one that stops later is finished by the next.
    Returns the rows written, counted from the Parquet footers.
    """
    spark = df.sparkSession
    stamped = stamp_date(df, ingest_date)
    columns = [as_column(c) for c in stamped.columns]
    replacement = replace_date(spark, path, ingest_date)
    drop_table(spark, next_table(table))
    try:
        stage_date(stamped, replacement)
        files = spark.read.schema(stamped.drop(*DATE_COLUMNS).schema).parquet(replacement.folder)
        written = stamp_date(files, ingest_date).select(*columns)
        overwrite_table(written, next_table(table))
        rows = check_same(written, spark.table(next_table(table)), table)
    except Exception:
        replacement.drop()
        drop_table(spark, next_table(table))
        raise
    replacement.commit(table)
    return rows


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
