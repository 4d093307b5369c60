"""Raw files to bronze: typed columns, one folder per ingest date."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators.ordering import first_by
from larder.operators.quality import volume_gate
from larder.operators.ranking import total_order
from larder.operators.shape import conform, stamp_date
from larder.schemas import MIN_ROWS_COUNTRIES, MIN_ROWS_PRODUCTS, PRODUCT_SCHEMA
from larder.sources.delimited import read_text_table
from larder.sources.lake import dated_folder, read_dated, write_date


def bronze_products(raw: DataFrame, ingest_date: date) -> DataFrame:
    return stamp_date(conform(raw, PRODUCT_SCHEMA), ingest_date)


def bronze_countries(raw: DataFrame, ingest_date: date) -> DataFrame:
    """Country columns keep their source names, and stay text until silver casts them.

    Types inferred per file would differ between dates and make one of them unreadable.
    """
    return stamp_date(raw, ingest_date)


def sample_by_code(df: DataFrame, rows: int) -> DataFrame:
    """A repeatable development sample: the first rows by code."""
    return first_by(df, "code", total_order(df, "code"), rows)


def ingest_products(
    spark: SparkSession,
    source: str,
    target: str,
    ingest_date: date,
    sep: str = "\t",
    encoding: str = "utf-8",
    sample_rows: int | None = None,
) -> dict:
    """Write the product file to ``target`` and return the run's metrics."""
    raw, read = _counted(read_text_table(spark, source, sep, encoding))
    products = conform(raw, PRODUCT_SCHEMA)
    if sample_rows is not None:
        products = sample_by_code(products, sample_rows)
    return _ingest(stamp_date(products, ingest_date), read, target, ingest_date)


def ingest_countries(
    spark: SparkSession,
    source: str,
    target: str,
    ingest_date: date,
    sep: str = ",",
    encoding: str = "utf-8",
) -> dict:
    raw, read = _counted(read_text_table(spark, source, sep, encoding))
    return _ingest(bronze_countries(raw, ingest_date), read, target, ingest_date)


def _counted(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """``raw`` and the count of its rows, taken by the first job that reads it."""
    read = Observation()
    return raw.observe(read, F.count(F.lit(1)).alias("rows")), read


def _ingest(df: DataFrame, read: Observation, target: str, ingest_date: date) -> dict:
    """Write once, then count what is on disk from the Parquet footers."""
    started = time.monotonic()
    write_date(df, target, ingest_date)
    written = read_dated(df.sparkSession, target, ingest_date, df.schema).count()
    return {
        "rows_read": read.get["rows"],
        "rows_written": written,
        "output_path": dated_folder(target, ingest_date),
        "duration_seconds": round(time.monotonic() - started, 1),
    }


def check_volumes(
    spark: SparkSession,
    targets: dict[str, str],
    ingest_date: date,
    sample_rows: int | None = None,
    min_rows: dict[str, int] | None = None,
) -> DataFrame:
    """Verdict per source (``products``, ``countries``) for one ingest date.

    ``min_rows`` replaces the usual minimum of the sources it names.

    A sample run is held to the sample size where that is below the usual minimum.
    """
    least = {"products": MIN_ROWS_PRODUCTS, "countries": MIN_ROWS_COUNTRIES, **(min_rows or {})}
    if sample_rows is not None:
        least["products"] = min(least["products"], sample_rows)
    return volume_gate(
        {name: (read_dated(spark, path, ingest_date), least[name]) for name, path in targets.items()}
    )
