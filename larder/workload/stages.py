"""The pipeline's stored stages over the test tables.

Bronze, silver and gold are each written once per application, from the stage before,
and read by every query that starts there, as a deployed pipeline does.  Products and
enriched rows are bucketed by code: the shuffle that removes duplicates is the last one that
wide rows go through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.operators import shape
from larder.operators.shape import partitions_for
from larder.plans import bronze, gold, silver
from larder.schemas import PRODUCT_SCHEMA
from larder.sources import lake
from larder.sources.scratch import store, store_bucketed
from larder.workload.inputs import INGEST_DATE, raw_countries, raw_measures, raw_products

_stored: dict[tuple[str, str, str], DataFrame] = {}


def _once(
    spark: SparkSession,
    sf_dir: str,
    stage: str,
    build: Callable[[], DataFrame],
    keep: Callable[[DataFrame, str], DataFrame] = store,
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    if key not in _stored:
        _stored[key] = keep(build(), stage)
    return _stored[key]


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "bronze_products",
        lambda: bronze.bronze_products(raw_products(spark, sf_dir), INGEST_DATE),
    )


def bronze_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "bronze_countries",
        lambda: bronze.bronze_countries(raw_countries(spark, sf_dir), INGEST_DATE),
    )


def write_bronze(spark: SparkSession, sf_dir: str, products: str, countries: str) -> None:
    """Both bronze sources, as the ingest jobs write them: a date's own folder needs no sort by date."""
    lake.write_date(bronze.bronze_products(raw_products(spark, sf_dir), INGEST_DATE), products, INGEST_DATE)
    lake.write_date(bronze.bronze_countries(raw_countries(spark, sf_dir), INGEST_DATE), countries, INGEST_DATE)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed codes, grades and measures straight from lineitem; not stored."""
    raw = raw_measures(spark, sf_dir)
    wanted = [field for field in PRODUCT_SCHEMA.fields if field.name in set(raw.columns)]
    return shape.conform(raw, type(PRODUCT_SCHEMA)(wanted))


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze_products(spark, sf_dir)
    return _once(
        spark, sf_dir, "products_clean", lambda: silver.clean_products(raw),
        lambda df, stage: store_bucketed(df, stage, "code", partitions_for(raw)),
    )


def clean_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "countries_clean", lambda: silver.clean_countries(bronze_countries(spark, sf_dir))
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze_products(spark, sf_dir)
    return _once(
        spark, sf_dir, "products_enriched",
        lambda: silver.enrich(clean_products(spark, sf_dir), clean_countries(spark, sf_dir)),
        lambda df, stage: store_bucketed(df, stage, "code", partitions_for(raw)),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched rows, joined as they are read and not stored.

    For results that need few of their columns: the products are stored, the dimension is small, and
    writing the wide rows once for each listed country costs more than all else that such a result does.
    """
    return silver.enrich(clean_products(spark, sf_dir), clean_countries(spark, sf_dir))


def sugar_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "mart_sugar", lambda: gold.sugar_mart(enriched(spark, sf_dir)))


def grade_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "mart_grade", lambda: gold.grade_mart(enriched(spark, sf_dir)))


def additive_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "mart_additive", lambda: gold.additive_mart(listings(spark, sf_dir)))


def feature_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "mart_feature", lambda: gold.feature_mart(enriched(spark, sf_dir)))
