"""Bronze to silver: cleaned products and countries, their join, profiles and ranks."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import comma_decimal, is_present, lenient_long, normal_lower, normal_upper
from larder.functions.text import as_column
from larder.operators.aggregates import group_summary, item_frequency
from larder.operators.joins import join_listed_dimension, keep_matched, match_rate
from larder.operators.ordering import top_k
from larder.operators.predicates import all_of, at_least_or_null, one_of, within_or_null
from larder.operators.quality import Rule, apply_rules, rule_funnel
from larder.operators.ranking import (
    keep_one,
    keep_one_of_rare,
    ordering,
    rank_in_group,
    total_order,
)
from larder.operators.shape import (
    drop_if_present,
    explode_items,
    rename,
    replace_columns,
    with_null_column,
)
from larder.plans.bronze import sample_by_code
from larder.plans.runner import RunReport
from larder.schemas import (
    COUNTRY_COMMA_COLUMNS,
    COUNTRY_RENAMES,
    COUNTRY_SCHEMA,
    COUNTRY_WHOLE_COLUMNS,
    DATE_COLUMNS,
    GRADES,
    PRODUCT_RENAMES,
    PRODUCT_SCHEMA,
    SILVER_TABLES,
    TOP_PER_CATEGORY,
)
from larder.sources.lake import read_dated
from larder.sources.scratch import store
from larder.sources.tables import ensure_database, publish_twice, tables_exist

log = logging.getLogger(__name__)


def product_rules() -> list[Rule]:
    """Row rules in the order they are charged; duplicates are removed after them."""
    return [
        Rule("product_name", is_present("product_name")),
        Rule("nutrition_grade", one_of(normal_upper("nutrition_grade_fr"), GRADES)),
        Rule(
            "nutrition_ranges",
            all_of(
                [
                    within_or_null("sugars_100g", 0, 100),
                    at_least_or_null("fat_100g", 0),
                    at_least_or_null("salt_100g", 0),
                    at_least_or_null("energy_100g", 0),
                ]
            ),
        ),
    ]


def clean_products(bronze: DataFrame) -> DataFrame:
    """Valid products, one per code.

    Rules come before duplicate removal, so an invalid version never hides a valid one.
    Among valid versions the first by product name, then by every other column, stays.
    """
    valid = apply_rules(rename(bronze, PRODUCT_RENAMES), product_rules())
    single = keep_one_of_rare(valid, "code", total_order(valid, "product_name"))
    return replace_columns(
        single,
        {
            "nutrition_grade_fr": normal_upper("nutrition_grade_fr"),
            "countries_en": normal_lower("countries_en"),
            "main_category": normal_lower("main_category"),
        },
    )


def clean_countries(bronze: DataFrame) -> DataFrame:
    """Countries under snake-case names, one per normalised name: the most populous."""
    typed = replace_columns(
        rename(bronze, COUNTRY_RENAMES),
        {
            **{c: comma_decimal(c) for c in COUNTRY_COMMA_COLUMNS},
            **{c: lenient_long(c) for c in COUNTRY_WHOLE_COLUMNS},
            "country": F.trim(as_column("country").cast("string")),
            "region": F.trim(as_column("region").cast("string")),
        },
    ).withColumn("country_normalized", normal_lower("country"))
    return keep_one(typed, ["country_normalized"], total_order(typed, "-population", "country"))


def enrich(products: DataFrame, countries: DataFrame) -> DataFrame:
    """One row per product and listed country, with the country's columns where known."""
    return join_listed_dimension(
        products,
        drop_if_present(countries, DATE_COLUMNS),
        "countries_en",
        "country_single",
        "country_normalized",
    )


def with_sugar_rank(enriched: DataFrame, skip_null_groups: bool = False) -> DataFrame:
    """Rank of every enriched row in its category by sugar.

    Codes are unique in the cleaned products, so rows still tied after the country are
    repeats of one listing and interchangeable.
    """
    return rank_in_group(
        enriched,
        ["main_category"],
        ordering("-sugars_100g", "code", "country_single"),
        "sugar_rank_in_category",
        skip_null_groups,
    )


def category_profile(enriched: DataFrame) -> DataFrame:
    return group_summary(
        enriched.where(is_present("main_category", trimmed=False)),
        ["main_category"],
        means={
            "avg_sugars_100g": "sugars_100g",
            "avg_fat_100g": "fat_100g",
            "avg_salt_100g": "salt_100g",
            "avg_energy_kj_100g": "energy_100g",
        },
        counted="code",
        count_name="product_count",
    )


def country_grade_profile(enriched: DataFrame) -> DataFrame:
    return group_summary(
        keep_matched(enriched, "country_normalized"),
        ["country", "nutrition_grade_fr"],
        means={"avg_nutriscore_score": "nutriscore_score"},
        counted="code",
        count_name="product_count",
    )


def additive_items(enriched: DataFrame, item: str) -> DataFrame:
    return explode_items(
        enriched.where(is_present("additives_tags", trimmed=False)), "additives_tags", item
    )


def additive_profile(enriched: DataFrame) -> DataFrame:
    return item_frequency(
        additive_items(enriched, "additive"), "additive", "main_category", "occurrence", "nb_categories"
    )


def quality_report(bronze: DataFrame, enriched: DataFrame, top_n: int = TOP_PER_CATEGORY) -> dict[str, DataFrame]:
    """Small tables that describe a run: what was rejected, matched and found most.

    ``enriched`` is the stored table with its sugar rank.
    """
    ranked = enriched.where(
        (F.col("sugar_rank_in_category") <= top_n) & F.col("sugars_100g").isNotNull()
    ).select("main_category", "product_name", "sugars_100g", "sugar_rank_in_category")
    return {
        "rejected rows": rule_funnel(bronze, product_rules(), ["code"]),
        "countries matched": match_rate(enriched, "country_normalized"),
        "largest categories": top_k(
            category_profile(enriched), ordering("-product_count", "main_category"), 5
        ),
        "most frequent additives": top_k(
            additive_profile(enriched), ordering("-occurrence", "additive"), 10
        ),
        "most sugary products": top_k(
            ranked, ordering("main_category", "sugar_rank_in_category"), 10
        ),
    }


def refine(
    spark: SparkSession,
    bronze_products_path: str,
    bronze_countries_path: str,
    silver_path: str,
    database: str,
    ingest_date: date,
    sample_rows: int | None = None,
) -> RunReport:
    """Build and publish the three silver tables of one ingest date; reports their rows.

    Each table is stored before the next is built from it, and the enriched rows before
    they are ranked, so nothing is computed twice and a lost executor costs the work of the
    running step only.  Where ranking or its write fails, the enriched rows go out with NULL
    ranks, and the report holds the error.
    """
    ensure_database(spark, database)
    paths = {name: f"{silver_path}/{name}" for name in SILVER_TABLES}
    report = RunReport()

    def publish(name: str, df: DataFrame) -> DataFrame:
        report.results[name] = publish_twice(df, paths[name], f"{database}.{name}", ingest_date)
        return read_dated(spark, paths[name], ingest_date, df.schema)

    raw = read_dated(spark, bronze_products_path, ingest_date, PRODUCT_SCHEMA)
    if sample_rows is not None:
        raw = sample_by_code(raw, sample_rows)
    products = publish("products_clean", clean_products(raw))
    countries = publish(
        "countries_clean", clean_countries(read_dated(spark, bronze_countries_path, ingest_date, COUNTRY_SCHEMA))
    )
    enriched = store(enrich(products, countries), "enriched")
    try:
        publish("products_enriched", with_sugar_rank(enriched))
    except Exception as error:
        log.exception("sugar rank failed; the enriched table goes out without it")
        report.errors["sugar_rank_in_category"] = str(error)
        publish("products_enriched", with_null_column(enriched, "sugar_rank_in_category", "bigint"))
    listed = tables_exist(spark, [f"{database}.{name}" for name in SILVER_TABLES])
    report.errors.update({name: "not in the catalog" for name, found in listed.items() if not found})
    return report
