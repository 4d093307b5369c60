"""Silver to gold: the four marts, their publication and export."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import is_present, lenient_int
from larder.operators.aggregates import group_summary, item_frequency, with_percent_of_rows
from larder.operators.quality import contract_report, schema_problems
from larder.operators.ranking import (
    keep_one,
    ordering,
    rank_overall,
    top_n_per_group,
    total_order,
)
from larder.operators.shape import project
from larder.plans.runner import RunReport, run_steps
from larder.plans.silver import additive_items
from larder.schemas import (
    MART_LOOKUP_COLUMNS,
    MART_SCHEMAS,
    MART_SORT_KEYS,
    MART_UNIQUE_KEYS,
    TOP_PER_CATEGORY,
)
from larder.sources.export import export_csv
from larder.sources.jdbc import Database, write_jdbc
from larder.sources.lake import write_clustered
from larder.sources.scratch import store
from larder.sources.staging import STAGING, drop_folder, put_in_place


def sugar_mart(enriched: DataFrame, n: int = TOP_PER_CATEGORY) -> DataFrame:
    """The ``n`` most sugary products of each category."""
    listed = enriched.where(is_present("main_category", trimmed=False)).select(
        "code", "main_category", "product_name", "sugars_100g", "nutrition_grade_fr"
    )
    products = keep_one(
        listed, ["code", "main_category"], total_order(listed, "product_name")
    )
    ranked = top_n_per_group(
        products,
        ["main_category"],
        total_order(products, "-sugars_100g", "code"),
        n,
        "sugar_rank_in_category",
    )
    return project(
        ranked,
        {
            "category": "main_category",
            "product_name": "product_name",
            "sugars_100g": "sugars_100g",
            "nutrition_grade_fr": "nutrition_grade_fr",
            "sugar_rank_in_category": "sugar_rank_in_category",
        },
    )


def grade_mart(enriched: DataFrame) -> DataFrame:
    """Products and mean score per country, region and grade."""
    known = enriched.where(F.col("country").isNotNull() & F.col("nutrition_grade_fr").isNotNull())
    return group_summary(
        known,
        ["country", "region", "nutrition_grade_fr"],
        means={"avg_nutriscore_score": "nutriscore_score"},
        counted="code",
        count_name="nb_products",
    )


def additive_mart(enriched: DataFrame) -> DataFrame:
    """Additives by frequency; the percentage is of all enriched rows, tagged or not.

    The frequencies are stored before they are ranked, so they are counted up once.
    """
    frequency = store(
        item_frequency(
            additive_items(enriched, "additive_tag"),
            "additive_tag",
            "main_category",
            "total_occurrences",
            "nb_distinct_categories",
        ),
        "additive_frequency",
    )
    ranked = rank_overall(frequency, ordering("-total_occurrences", "additive_tag"), "rank_overall")
    return with_percent_of_rows(
        ranked.withColumn("rank_overall", F.col("rank_overall").cast("int")),
        "total_occurrences",
        enriched,
        "pct_of_total",
    )


def feature_mart(enriched: DataFrame) -> DataFrame:
    """One row of features and target grade per product, for its first country by name.

    A product's rows differ in their country only, so the country settles the choice.
    """
    names = MART_SCHEMAS["dm_ml_nutriscore_prediction"].names
    features = project(
        enriched.where(F.col("nutrition_grade_fr").isNotNull()),
        {name: lenient_int(name) if name == "additives_n" else name for name in names},
    )
    return keep_one(features, ["code"], ordering("country_normalized"))


def mart_builders(top_n: int = TOP_PER_CATEGORY) -> dict[str, Callable[[DataFrame], DataFrame]]:
    return {
        "dm_sugar_by_category": lambda enriched: sugar_mart(enriched, top_n),
        "dm_nutriscore_by_country": grade_mart,
        "dm_additives_analysis": additive_mart,
        "dm_ml_nutriscore_prediction": feature_mart,
    }


def publish_marts(
    enriched: DataFrame,
    path: str,
    only: Iterable[str] | None = None,
    database: Database | None = None,
    top_n: int = TOP_PER_CATEGORY,
) -> RunReport:
    """Build each mart once into clustered Parquet under ``path``, then copy it to ``database``.

    Marts are independent: one that fails is reported and the others still go out.  A mart is
    written beside the one of the run before and takes its place only if it keeps its
    contract: schema, and keys that do not repeat.
    ``enriched`` should be the stored silver table.
    """
    spark = enriched.sparkSession

    def step(name: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[], int]:
        def run() -> int:
            mart = build(enriched)
            problems = schema_problems(mart, MART_SCHEMAS[name])
            if problems:
                raise ValueError(f"{name}: {'; '.join(problems)}")
            lookup, *spread = MART_LOOKUP_COLUMNS[name]
            staged = f"{path}/{STAGING}"
            try:
                write_clustered(mart, f"{staged}/{name}", lookup, spread)
                _refuse_repeated_keys(read_mart(spark, staged, name), name)
            except Exception:
                drop_folder(spark, f"{staged}/{name}")
                raise
            put_in_place(spark, f"{staged}/{name}", f"{path}/{name}")
            stored = read_mart(spark, path, name)
            if database is not None:
                write_jdbc(stored, database, name)
            return stored.count()

        return run

    return run_steps({n: step(n, b) for n, b in mart_builders(top_n).items()}, only)


def _refuse_repeated_keys(stored: DataFrame, name: str) -> None:
    keys = MART_UNIQUE_KEYS.get(name)
    if keys:
        repeated = contract_report({name: stored}, MART_SCHEMAS, {name: keys}).first()["repeated_keys"]
        if repeated:
            raise ValueError(f"{name}: {repeated} rows repeat a key of {', '.join(keys)}")


def read_mart(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(MART_SCHEMAS[name]).parquet(f"{path}/{name}")


def ordered_mart(spark: SparkSession, path: str, name: str) -> DataFrame:
    return read_mart(spark, path, name).orderBy(*ordering(*MART_SORT_KEYS[name]))


def export_marts(
    spark: SparkSession,
    path: str,
    output: str,
    only: Iterable[str] | None = None,
    single_file: bool = False,
) -> RunReport:
    """Export the stored marts as ordered CSV, one folder each; with ``single_file`` one file each."""
    steps = {
        name: lambda name=name: export_csv(
            read_mart(spark, path, name), f"{output}/{name}", MART_SORT_KEYS[name], single_file
        )
        for name in MART_SCHEMAS
    }
    return run_steps(steps, only)
