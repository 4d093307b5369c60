"""Queries over the marts: filters, pages, summaries and samples.

Grades and country names match in any case; an empty filter text means no filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.aggregates import distinct_values, group_summary, mean_of_means
from larder.operators.ordering import Page, page_of, sample_rows, top_k
from larder.operators.predicates import (
    all_of,
    at_least_if_given,
    equal_if_given,
    equal_ignoring_case_if_given,
    equal_upper_if_given,
)
from larder.operators.ranking import ordering
from larder.schemas import FEATURE_MEANS


def sugar_page(
    mart: DataFrame,
    page: int = 1,
    limit: int = 50,
    category: str | None = None,
    min_sugars: float | None = None,
    grade: str | None = None,
) -> Page:
    wanted = all_of(
        equal_if_given("category", category)
        + at_least_if_given("sugars_100g", min_sugars)
        + equal_upper_if_given("nutrition_grade_fr", grade)
    )
    return page_of(mart.where(wanted), ordering("category", "sugar_rank_in_category"), page, limit)


def sugar_categories(mart: DataFrame) -> DataFrame:
    """Distinct categories; count them with ``row_count``."""
    return distinct_values(mart, "category")


def grade_page(
    mart: DataFrame,
    page: int = 1,
    limit: int = 50,
    country: str | None = None,
    region: str | None = None,
    grade: str | None = None,
) -> Page:
    """Best mean score first; countries without a score come last.

    The mart has one row per country and grade, so the filters on country and region,
    which ignore case, read it whole.
    """
    wanted = all_of(
        equal_ignoring_case_if_given("country", country)
        + equal_ignoring_case_if_given("region", region)
        + equal_upper_if_given("nutrition_grade_fr", grade)
    )
    order = ordering("avg_nutriscore_score", "country", "region", "nutrition_grade_fr")
    return page_of(mart.where(wanted), order, page, limit)


def grade_summary(mart: DataFrame) -> DataFrame:
    """Country rows per grade and the mean of their mean scores."""
    summary = mean_of_means(
        mart.where(F.col("nutrition_grade_fr").isNotNull()),
        "nutrition_grade_fr",
        "avg_nutriscore_score",
        "count",
        "global_avg_score",
    )
    return summary.withColumnRenamed("nutrition_grade_fr", "grade").orderBy("grade")


def additive_page(mart: DataFrame, page: int = 1, limit: int = 50) -> Page:
    """The stored rank is the place in the order, so a page is a range of it."""
    return page_of(mart, ordering("rank_overall"), page, limit, place="rank_overall")


def top_additives(mart: DataFrame, n: int) -> DataFrame:
    if not 1 <= n <= 100:
        raise ValueError("n must be 1 to 100")
    return top_k(mart, ordering("rank_overall"), n)


def feature_page(
    mart: DataFrame, page: int = 1, limit: int = 100, after: str | None = None
) -> Page:
    """By code, which is unique; ``after`` is the last code of the page before, if it is known."""
    return page_of(mart, ordering("code"), page, limit, max_limit=1000, key="code", after=after)


def feature_means(mart: DataFrame) -> DataFrame:
    """Products and rounded feature means per grade."""
    summary = group_summary(
        mart.where(F.col("nutrition_grade_fr").isNotNull()),
        ["nutrition_grade_fr"],
        means=FEATURE_MEANS,
        count_name="count",
        digits=2,
    )
    return summary.withColumnRenamed("nutrition_grade_fr", "grade").orderBy("grade")


def feature_sample(mart: DataFrame, n: int = 10, seed: int = 0) -> DataFrame:
    if not 1 <= n <= 100:
        raise ValueError("n must be 1 to 100")
    return sample_rows(mart, "code", n, seed)
