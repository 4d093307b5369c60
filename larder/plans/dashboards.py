"""Data behind the dashboard visuals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.aggregates import group_summary
from larder.operators.exact import exact_means
from larder.operators.predicates import all_of


def _slice(df: DataFrame, **choices: Iterable[str] | None) -> DataFrame:
    """Rows matching every slicer that has a choice."""
    return df.where(all_of(F.col(c).isin(*v) for c, v in choices.items() if v))


def score_by_country(
    grades: DataFrame, grade: Iterable[str] | None = None, region: Iterable[str] | None = None
) -> DataFrame:
    """Map: mean of the mean scores per country."""
    chosen = _slice(grades, nutrition_grade_fr=grade, region=region)
    return exact_means(chosen, ["country"], {"avg_score": "avg_nutriscore_score"}, {})


def sugar_by_product(
    sugar: DataFrame, category: Iterable[str] | None = None, max_rank: int = 10
) -> DataFrame:
    """Bars and table: the ranked products of the chosen categories."""
    return _slice(sugar, category=category).where(F.col("sugar_rank_in_category") <= max_rank)


def frequent_additives(additives: DataFrame, max_rank: int = 20) -> DataFrame:
    """Bars: occurrences of the most frequent additives."""
    return additives.where(F.col("rank_overall") <= max_rank).select(
        "rank_overall", "additive_tag", "total_occurrences"
    )


def additive_shares(additives: DataFrame, max_rank: int = 10) -> DataFrame:
    """Ring: percentage per additive."""
    return additives.where(F.col("rank_overall") <= max_rank).select("additive_tag", "pct_of_total")


def additive_kpis(additives: DataFrame) -> DataFrame:
    """Cards: number of additives and the most frequent one."""
    first = F.max(F.when(F.col("rank_overall") == 1, F.col("additive_tag")))
    return additives.agg(F.count("additive_tag").alias("nb_additives"), first.alias("top_additive"))


def products_per_grade(features: DataFrame) -> DataFrame:
    return group_summary(features, ["nutrition_grade_fr"], count_name="nb_products")


def feature_scatter(
    features: DataFrame, grade: Iterable[str] | None = None, category: Iterable[str] | None = None
) -> DataFrame:
    """Points: sugar against energy, sized by fat, coloured by grade."""
    return _slice(features, nutrition_grade_fr=grade, main_category=category).select(
        "sugars_100g", "energy_100g", "fat_100g", "nutrition_grade_fr"
    )


def feature_kpis(
    features: DataFrame, grade: Iterable[str] | None = None, category: Iterable[str] | None = None
) -> DataFrame:
    """Cards: mean sugar, energy and protein of the chosen products."""
    chosen = _slice(features, nutrition_grade_fr=grade, main_category=category)
    means = {"avg_sugars": "sugars_100g", "avg_energy": "energy_100g", "avg_proteins": "proteins_100g"}
    return exact_means(chosen, [], means, {})
