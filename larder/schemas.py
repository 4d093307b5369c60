"""Column names, types and thresholds of the catalogue data model."""

from pyspark.sql import types as T

_TEXT, _REAL, _INT, _LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


# Columns kept from the raw product file, with the type each is cast to.
PRODUCT_SCHEMA = _struct(
    ("code", _TEXT),
    ("product_name", _TEXT),
    ("countries_en", _TEXT),
    ("categories_en", _TEXT),
    ("main_category", _TEXT),
    ("nutrition_grade_fr", _TEXT),
    ("nutrition-score-fr_100g", _REAL),
    ("energy_100g", _REAL),
    ("fat_100g", _REAL),
    ("saturated-fat_100g", _REAL),
    ("sugars_100g", _REAL),
    ("fiber_100g", _REAL),
    ("proteins_100g", _REAL),
    ("salt_100g", _REAL),
    ("additives_n", _INT),
    ("additives_tags", _TEXT),
)

# Dashed product columns and the names they carry from silver on.
PRODUCT_RENAMES = {
    "nutrition-score-fr_100g": "nutriscore_score",
    "saturated-fat_100g": "saturated_fat_100g",
}

GRADES = ("A", "B", "C", "D", "E")

# Raw country file header and the silver column names.
COUNTRY_RENAMES = {
    "Country": "country",
    "Region": "region",
    "Population": "population",
    "Area (sq. mi.)": "area_sq_mi",
    "Pop. Density (per sq. mi.)": "pop_density",
    "Coastline (coast/area ratio)": "coastline_ratio",
    "Net migration": "net_migration",
    "Infant mortality (per 1000 births)": "infant_mortality",
    "GDP ($ per capita)": "gdp_per_capita",
    "Literacy (%)": "literacy_pct",
    "Phones (per 1000)": "phones_per_1000",
    "Arable (%)": "arable_pct",
    "Crops (%)": "crops_pct",
    "Other (%)": "other_pct",
    "Climate": "climate",
    "Birthrate": "birthrate",
    "Deathrate": "deathrate",
    "Agriculture": "agriculture",
    "Industry": "industry",
    "Service": "service",
}

COUNTRY_SCHEMA = _struct(*((name, _TEXT) for name in COUNTRY_RENAMES))

COUNTRY_WHOLE_COLUMNS = ("population", "area_sq_mi", "gdp_per_capita")

# Written with a decimal comma in the raw country file.
COUNTRY_COMMA_COLUMNS = (
    "pop_density",
    "coastline_ratio",
    "net_migration",
    "infant_mortality",
    "literacy_pct",
    "phones_per_1000",
    "arable_pct",
    "crops_pct",
    "other_pct",
    "birthrate",
    "deathrate",
    "agriculture",
    "industry",
    "service",
)

DATE_COLUMNS = ("year", "month", "day")

# Table names.
SILVER_TABLES = ("products_clean", "countries_clean", "products_enriched")

MART_SCHEMAS = {
    "dm_sugar_by_category": _struct(
        ("category", _TEXT),
        ("product_name", _TEXT),
        ("sugars_100g", _REAL),
        ("nutrition_grade_fr", _TEXT),
        ("sugar_rank_in_category", _INT),
    ),
    "dm_nutriscore_by_country": _struct(
        ("country", _TEXT),
        ("region", _TEXT),
        ("nutrition_grade_fr", _TEXT),
        ("nb_products", _LONG),
        ("avg_nutriscore_score", _REAL),
    ),
    "dm_additives_analysis": _struct(
        ("additive_tag", _TEXT),
        ("total_occurrences", _LONG),
        ("nb_distinct_categories", _LONG),
        ("rank_overall", _INT),
        ("pct_of_total", _REAL),
    ),
    "dm_ml_nutriscore_prediction": _struct(
        ("code", _TEXT),
        ("sugars_100g", _REAL),
        ("fat_100g", _REAL),
        ("saturated_fat_100g", _REAL),
        ("salt_100g", _REAL),
        ("energy_100g", _REAL),
        ("proteins_100g", _REAL),
        ("fiber_100g", _REAL),
        ("additives_n", _INT),
        ("main_category", _TEXT),
        ("country_normalized", _TEXT),
        ("population", _LONG),
        ("area_sq_mi", _LONG),
        ("nutrition_grade_fr", _TEXT),
    ),
}

# Means reported per grade: output name and mart column.
FEATURE_MEANS = {
    "avg_energy": "energy_100g",
    "avg_fat": "fat_100g",
    "avg_sugars": "sugars_100g",
    "avg_proteins": "proteins_100g",
    "avg_fiber": "fiber_100g",
    "avg_salt": "salt_100g",
    "avg_additives": "additives_n",
}

MART_UNIQUE_KEYS = {"dm_ml_nutriscore_prediction": ("code",)}

# Export order of each mart.
MART_SORT_KEYS = {
    "dm_sugar_by_category": ("category", "sugar_rank_in_category"),
    "dm_nutriscore_by_country": ("country", "nutrition_grade_fr"),
    "dm_additives_analysis": ("rank_overall",),
    "dm_ml_nutriscore_prediction": ("code",),
}

# Columns readers look marts up by.
MART_LOOKUP_COLUMNS = {
    "dm_sugar_by_category": ("category", "sugar_rank_in_category", "nutrition_grade_fr"),
    "dm_nutriscore_by_country": ("country", "region", "nutrition_grade_fr"),
    "dm_additives_analysis": ("rank_overall", "additive_tag"),
    "dm_ml_nutriscore_prediction": ("nutrition_grade_fr", "main_category", "code"),
}

# Volume gate and report sizes.
MIN_ROWS_PRODUCTS = 200_000
MIN_ROWS_COUNTRIES = 200
INGEST_SAMPLE_ROWS = 10_000
REFINE_SAMPLE_ROWS = 50_000
TOP_PER_CATEGORY = 10
JDBC_BATCH_ROWS = 10_000
