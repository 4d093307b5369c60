"""Thirteen products and five country records that hit every rule and edge case."""

from datetime import date
from types import SimpleNamespace

from larder.plans import bronze, gold, silver
from larder.sources.lake import read_dated
from larder.sources.scratch import store

DAY = date(2024, 5, 14)

_PRODUCT_HEADER = [
    "code", "product_name", "countries_en", "main_category", "nutrition_grade_fr",
    "nutrition-score-fr_100g", "energy_100g", "fat_100g", "saturated-fat_100g", "sugars_100g",
    "fiber_100g", "proteins_100g", "salt_100g", "additives_n", "additives_tags", "brands",
]
_PRODUCTS = [
    ["001", "Choco bar", "France,Spain", " Snacks ", "e", "20", "2200", "30", "18", "55.5", "", "6", "0.2", "2", "en:e322,en:e476", "b"],
    ["002", "Cola", "France, Atlantis", "Beverages", "E", "18", "180", "0", "0", "10.6", "0", "0", "0.02", "1", " en:e330 , en:e338,", "b"],
    ["003", "Lentils", "Spain", "Legumes", "a", "-4", "1400", "1", "0.2", "2", "11", "25", "0.01", "0", "", "b"],
    ["004", "   ", "France", "Snacks", "c", "5", "100", "1", "0", "1", "1", "1", "0", "0", "", "b"],
    ["005", "Mystery", "France", "Snacks", "", "", "100", "1", "0", "1", "1", "1", "0", "0", "", "b"],
    ["006", "Weird", "France", "Snacks", "z", "3", "100", "1", "0", "1", "1", "1", "0", "0", "", "b"],
    ["007", "Too sweet", "France", "Snacks", "d", "12", "100", "1", "0", "120", "1", "1", "0", "0", "", "b"],
    ["008", "Neg fat", "France", "Snacks", "d", "12", "100", "-1", "0", "20", "1", "1", "0", "0", "", "b"],
    ["009", "Water", "", "Beverages", "b", "0", "", "", "", "", "", "", "", "0", "", "b"],
    ["001", "Choco bar (old)", "France", "Snacks", "D", "15", "2100", "29", "17", "50", "1", "6", "0.2", "3.0", "en:e322", "b"],
    ["010", "Biscuit", "SPAIN,spain", "snacks", "D", "14", "2000", "20", "9", "55.5", "3", "7", "0.7", "1", "en:e322", "b"],
    ["011", "Uncat", "Germany", "", "C", "6", "900", "5", "2", "12", "2", "4", "0.5", "1", "en:e330", "b"],
    ["012", "Bad num", "France", "Snacks", "C", "x", "900", "abc", "2", "7", "2", "4", "0.5", "1.0", '""', "b"],
]
_COUNTRIES = """Country,Region,Population,Area (sq. mi.),Pop. Density (per sq. mi.)
"France ",WESTERN EUROPE,60876136,547030,"111,3"
" Spain",WESTERN EUROPE,40397842,504782,"80,0"
Germany,WESTERN EUROPE,82422299,357021,"230,9"
FRANCE,DUP,1,1,"0,5"
Japan,ASIA,127463611,377835,n/a
"""


def write_files(folder):
    products, countries = f"{folder}/products.tsv", f"{folder}/countries.csv"
    with open(products, "w", encoding="utf-8") as file:
        file.writelines("\t".join(row) + "\n" for row in [_PRODUCT_HEADER, *_PRODUCTS])
    with open(countries, "w", encoding="utf-8") as file:
        file.write(_COUNTRIES)
    return products, countries


def build(spark, folder):
    products, countries = write_files(folder)
    result = SimpleNamespace(folder=folder)
    result.product_metrics = bronze.ingest_products(spark, products, f"{folder}/bronze_p", DAY)
    result.country_metrics = bronze.ingest_countries(spark, countries, f"{folder}/bronze_c", DAY)
    result.bronze = read_dated(spark, f"{folder}/bronze_p", DAY)
    result.products = silver.clean_products(result.bronze)
    result.countries = store(
        silver.clean_countries(read_dated(spark, f"{folder}/bronze_c", DAY)), "golden_countries"
    )
    result.enriched = store(silver.enrich(result.products, result.countries), "golden_enriched")
    result.sugar = gold.sugar_mart(result.enriched, 2)
    result.grade = gold.grade_mart(result.enriched)
    result.additive = gold.additive_mart(result.enriched)
    result.feature = gold.feature_mart(result.enriched)
    return result
