"""Catalogue-shaped inputs derived from the star-schema test tables.

Each lineitem row is one product listing, each customer nation and market segment one
country record.  Missing, blank, malformed, out-of-range, repeated and padded values
come from fixed CASE expressions.  The expressions are plain SQL valid in Spark and in
the oracle engine, so both sides start from the same raw text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST_DATE = date(2024, 5, 14)

# Small whole numbers behind a listing: quantity, discount and tax in percent.
LISTING_NUMBERS = {
    "q": "cast(l_quantity as int)",
    "d": "cast(round(l_discount * 100) as int)",
    "t": "cast(round(l_tax * 100) as int)",
}

# Raw product columns that need the lineitem row only.
MEASURE_COLUMNS = {
    "code": "case when q = 1 and l_returnflag = 'R' then null"
    " else cast(l_partkey as string) || '-' || cast(l_suppkey as string) end",
    "nutrition_grade_fr": "case l_linenumber when 1 then 'a' when 2 then ' B' when 3 then 'C '"
    " when 4 then 'd' when 5 then 'E'"
    " when 6 then case when l_linestatus = 'O' then '  ' else 'z' end else null end",
    "nutrition-score-fr_100g": "case when d = 3 then 'x' else cast(q - 15 as string) end",
    "energy_100g": "cast(q * 50 - 100 as string)",
    "fat_100g": "case when d = 10 then 'abc' else cast(d - 1 as string) end",
    "saturated-fat_100g": "cast(t as string) || '.25'",
    "sugars_100g": "case when t = 4 and l_returnflag = 'N' then null else cast(q * 2 as string) || '.5' end",
    "fiber_100g": "case when d = 2 then null else cast(t as string) || '.5' end",
    "proteins_100g": "cast((q * 3) % 40 as string) || '.75'",
    "salt_100g": "case when d = 9 and l_returnflag = 'R' then '-0.5' else cast(d as string) || '.5' end",
    "additives_n": "case when l_linestatus = 'O' then cast(t as string) || '.0' else cast(t as string) end",
}

# Columns that need the part row.
PART_COLUMNS = {
    "product_name": "case when d = 0 and l_linestatus = 'O' then '   '"
    " when d = 10 and l_linestatus = 'O' then null else p_name end",
    "categories_en": "p_type || ',' || p_brand",
    "main_category": "case when d = 5 and l_returnflag = 'A' then null"
    " when d = 5 and l_returnflag = 'N' then ' '"
    " when l_linestatus = 'O' then ' ' || p_type || ' ' else lower(p_type) end",
    "additives_tags": "case when t = 1 then null when t = 2 then ''"
    " when t = 3 then ' en:' || replace(p_name, ' ', ' , en:') || ','"
    " else 'en:' || replace(p_name, ' ', ',en:') end",
    "brands": "p_brand",
}

# The column that needs the supplier's nation and a second one.
NATION_COLUMNS = {
    "countries_en": "case when t = 0 then null when t = 8 then ''"
    " when l_returnflag = 'R' then home_name || ', Atlantis'"
    " when l_returnflag = 'A' then home_name || ',' || away_name || ','"
    " when l_linestatus = 'F' then home_name || ', ' || home_name else lower(home_name) end",
}

RAW_PRODUCT_COLUMNS = {**MEASURE_COLUMNS, **PART_COLUMNS, **NATION_COLUMNS}

# Raw country columns over n_name, n_nationkey, r_name, r_regionkey, segment, customers, balance.
RAW_COUNTRY_COLUMNS = {
    "Country": "case segment when 'MACHINERY' then ' ' || n_name when 'FURNITURE' then lower(n_name)"
    " when 'HOUSEHOLD' then n_name || ' ' else n_name end",
    "Region": "case segment when 'BUILDING' then r_name || '  ' else r_name end",
    "Population": "cast(customers * 1000 as string)",
    "Area (sq. mi.)": "cast(n_nationkey * 100 + customers as string)",
    "Pop. Density (per sq. mi.)": "replace(cast(balance as string), '.', ',')",
    "Coastline (coast/area ratio)": "case segment when 'AUTOMOBILE' then 'n/a'"
    " else cast(n_nationkey as string) || ',5' end",
    "Net migration": "'-' || cast(n_nationkey as string) || ',25'",
    "Infant mortality (per 1000 births)": "case segment when 'FURNITURE' then '1.234,5'"
    " else cast(customers as string) || ',75' end",
    "GDP ($ per capita)": "cast(customers * 7 as string)",
    "Literacy (%)": "cast(n_nationkey + 50 as string) || ',5'",
    "Phones (per 1000)": "cast(customers as string) || ',0'",
    "Arable (%)": "cast(n_nationkey as string) || ',1'",
    "Crops (%)": "cast(n_nationkey as string) || ',2'",
    "Other (%)": "cast(n_nationkey as string) || ',3'",
    "Climate": "cast(r_regionkey as string)",
    "Birthrate": "cast(n_nationkey as string) || ',4'",
    "Deathrate": "cast(n_nationkey as string) || ',6'",
    "Agriculture": "'0,' || cast(n_nationkey as string)",
    "Industry": "'0,5'",
    "Service": "'0,25'",
}


# Types of the test tables; stating them saves a file-listing job per read.
TABLE_TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_TYPES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(sql).alias(name) for name, sql in columns.items()))


def raw_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, grades and measures of the listings, from lineitem alone."""
    return _select(
        table(spark, sf_dir, "lineitem").withColumns({n: F.expr(sql) for n, sql in LISTING_NUMBERS.items()}), MEASURE_COLUMNS
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw product columns.

    Part and supplier grow with the data and are joined as Spark sizes them; nation has
    25 rows at every scale.
    """
    nation = table(spark, sf_dir, "nation")
    home = nation.select(F.col("n_nationkey").alias("home_key"), F.col("n_name").alias("home_name"))
    away = nation.select(F.col("n_nationkey").alias("away_key"), F.col("n_name").alias("away_name"))
    listings = (
        table(spark, sf_dir, "lineitem")
        .withColumns({n: F.expr(sql) for n, sql in LISTING_NUMBERS.items()})
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(home, F.col("s_nationkey") == F.col("home_key"))
        .join(away, (F.col("s_nationkey") + F.col("l_linenumber")) % 25 == F.col("away_key"))
    )
    return _select(listings, RAW_PRODUCT_COLUMNS)


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five spellings of each nation, one per market segment of its customers."""
    segments = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey", F.col("c_mktsegment").alias("segment"))
        .agg(
            F.count("*").alias("customers"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("decimal(18,2)").alias("balance"),
        )
    )
    named = segments.join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return _select(named, RAW_COUNTRY_COLUMNS)
