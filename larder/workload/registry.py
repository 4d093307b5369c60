"""Registered queries: one per operator, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import (
    comma_decimal,
    date_parts,
    is_present,
    lenient_long,
    normal_lower,
    normal_upper,
    path_text,
)
from larder.functions.text import as_column
from larder.operators import aggregates, joins, ordering, quality, ranking, reuse, shape
from larder.operators.predicates import at_least_or_null, one_of, within_or_null
from larder.operators.ranking import ordering as by
from larder.operators.ranking import total_order
from larder.plans import bronze, dashboards, gold, serving, silver
from larder.schemas import (
    COUNTRY_RENAMES,
    COUNTRY_SCHEMA,
    DATE_COLUMNS,
    GRADES,
    MART_LOOKUP_COLUMNS,
    MART_SCHEMAS,
    MART_UNIQUE_KEYS,
    PRODUCT_SCHEMA,
    SILVER_TABLES,
)
from larder.sources import lake, tables
from larder.sources.delimited import read_text_table, read_typed_table
from larder.sources.scratch import new_path, store
from larder.workload import stages
from larder.workload.inputs import (
    INGEST_DATE,
    raw_countries,
    raw_measures,
    raw_products,
    table,
)
from larder.workload.oracle import mean, with_stages

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str


REGISTRY: dict[str, Registered] = {}


def registered(name: str, sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        REGISTRY[name] = Registered(run, with_stages(sql))
        return run

    return add


# Sources and sinks ----------------------------------------------------------------------


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under the first day of their quarter as ingest date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    parts = date_parts(F.date_trunc("quarter", "o_orderdate"))
    return orders.withColumns(parts).drop("o_orderdate")


_RERUN = date(1997, 4, 1)
_ORDERS_SQL = """
    select o_orderkey, o_custkey, o_totalprice,
           cast(year(quarter_start) as integer) as year,
           cast(month(quarter_start) as integer) as month,
           cast(day(quarter_start) as integer) as day
    from (select *, date_trunc('quarter', o_orderdate) as quarter_start from orders)"""


def _orders_written_twice(spark: SparkSession, sf_dir: str) -> str:
    """All dates, then one date again with its prices raised; returns the path."""
    path = new_path(spark, "orders_dated")
    orders = _dated_orders(spark, sf_dir)
    lake.write_dated(orders, path, rebalance=True)
    corrected = orders.where(lake.on_date(_RERUN)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    lake.write_dated(corrected, path, rebalance=True)
    return path


@registered(
    "scan_delimited_text",
    "select * replace (nullif(countries_en, '') as countries_en,"
    " nullif(additives_tags, '') as additives_tags) from raw_products",
)
def scan_delimited_text(spark, sf_dir):
    """An empty field reads as NULL, quoted or not."""
    return read_text_table(spark, _raw_product_file(spark, sf_dir)).select(
        *(as_column(c) for c in (*PRODUCT_SCHEMA.names, "brands"))
    )


def _raw_product_file(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "raw_products")
    _write_text(raw_products(spark, sf_dir), path, "\t")
    return path


def _raw_country_file(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "raw_countries")
    _write_text(raw_countries(spark, sf_dir), path, ",")
    return path


def _write_text(df: DataFrame, path: str, sep: str) -> None:
    (
        df.write.option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@registered(
    "scan_inferred_text",
    'select "Country" as country, "Region" as region, cast("Population" as bigint) as population,'
    ' cast("Area (sq. mi.)" as bigint) as area_sq_mi, "Pop. Density (per sq. mi.)" as pop_density,'
    ' cast("Climate" as integer) as climate from raw_countries',
)
def scan_inferred_text(spark, sf_dir):
    countries = read_typed_table(spark, _raw_country_file(spark, sf_dir))
    return shape.project(
        countries,
        {
            "country": "Country",
            "region": "Region",
            "population": as_column("Population").cast("bigint"),
            "area_sq_mi": as_column("Area (sq. mi.)").cast("bigint"),
            "pop_density": "Pop. Density (per sq. mi.)",
            "climate": as_column("Climate").cast("int"),
        },
    )


@registered(
    "scan_partition_date",
    f"""select * replace (case when year = 1997 and month = 4 then o_totalprice + 1
                               else o_totalprice end as o_totalprice)
        from ({_ORDERS_SQL}) where year = 1997 and month = 4 and day = 1""",
)
def scan_partition_date(spark, sf_dir):
    return lake.read_dated(spark, _orders_written_twice(spark, sf_dir), _RERUN)


@registered(
    "partition_overwrite",
    f"""select year, month, day, count(*) as orders,
               cast(sum(cast(o_totalprice + case when year = 1997 and month = 4 then 1 else 0 end
                             as decimal(18,2))) as decimal(28,2)) as price_total
        from ({_ORDERS_SQL}) group by all""",
)
def partition_overwrite(spark, sf_dir):
    stored = spark.read.parquet(_orders_written_twice(spark, sf_dir))
    return stored.groupBy(*DATE_COLUMNS).agg(
        F.count("*").alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("price_total"),
    )


def _new_database(spark: SparkSession, label: str) -> str:
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_database(spark, name, path)
    return name


@registered(
    "scan_catalog_table",
    "select c_custkey, c_name, c_acctbal, c_mktsegment, true as listed from customer",
)
def scan_catalog_table(spark, sf_dir):
    """The second overwrite replaces rows and schema of the first."""
    name = f"{_new_database(spark, 'catalog')}.customers"
    customers = table(spark, sf_dir, "customer")
    tables.overwrite_table(customers.select("c_custkey", "c_nationkey"), name)
    tables.overwrite_table(customers.drop("c_nationkey"), name)
    found = tables.tables_exist(spark, [name])[name]
    return tables.read_table(spark, name).withColumn("listed", F.lit(found))


def _stored_mart(spark: SparkSession, mart: DataFrame, name: str) -> str:
    path = new_path(spark, "marts")
    lake.write_clustered(mart, f"{path}/{name}", mart.columns[0], mart.columns[1:])
    return path


@registered("scan_ordered_mart", "select * from mart_grade")
def scan_ordered_mart(spark, sf_dir):
    name = "dm_nutriscore_by_country"
    path = _stored_mart(spark, stages.grade_mart(spark, sf_dir), name)
    return gold.ordered_mart(spark, path, name)


@registered(
    "sample_first_n",
    """select code, product_name, sugars_100g from (
         select *, row_number() over (
           order by code nulls last, product_name nulls last, countries_en nulls last,
                    categories_en nulls last, main_category nulls last, nutrition_grade_fr nulls last,
                    "nutrition-score-fr_100g" nulls last, energy_100g nulls last, fat_100g nulls last,
                    "saturated-fat_100g" nulls last, sugars_100g nulls last, fiber_100g nulls last,
                    proteins_100g nulls last, salt_100g nulls last, additives_n nulls last,
                    additives_tags nulls last) as place
         from bronze_products) where place <= 10000""",
)
def sample_first_n(spark, sf_dir):
    return bronze.sample_by_code(stages.bronze_products(spark, sf_dir), 10_000).select(
        "code", "product_name", "sugars_100g"
    )


@registered(
    "dual_write_roundtrip",
    """select 'path' as copy, 2024 as year, 5 as month, 13 as day, count(*) as rows,
              cast(sum(c_custkey) as bigint) as keys from customer
       union all select 'path', 2024, 5, 14, count(*), cast(sum(c_custkey + 1) as bigint) from customer
       union all select 'table', 2024, 5, 14, count(*), cast(sum(c_custkey + 1) as bigint) from customer""",
)
def dual_write_roundtrip(spark, sf_dir):
    """Two runs: the path keeps both dates, the table the last one."""
    path, name = new_path(spark, "dual"), f"{_new_database(spark, 'dual')}.customers"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    earlier = date(2024, 5, 13)
    later = customers.withColumn("c_custkey", F.col("c_custkey") + 1)
    tables.publish_twice(shape.stamp_date(customers, earlier), path, name, earlier)
    tables.publish_twice(shape.stamp_date(later, INGEST_DATE), path, name, INGEST_DATE)

    def summary(copy: str, df: DataFrame) -> DataFrame:
        return (
            df.groupBy(*DATE_COLUMNS)
            .agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))
            .withColumn("copy", F.lit(copy))
        )

    return summary("path", spark.read.parquet(path)).unionByName(summary("table", spark.table(name)))


@registered("export_csv_ordered", "select * from mart_sugar")
def export_csv_ordered(spark, sf_dir):
    name = "dm_sugar_by_category"
    path = _stored_mart(spark, stages.sugar_mart(spark, sf_dir), name)
    output = new_path(spark, "export")
    gold.export_marts(spark, path, output, only=[name]).raise_on_error()
    return read_typed_table(spark, f"{output}/{name}", schema=MART_SCHEMAS[name])


@registered(
    "clustered_mart_lookup",
    "select code, main_category, sugars_100g, nutrition_grade_fr from mart_feature"
    " where nutrition_grade_fr = 'C' and main_category = 'promo'",
)
def clustered_mart_lookup(spark, sf_dir):
    path = new_path(spark, "features_by_grade")
    lookup, *spread = MART_LOOKUP_COLUMNS["dm_ml_nutriscore_prediction"]
    lake.write_clustered(stages.feature_mart(spark, sf_dir), path, lookup, spread)
    return (
        spark.read.parquet(path)
        .where((F.col("nutrition_grade_fr") == "C") & (F.col("main_category") == "promo"))
        .select("code", "main_category", "sugars_100g", "nutrition_grade_fr")
    )


@registered(
    "mart_contract_check",
    """select 'dm_sugar_by_category' as mart, count(*) as rows, cast(0 as bigint) as repeated_keys,
              true as schema_ok from mart_sugar
       union all select 'dm_nutriscore_by_country', count(*), 0, true from mart_grade
       union all select 'dm_additives_analysis', count(*), 0, true from mart_additive
       union all select 'dm_ml_nutriscore_prediction', count(*), 0, true from mart_feature
       union all select 'without a column', count(*), 0, false from mart_sugar
       union all select 'written twice', 2 * count(*), count(*), true from mart_feature""",
)
def mart_contract_check(spark, sf_dir):
    """The four marts, one that lacks a column and one whose keys repeat."""
    sugar, features = "dm_sugar_by_category", "dm_ml_nutriscore_prediction"
    stored = stages.feature_mart(spark, sf_dir)
    marts = {
        sugar: stages.sugar_mart(spark, sf_dir),
        "dm_nutriscore_by_country": stages.grade_mart(spark, sf_dir),
        "dm_additives_analysis": stages.additive_mart(spark, sf_dir),
        features: stored,
    }
    broken = {
        "without a column": stages.sugar_mart(spark, sf_dir).drop("product_name"),
        "written twice": stored.unionByName(stored),
    }
    return quality.contract_report(
        {**marts, **broken},
        {**MART_SCHEMAS, "without a column": MART_SCHEMAS[sugar], "written twice": MART_SCHEMAS[features]},
        {**MART_UNIQUE_KEYS, "written twice": MART_UNIQUE_KEYS[features]},
    )


# Projections ----------------------------------------------------------------------------


@registered(
    "conform_schema",
    "select * exclude (year, month, day) replace (cast(null as double) as fiber_100g)"
    " from bronze_products",
)
def conform_schema(spark, sf_dir):
    """The source lacks one column and carries a surplus one."""
    return shape.conform(raw_products(spark, sf_dir).drop("fiber_100g"), PRODUCT_SCHEMA)


@registered(
    "add_ingest_date",
    "select o_orderkey, o_orderstatus, 2024 as year, 5 as month, 14 as day from orders",
)
def add_ingest_date(spark, sf_dir):
    return shape.stamp_date(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), INGEST_DATE
    )


@registered(
    "date_parts",
    """select o_orderkey, cast(year(o_orderdate) as integer) as year,
              cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
              strftime(o_orderdate, 'year=%Y/month=%m/day=%d') as folder
       from orders""",
)
def date_parts_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns(date_parts("o_orderdate")).select(
        "o_orderkey", *DATE_COLUMNS, path_text("o_orderdate").alias("folder")
    )


@registered(
    "rename_drop_columns",
    'select "Country" as country, "Region" as region, "Population" as population,'
    ' "Area (sq. mi.)" as area_sq_mi, "Net migration" as net_migration, "Climate" as climate'
    " from raw_countries",
)
def rename_drop_columns(spark, sf_dir):
    renamed = shape.rename(raw_countries(spark, sf_dir), {**COUNTRY_RENAMES, "Absent": "absent"})
    wanted = {"country", "region", "population", "area_sq_mi", "net_migration", "climate"}
    return shape.drop_if_present(renamed, [*sorted(set(renamed.columns) - wanted), "absent"])


@registered(
    "mart_projection",
    "select code as product_code, product_name, sugars_100g as sugar, additives_n,"
    " country_normalized as country from enriched",
)
def mart_projection(spark, sf_dir):
    return shape.project(
        stages.enriched(spark, sf_dir),
        {
            "product_code": "code",
            "product_name": "product_name",
            "sugar": "sugars_100g",
            "additives_n": "additives_n",
            "country": "country_normalized",
        },
    )


@registered(
    "normalise_text",
    "select code, upper(trim(nutrition_grade_fr)) as nutrition_grade_fr,"
    " lower(trim(main_category)) as main_category, lower(trim(countries_en)) as countries_en"
    " from raw_products",
)
def normalise_text(spark, sf_dir):
    return shape.replace_columns(
        stages.bronze_products(spark, sf_dir).select(
            "code", "nutrition_grade_fr", "main_category", "countries_en"
        ),
        {
            "nutrition_grade_fr": normal_upper("nutrition_grade_fr"),
            "main_category": normal_lower("main_category"),
            "countries_en": normal_lower("countries_en"),
        },
    )


@registered(
    "fallback_null_column",
    "select code, country_single, cast(null as integer) as sugar_rank_in_category from listed_products",
)
def fallback_null_column(spark, sf_dir):
    listed = shape.explode_items(
        stages.clean_products(spark, sf_dir), "countries_en", "country_single",
        keep_missing=True, keep_empty=True,
    )
    return shape.with_null_column(
        listed.select("code", "country_single"), "sugar_rank_in_category", "int"
    )


# Filters --------------------------------------------------------------------------------


@registered(
    "filter_not_blank",
    """select code, product_name, additives_tags from raw_products
       where product_name is not null and trim(product_name) <> ''
         and additives_tags is not null and additives_tags <> ''""",
)
def filter_not_blank(spark, sf_dir):
    return (
        stages.bronze_products(spark, sf_dir)
        .where(is_present("product_name") & is_present("additives_tags", trimmed=False))
        .select("code", "product_name", "additives_tags")
    )


@registered(
    "filter_membership",
    "select code, nutrition_grade_fr, sugars_100g from raw_products"
    " where upper(trim(nutrition_grade_fr)) in ('A', 'B', 'C', 'D', 'E')",
)
def filter_membership(spark, sf_dir):
    return (
        raw_measures(spark, sf_dir)
        .where(one_of(normal_upper("nutrition_grade_fr"), GRADES))
        .select("code", "nutrition_grade_fr", "sugars_100g")
    )


@registered(
    "filter_nullable_range",
    """select code, sugars_100g, fat_100g, salt_100g, energy_100g from bronze_products
       where (sugars_100g is null or sugars_100g between 0 and 100)
         and (fat_100g is null or fat_100g >= 0)
         and (salt_100g is null or salt_100g >= 0)
         and (energy_100g is null or energy_100g >= 0)""",
)
def filter_nullable_range(spark, sf_dir):
    kept = within_or_null("sugars_100g", 0, 100)
    for column in ("fat_100g", "salt_100g", "energy_100g"):
        kept = kept & at_least_or_null(column, 0)
    return stages.measures(spark, sf_dir).where(kept).select(
        "code", "sugars_100g", "fat_100g", "salt_100g", "energy_100g"
    )


@registered(
    "filter_not_null",
    "select code, fat_100g, sugars_100g from bronze_products where fat_100g is not null",
)
def filter_not_null(spark, sf_dir):
    measures = stages.measures(spark, sf_dir)
    return measures.where(F.col("fat_100g").isNotNull()).select("code", "fat_100g", "sugars_100g")


# Casts and lists ------------------------------------------------------------------------

_PRICE_TEXT = (
    "case when l_linenumber = 7 then '1.234,5' when l_linenumber = 6 then 'n/a'"
    " else replace(cast(cast(l_extendedprice as decimal(18,2)) as string), '.', ',') end"
)


@registered(
    "decimal_comma_to_double",
    f"""select l_orderkey, l_linenumber, try_cast(replace(price, ',', '.') as double) as price,
               case when l_linestatus = 'O' then l_partkey end as part
        from (select *, {_PRICE_TEXT} as price from lineitem)""",
)
def decimal_comma_to_double(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr(_PRICE_TEXT).alias("price"),
        F.when(F.col("l_linestatus") == "O", F.col("l_partkey").cast("string"))
        .otherwise("unknown")
        .alias("part"),
    )
    return shape.replace_columns(
        lineitem, {"price": comma_decimal("price"), "part": lenient_long("part")}
    )


@registered(
    "explode_tokens",
    """select code, trim(tag) as additive
       from (select code, unnest(string_split(additives_tags, ',')) as tag from clean_products)
       where trim(tag) <> ''""",
)
def explode_tokens(spark, sf_dir):
    return shape.explode_items(
        stages.clean_products(spark, sf_dir), "additives_tags", "additive"
    ).select("code", "additive")


@registered(
    "explode_outer_tokens", "select code, countries_en, country_single from listed_products"
)
def explode_outer_tokens(spark, sf_dir):
    return shape.explode_items(
        stages.clean_products(spark, sf_dir), "countries_en", "country_single",
        keep_missing=True, keep_empty=True,
    ).select("code", "countries_en", "country_single")


# Cleaning -------------------------------------------------------------------------------


@registered(
    "rule_funnel",
    """with charged as (
         select code, case
             when product_name is null or trim(product_name) = '' then 1
             when coalesce(upper(trim(nutrition_grade_fr)) not in ('A', 'B', 'C', 'D', 'E'), true) then 2
             when sugars_100g < 0 or sugars_100g > 100 or fat_100g < 0 or salt_100g < 0
               or energy_100g < 0 then 3
             else 4 end as step
         from bronze_products),
       counted as (
         select 1 as step, 'product_name' as rule, count(*) filter (step = 1) as removed from charged
         union all select 2, 'nutrition_grade', count(*) filter (step = 2) from charged
         union all select 3, 'nutrition_ranges', count(*) filter (step = 3) from charged
         union all select 4, 'duplicate_key',
           count(*) filter (step = 4) - count(distinct code) filter (step = 4)
             - cast(bool_or(step = 4 and code is null) as integer) from charged),
       left_over as (
         select *, (select count(*) from charged) as total,
                (select count(*) from charged)
                - cast(sum(removed) over (order by step) as bigint) as remaining from counted)
       select step, rule, removed, remaining,
              cast(round(cast((total - remaining) / cast(total as double) * 100 as decimal(38, 10)), 4)
                   as double) as rejected_pct
       from left_over""",
)
def rule_funnel(spark, sf_dir):
    return quality.rule_funnel(
        stages.bronze_products(spark, sf_dir), silver.product_rules(), ["code"]
    )


@registered("clean_products", "select * from clean_products")
def clean_products(spark, sf_dir):
    return silver.clean_products(stages.bronze_products(spark, sf_dir))


@registered("clean_countries", "select * from clean_countries")
def clean_countries(spark, sf_dir):
    return silver.clean_countries(stages.bronze_countries(spark, sf_dir))


# Joins ----------------------------------------------------------------------------------

_KNOWN_NATIONS = (
    "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey"
    " where r_name <> 'ASIA'"
)


def _known_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations outside one region, so that some customers find no match."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_name") != "ASIA")
        .select("n_nationkey", "n_name", "r_name")
    )


def _customers_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_dimension(
        table(spark, sf_dir, "customer"), _known_nations(spark, sf_dir), "c_nationkey", "n_nationkey"
    ).select("c_custkey", "c_nationkey", "n_nationkey", "n_name", "r_name")


@registered(
    "dim_left_join",
    f"select c_custkey, c_nationkey, n_nationkey, n_name, r_name from customer"
    f" left join ({_KNOWN_NATIONS}) on c_nationkey = n_nationkey",
)
def dim_left_join(spark, sf_dir):
    return _customers_with_nation(spark, sf_dir)


@registered(
    "split_join",
    """with segments as (select p_partkey as part, 'seen ' || p_brand as note from part where p_partkey % 3 <> 0),
            lines as (select l_orderkey, l_linenumber, case when l_quantity <= 20 then 1 when l_quantity <= 25 then null
                             else l_partkey end as wanted from lineitem)
       select l_orderkey, l_linenumber, wanted, part, note from lines left join segments on wanted = part""",
)
def split_join(spark, sf_dir):
    """Two fifths of the lines ask for one part, a tenth for none; a third of the parts is unknown."""
    wanted = F.when(F.col("l_quantity") <= 20, F.lit(1)).when(F.col("l_quantity") > 25, F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", wanted.cast("bigint").alias("wanted"))
    parts = table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 != 0).select(
        F.col("p_partkey").alias("part"), F.concat(F.lit("seen "), "p_brand").alias("note")
    )
    return joins.split_join(lines, parts, "wanted", "part")


@registered(
    "keep_matched",
    f"select c_custkey, c_nationkey, n_nationkey, n_name, r_name from customer"
    f" join ({_KNOWN_NATIONS}) on c_nationkey = n_nationkey",
)
def keep_matched(spark, sf_dir):
    return joins.keep_matched(_customers_with_nation(spark, sf_dir), "n_nationkey")


@registered(
    "list_dim_join",
    "select code, country_single, country_normalized, region, population, area_sq_mi, pop_density,"
    " infant_mortality from enriched",
)
def list_dim_join(spark, sf_dir):
    enriched = silver.enrich(stages.clean_products(spark, sf_dir), stages.clean_countries(spark, sf_dir))
    return enriched.select(
        "code", "country_single", "country_normalized", "region", "population", "area_sq_mi",
        "pop_density", "infant_mortality",
    )


@registered(
    "join_match_rate",
    """select count(*) as total, count(country_normalized) as matched,
              count(*) - count(country_normalized) as unmatched,
              cast(round(cast(count(country_normalized) / cast(count(*) as double) * 100
                              as decimal(38, 10)), 4) as double) as matched_pct
       from enriched""",
)
def join_match_rate(spark, sf_dir):
    enriched = silver.enrich(stages.clean_products(spark, sf_dir), stages.clean_countries(spark, sf_dir))
    return joins.match_rate(enriched, "country_normalized")


# Aggregates -----------------------------------------------------------------------------


@registered("row_counts", "select count(*) as rows from lineitem")
def row_counts(spark, sf_dir):
    return aggregates.row_count(table(spark, sf_dir, "lineitem"))


@registered("group_means", "select * from category_profile")
def group_means(spark, sf_dir):
    return silver.category_profile(stages.enriched(spark, sf_dir)).orderBy(
        *by("-product_count", "main_category")
    )


@registered("two_key_counts", "select * from country_grade_profile")
def two_key_counts(spark, sf_dir):
    return silver.country_grade_profile(stages.enriched(spark, sf_dir)).orderBy(
        "country", "nutrition_grade_fr"
    )


@registered(
    "token_frequency",
    "select item as additive, occurrences as occurrence, categories as nb_categories"
    " from additive_frequency",
)
def token_frequency(spark, sf_dir):
    return silver.additive_profile(stages.listings(spark, sf_dir)).orderBy(*by("-occurrence", "additive"))


@registered("grade_by_country", "select * from mart_grade")
def grade_by_country(spark, sf_dir):
    return gold.grade_mart(stages.enriched(spark, sf_dir)).orderBy("country", "nutrition_grade_fr")


@registered(
    "class_counts",
    "select nutrition_grade_fr, count(*) as rows from bronze_products group by nutrition_grade_fr",
)
def class_counts(spark, sf_dir):
    return aggregates.group_summary(stages.measures(spark, sf_dir), ["nutrition_grade_fr"])


@registered(
    "class_share",
    """select nutrition_grade_fr, count(*) as rows,
              cast(round(cast(count(*) / cast((select count(*) from mart_feature) as double) * 100
                              as decimal(38, 10)), 4) as double) as pct
       from mart_feature group by nutrition_grade_fr""",
)
def class_share(spark, sf_dir):
    return aggregates.class_share(stages.feature_mart(spark, sf_dir), "nutrition_grade_fr", digits=4)


@registered("ratio_to_total", "select additive_tag, total_occurrences, pct_of_total from mart_additive")
def ratio_to_total(spark, sf_dir):
    enriched = stages.enriched(spark, sf_dir)
    frequency = aggregates.item_frequency(
        silver.additive_items(enriched, "additive_tag"),
        "additive_tag", "main_category", "total_occurrences", "nb_distinct_categories",
    )
    return aggregates.with_percent_of_rows(
        frequency, "total_occurrences", enriched, "pct_of_total"
    ).drop("nb_distinct_categories")


@registered(
    "class_feature_means",
    f"""select nutrition_grade_fr as grade, count(*) as count, {mean("energy_100g")} as avg_energy,
               {mean("fat_100g")} as avg_fat, {mean("sugars_100g")} as avg_sugars,
               {mean("proteins_100g")} as avg_proteins, {mean("fiber_100g")} as avg_fiber,
               {mean("salt_100g")} as avg_salt, {mean("additives_n")} as avg_additives
        from mart_feature where nutrition_grade_fr is not null group by nutrition_grade_fr""",
)
def class_feature_means(spark, sf_dir):
    return serving.feature_means(stages.feature_mart(spark, sf_dir))


@registered(
    "mean_of_means",
    f"""select nutrition_grade_fr as grade, count(*) as count,
               {mean("avg_nutriscore_score")} as global_avg_score
        from mart_grade where nutrition_grade_fr is not null group by nutrition_grade_fr""",
)
def mean_of_means(spark, sf_dir):
    return serving.grade_summary(stages.grade_mart(spark, sf_dir))


# Windows and order ----------------------------------------------------------------------


@registered(
    "rank_in_group",
    """select l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice,
              row_number() over (
                partition by l_returnflag
                order by l_extendedprice desc nulls last, l_orderkey, l_linenumber, l_partkey,
                         l_suppkey) as price_rank
       from lineitem""",
)
def rank_in_group(spark, sf_dir):
    """Three groups, each a third of all rows and too large for one task."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice"
    )
    return ranking.rank_in_group(
        lineitem,
        ["l_returnflag"],
        total_order(lineitem, "-l_extendedprice"),
        "price_rank",
        window_rows=1_000,
    ).drop("l_suppkey")


@registered(
    "sugar_rank_in_category",
    "select code, country_single, main_category, sugars_100g, sugar_rank_in_category from ranked",
)
def sugar_rank_in_category(spark, sf_dir):
    """Only what is asked for is ranked, as ranking across tasks stores its rows."""
    return silver.with_sugar_rank(
        stages.enriched(spark, sf_dir).select("code", "country_single", "main_category", "sugars_100g")
    )


@registered("top_n_per_group", "select * from mart_sugar")
def top_n_per_group(spark, sf_dir):
    return gold.sugar_mart(stages.enriched(spark, sf_dir)).orderBy("category", "sugar_rank_in_category")


@registered(
    "rank_overall",
    """select l_partkey, sold, row_number() over (order by sold desc, l_partkey) as place
       from (select l_partkey, count(*) as sold from lineitem group by l_partkey)""",
)
def rank_overall(spark, sf_dir):
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("sold"))
    return ranking.rank_overall(store(sold, "sold"), by("-sold", "l_partkey"), "place")


@registered("additive_ranking", "select * from mart_additive")
def additive_ranking(spark, sf_dir):
    return gold.additive_mart(stages.listings(spark, sf_dir)).orderBy("rank_overall")


@registered(
    "top_k",
    "select main_category, product_count from category_profile"
    " order by product_count desc, main_category limit 5",
)
def top_k(spark, sf_dir):
    profile = silver.category_profile(stages.enriched(spark, sf_dir))
    return ordering.top_k(profile, by("-product_count", "main_category"), 5).select(
        "main_category", "product_count"
    )


@registered(
    "ranked_preview",
    "select category, product_name, sugars_100g, sugar_rank_in_category from mart_sugar"
    " where sugars_100g is not null order by category, sugar_rank_in_category limit 10",
)
def ranked_preview(spark, sf_dir):
    known = stages.sugar_mart(spark, sf_dir).where(F.col("sugars_100g").isNotNull())
    return ordering.top_k(known, by("category", "sugar_rank_in_category"), 10).drop(
        "nutrition_grade_fr"
    )


# Duplicates and sets --------------------------------------------------------------------


@registered(
    "keep_one_single",
    """select o_custkey, o_orderkey, o_totalprice, o_orderstatus from (
         select *, row_number() over (
           partition by o_custkey order by o_totalprice desc nulls last, o_orderkey) as place
         from orders) where place = 1""",
)
def keep_one_single(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    return ranking.keep_one(orders, ["o_custkey"], by("-o_totalprice", "o_orderkey"))


@registered(
    "keep_one_composite",
    """select * exclude (place) from (
         select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                row_number() over (
                  partition by l_orderkey, l_linenumber
                  order by l_extendedprice desc nulls last, l_partkey, l_suppkey, l_quantity) as place
         from lineitem) where place = 1""",
)
def keep_one_composite(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return ranking.keep_one(
        lineitem, ["l_orderkey", "l_linenumber"], total_order(lineitem, "-l_extendedprice")
    )


@registered(
    "distinct_categories",
    """select category, (select count(distinct category) from mart_sugar) as count
       from mart_sugar where category is not null group by category""",
)
def distinct_categories(spark, sf_dir):
    found = serving.sugar_categories(stages.sugar_mart(spark, sf_dir))
    return found.withColumn("count", aggregates.row_count(found).scalar())


@registered(
    "union_row_counts",
    """select 'dm_sugar' as label, count(*) as rows from mart_sugar
       union all select 'dm_nutri', count(*) from mart_grade
       union all select 'dm_addit', count(*) from mart_additive
       union all select 'dm_ml', count(*) from mart_feature""",
)
def union_row_counts(spark, sf_dir):
    enriched = stages.enriched(spark, sf_dir)
    return aggregates.labelled_counts(
        {
            "dm_sugar": gold.sugar_mart(enriched),
            "dm_nutri": gold.grade_mart(enriched),
            "dm_addit": gold.additive_mart(enriched),
            "dm_ml": gold.feature_mart(enriched),
        }
    )


# Quality and reuse ----------------------------------------------------------------------


@registered(
    "volume_gate",
    """select 'products' as source, count(*) as rows, cast(50000 as bigint) as min_rows,
              count(*) >= 50000 as ok from bronze_products
       union all
       select 'countries', count(*), 200, count(*) >= 200 from raw_countries""",
)
def volume_gate(spark, sf_dir):
    """Products pass from scale factor 0.01 on; the 125 country records never reach 200."""
    products, countries = new_path(spark, "gate_products"), new_path(spark, "gate_countries")
    stages.write_bronze(spark, sf_dir, products, countries)
    return bronze.check_volumes(
        spark, {"products": products, "countries": countries}, INGEST_DATE, sample_rows=50_000
    )


@registered(
    "persisted_reuse",
    """select 'grade' as label, nutrition_grade_fr as key, count(*) as rows from clean_products
       group by nutrition_grade_fr
       union all
       select 'category', main_category, count(*) from clean_products group by main_category""",
)
def persisted_reuse(spark, sf_dir):
    def counts(df: DataFrame, label: str, key: str) -> DataFrame:
        grouped = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"))
        return store(grouped.select(F.lit(label).alias("label"), "key", "rows"), label)

    with reuse.kept(silver.clean_products(stages.bronze_products(spark, sf_dir))) as products:
        grades = counts(products, "grade", "nutrition_grade_fr")
        categories = counts(products, "category", "main_category")
    return grades.unionByName(categories)


# Jobs -----------------------------------------------------------------------------------


@registered(
    "bronze_products",
    "select * replace (nullif(countries_en, '') as countries_en,"
    " nullif(additives_tags, '') as additives_tags) from bronze_products",
)
def bronze_products(spark, sf_dir):
    target = new_path(spark, "bronze_products")
    bronze.ingest_products(spark, _raw_product_file(spark, sf_dir), target, INGEST_DATE)
    return lake.read_dated(spark, target, INGEST_DATE, PRODUCT_SCHEMA)


@registered(
    "dated_rerun_empty",
    """select 'path' as copy, 'other' as date, count(*) as rows,
              cast(sum(c_custkey) as bigint) as keys from customer
       union all select 'path', 'rerun', 0, null
       union all select 'table', 'rerun', 0, null
       union all select 'path', 'filled', count(*), cast(sum(c_custkey) as bigint) from customer
       union all select 'table', 'filled', count(*), cast(sum(c_custkey) as bigint) from customer
       union all select 'path', 'first', 0, null""",
)
def dated_rerun_empty(spark, sf_dir):
    """A date run full, then empty, then full again; another date; and an empty first run."""
    path, name = new_path(spark, "rerun"), f"{_new_database(spark, 'rerun')}.customers"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    none, other = customers.limit(0), date(2024, 5, 13)
    frames = []

    def note(copy: str, label: str, df: DataFrame) -> None:
        sums = df.agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))
        frames.append(
            store(sums.select(F.lit(copy).alias("copy"), F.lit(label).alias("date"), "rows", "keys"), "rerun")
        )

    def dated(day: date, folder: str = path) -> DataFrame:
        return lake.read_dated(spark, folder, day, customers.schema)

    tables.publish_twice(customers, path, name, other)
    for label, df in (("full", customers), ("rerun", none), ("filled", customers)):
        tables.publish_twice(df, path, name, INGEST_DATE)
        if label != "full":
            note("path", label, dated(INGEST_DATE))
            note("table", label, spark.table(name))
    note("path", "other", dated(other))
    first = new_path(spark, "rerun_first")
    lake.write_date(none, first, INGEST_DATE)
    note("path", "first", dated(INGEST_DATE, first))
    return reduce(DataFrame.unionByName, frames)


@registered(
    "failed_rerun_keeps_date",
    """select copy, 'failed task' as after, count(*) as rows, cast(sum(c_custkey) as bigint) as keys
       from customer, (select unnest(['path', 'table']) as copy) group by copy
       union all select copy, 'good run', count(*), cast(sum(c_custkey) as bigint) + count(*)
       from customer, (select unnest(['path', 'table']) as copy) group by copy""",
)
def failed_rerun_keeps_date(spark, sf_dir):
    """A rerun that fails in a task keeps both copies; a good one replaces them."""
    path, name = new_path(spark, "failed"), f"{_new_database(spark, 'failed')}.customers"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    later = customers.withColumn("c_custkey", F.col("c_custkey") + 1)
    last = customers.agg(F.max("c_custkey")).scalar()
    breaks = F.when(F.col("c_custkey") == last, F.raise_error(F.lit("planned"))).otherwise(F.col("c_custkey"))
    frames = []

    def note(after: str) -> None:
        copies = {"path": lake.read_dated(spark, path, INGEST_DATE, customers.schema), "table": spark.table(name)}
        for copy, df in copies.items():
            sums = df.agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))
            frames.append(
                store(sums.select(F.lit(copy).alias("copy"), F.lit(after).alias("after"), "rows", "keys"), "failed")
            )

    tables.publish_twice(customers, path, name, INGEST_DATE)
    try:
        tables.publish_twice(customers.withColumn("c_custkey", breaks.cast("bigint")), path, name, INGEST_DATE)
    except Exception as error:
        if "planned" not in str(error):
            raise
        note("failed task")
    tables.publish_twice(later, path, name, INGEST_DATE)
    note("good run")
    return reduce(DataFrame.unionByName, frames)


@registered(
    "country_type_drift",
    """select day, cast(count(*) as bigint) as countries, cast(sum(population) as bigint) as population from (
         select 14 as day, try_cast("Population" as bigint) as population from raw_countries
         union all
         select 15, case when "Climate" = '1' then null else try_cast("Population" as bigint) end
         from raw_countries) group by day""",
)
def country_type_drift(spark, sf_dir):
    """Two dates whose files would be inferred with different types."""
    target = new_path(spark, "drift")
    raw = raw_countries(spark, sf_dir)
    dirt = F.when(F.col("Climate") == "1", "n/a").otherwise(F.col("Population"))
    days = {INGEST_DATE: raw, date(2024, 5, 15): raw.withColumn("Population", dirt)}
    for day, df in days.items():
        source = new_path(spark, "drift_source")
        _write_text(df, source, ",")
        bronze.ingest_countries(spark, source, target, day)
    found = [
        lake.read_dated(spark, target, day, COUNTRY_SCHEMA).select(
            "day", lenient_long("Population").alias("population")
        )
        for day in days
    ]
    return reduce(DataFrame.unionByName, found).groupBy("day").agg(
        F.count("*").alias("countries"), F.sum("population").alias("population")
    )


@registered(
    "lenient_long_decimals",
    """select l_orderkey, l_linenumber, cast(trunc(l_quantity) as bigint) as nines,
              -cast(trunc(l_quantity) as bigint) as negative, cast(l_orderkey as bigint) as no_digits
       from lineitem""",
)
def lenient_long_decimals(spark, sf_dir):
    """Seven decimals and thirty are cut, not rounded; a point may end the number."""
    lineitem = table(spark, sf_dir, "lineitem")
    whole = F.floor("l_quantity").cast("string")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        lenient_long(F.concat(whole, F.lit(".9999999"))).alias("nines"),
        lenient_long(F.concat(F.lit(" -"), whole, F.lit("." + "9" * 30))).alias("negative"),
        lenient_long(F.concat(F.col("l_orderkey").cast("string"), F.lit("."))).alias("no_digits"),
    )


@registered(
    "lenient_long",
    """select l_orderkey, l_linenumber, cast(l_orderkey as bigint) as plain,
              cast(trunc(l_quantity) as bigint) as decimal_text, cast(null as bigint) as malformed
       from lineitem""",
)
def lenient_long_query(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("string")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        lenient_long(F.col("l_orderkey").cast("string")).alias("plain"),
        lenient_long(quantity).alias("decimal_text"),
        lenient_long(F.concat(quantity, F.lit("x"))).alias("malformed"),
    )


@registered(
    "ingest_metrics",
    """select 'products' as source, count(*) as rows_read, count(*) as rows_written from raw_products
       union all select 'countries', count(*), count(*) from raw_countries""",
)
def ingest_metrics(spark, sf_dir):
    """What the ingest jobs report about the files they wrote."""
    reports = {
        "products": bronze.ingest_products(
            spark, _raw_product_file(spark, sf_dir), new_path(spark, "metrics_products"), INGEST_DATE
        ),
        "countries": bronze.ingest_countries(
            spark, _raw_country_file(spark, sf_dir), new_path(spark, "metrics_countries"), INGEST_DATE
        ),
    }
    return spark.createDataFrame(
        [(name, r["rows_read"], r["rows_written"]) for name, r in reports.items()],
        "source string, rows_read bigint, rows_written bigint",
    )


@registered(
    "bronze_countries",
    'select "Country" as country, "Region" as region, cast("Population" as bigint) as population,'
    ' "Net migration" as net_migration, 2024 as year, 5 as month, 14 as day from raw_countries',
)
def bronze_countries(spark, sf_dir):
    target = new_path(spark, "bronze_countries")
    bronze.ingest_countries(spark, _raw_country_file(spark, sf_dir), target, INGEST_DATE)
    stored = lake.read_dated(spark, target, INGEST_DATE, COUNTRY_SCHEMA)
    return shape.rename(stored, COUNTRY_RENAMES).select(
        "country", "region", F.col("population").cast("bigint").alias("population"), "net_migration",
        *DATE_COLUMNS,
    )


@registered(
    "silver_profiles",
    """select 'category' as profile, main_category as key, cast(null as varchar) as grade,
              product_count as rows, avg_sugars_100g as value from category_profile
       union all
       select 'country_grade', country, nutrition_grade_fr, product_count, avg_nutriscore_score
       from country_grade_profile
       union all
       select 'additive', item, null, occurrences, cast(categories as double) from additive_frequency
       union all
       select 'top_sugar', main_category, nutrition_grade_fr, count(*), max(sugars_100g)
       from ranked where sugar_rank_in_category <= 10 group by all""",
)
def silver_profiles(spark, sf_dir):
    enriched = stages.enriched(spark, sf_dir)
    top = ranking.top_n_per_group(
        enriched, ["main_category"], by("-sugars_100g", "code", "country_single"), 10,
        "sugar_rank_in_category",
    )

    def lines(df: DataFrame, profile: str, key: str, grade, rows: str, value) -> DataFrame:
        return df.select(
            F.lit(profile).alias("profile"), F.col(key).alias("key"), grade.alias("grade"),
            F.col(rows).alias("rows"), value.alias("value"),
        )

    none, grade = F.lit(None).cast("string"), F.col("nutrition_grade_fr")
    return (
        lines(silver.category_profile(enriched), "category", "main_category", none,
              "product_count", F.col("avg_sugars_100g"))
        .unionByName(
            lines(silver.country_grade_profile(enriched), "country_grade", "country", grade,
                  "product_count", F.col("avg_nutriscore_score")))
        .unionByName(
            lines(silver.additive_profile(enriched), "additive", "additive", none,
                  "occurrence", F.col("nb_categories").cast("double")))
        .unionByName(
            lines(top.groupBy("main_category", "nutrition_grade_fr")
                  .agg(F.count("*").alias("rows"), F.max("sugars_100g").alias("most")),
                  "top_sugar", "main_category", grade, "rows", F.col("most")))
    )


@registered(
    "publish_silver",
    """select 'products_clean' as name, count(*) as path_rows, count(*) as table_rows,
              sum(coalesce(sugars_100g, 0)) as checksum from clean_products
       union all select 'countries_clean', count(*), count(*), sum(population) from clean_countries
       union all select 'products_enriched', count(*), count(*), sum(sugar_rank_in_category)
       from ranked""",
)
def publish_silver(spark, sf_dir):
    products, countries = new_path(spark, "silver_in_products"), new_path(spark, "silver_in_countries")
    stages.write_bronze(spark, sf_dir, products, countries)
    target, database = new_path(spark, "silver"), _new_database(spark, "silver_tables")
    refined = silver.refine(spark, products, countries, target, database, INGEST_DATE)
    rows = refined.raise_on_error().results
    sums = {
        "products_clean": F.sum(F.coalesce("sugars_100g", F.lit(0.0))),
        "countries_clean": F.sum("population").cast("double"),
        "products_enriched": F.sum("sugar_rank_in_category").cast("double"),
    }
    reports = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("name"),
            F.lit(rows[name]).cast("bigint").alias("path_rows"),
            F.count("*").alias("table_rows"),
            sums[name].alias("checksum"),
        )
        for name in SILVER_TABLES
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


_MART_SUMS = {
    "dm_sugar_by_category": ("mart_sugar", "sugars_100g", "nutrition_grade_fr"),
    "dm_nutriscore_by_country": ("mart_grade", "nb_products", "country"),
    "dm_additives_analysis": ("mart_additive", "total_occurrences", "additive_tag"),
    "dm_ml_nutriscore_prediction": ("mart_feature", "energy_100g", "code"),
}


@registered(
    "publish_marts",
    " union all ".join(
        f"select '{name}' as label, count(*) as rows, cast(sum({number}) as double) as total,"
        f" cast(sum(length({text})) as bigint) as letters, min({text}) as low, max({text}) as high"
        f" from {stage}"
        for name, (stage, number, text) in _MART_SUMS.items()
    ),
)
def publish_marts(spark, sf_dir):
    path = new_path(spark, "marts")
    gold.publish_marts(stages.enriched(spark, sf_dir), path).raise_on_error()
    sums = [
        gold.read_mart(spark, path, name).agg(
            F.lit(name).alias("label"),
            F.count("*").alias("rows"),
            F.sum(number).cast("double").alias("total"),
            F.sum(F.length(text)).alias("letters"),
            F.min(text).alias("low"),
            F.max(text).alias("high"),
        )
        for name, (_, number, text) in _MART_SUMS.items()
    ]
    return reduce(DataFrame.unionByName, sums)


@registered("ml_feature_table", "select * from mart_feature")
def ml_feature_table(spark, sf_dir):
    return gold.feature_mart(stages.enriched(spark, sf_dir))


# Serving --------------------------------------------------------------------------------


@registered(
    "page_top_sugar",
    """with chosen as (
         select * from mart_sugar
         where category = 'promo' and sugars_100g >= 0 and nutrition_grade_fr = 'B')
       select *, (select count(*) from chosen) as total from chosen
       order by category, sugar_rank_in_category limit 5 offset 0""",
)
def page_top_sugar(spark, sf_dir):
    return serving.sugar_page(
        stages.sugar_mart(spark, sf_dir), page=1, limit=5, category="promo", min_sugars=0, grade="b"
    ).with_total()


@registered(
    "page_grade_country",
    """with chosen as (select * from mart_grade where lower(region) = lower('europe'))
       select *, (select count(*) from chosen) as total from chosen
       order by avg_nutriscore_score nulls last, country, region, nutrition_grade_fr
       limit 10 offset 10""",
)
def page_grade_country(spark, sf_dir):
    return serving.grade_page(
        stages.grade_mart(spark, sf_dir), page=2, limit=10, region="Europe"
    ).with_total()


@registered(
    "page_tokens",
    "select *, (select count(*) from mart_additive) as total from mart_additive"
    " order by rank_overall limit 5 offset 5",
)
def page_tokens(spark, sf_dir):
    return serving.additive_page(stages.additive_mart(spark, sf_dir), page=2, limit=5).with_total()


@registered(
    "page_features",
    "select *, (select count(*) from mart_feature) as total from mart_feature"
    " order by code nulls last limit 100 offset 200",
)
def page_features(spark, sf_dir):
    return serving.feature_page(stages.feature_mart(spark, sf_dir), page=3, limit=100).with_total()


@registered("top_n_tokens", "select * from mart_additive order by rank_overall limit 5")
def top_n_tokens(spark, sf_dir):
    return serving.top_additives(stages.additive_mart(spark, sf_dir), 5)


@registered(
    "random_sample",
    "select * from mart_feature order by md5(coalesce(code, '') || ':7'), code limit 25",
)
def random_sample(spark, sf_dir):
    return serving.feature_sample(stages.feature_mart(spark, sf_dir), 25, seed=7)


# Dashboards -----------------------------------------------------------------------------


@registered(
    "bi_score_by_country",
    """select country, round(avg(avg_nutriscore_score), 6) as avg_score from mart_grade
       where nutrition_grade_fr in ('A', 'B', 'C') and region in ('EUROPE', 'AFRICA')
       group by country""",
)
def bi_score_by_country(spark, sf_dir):
    scores = dashboards.score_by_country(
        stages.grade_mart(spark, sf_dir), grade=["A", "B", "C"], region=["EUROPE", "AFRICA"]
    )
    return scores.withColumn("avg_score", F.round("avg_score", 6))


@registered(
    "bi_sugar_by_product",
    "select * from mart_sugar where sugar_rank_in_category <= 5 and category in ('promo', 'large')",
)
def bi_sugar_by_product(spark, sf_dir):
    return dashboards.sugar_by_product(
        stages.sugar_mart(spark, sf_dir), category=["promo", "large"], max_rank=5
    )


@registered(
    "bi_top20_tokens",
    "select rank_overall, additive_tag, total_occurrences from mart_additive where rank_overall <= 5",
)
def bi_top20_tokens(spark, sf_dir):
    return dashboards.frequent_additives(stages.additive_mart(spark, sf_dir), max_rank=5)


@registered(
    "bi_top10_share", "select additive_tag, pct_of_total from mart_additive where rank_overall <= 10"
)
def bi_top10_share(spark, sf_dir):
    return dashboards.additive_shares(stages.additive_mart(spark, sf_dir))


@registered(
    "bi_token_kpis",
    "select count(additive_tag) as nb_additives,"
    " max(additive_tag) filter (rank_overall = 1) as top_additive from mart_additive",
)
def bi_token_kpis(spark, sf_dir):
    return dashboards.additive_kpis(stages.additive_mart(spark, sf_dir))


@registered(
    "bi_grade_counts",
    "select nutrition_grade_fr, count(*) as nb_products from mart_feature group by nutrition_grade_fr",
)
def bi_grade_counts(spark, sf_dir):
    return dashboards.products_per_grade(stages.feature_mart(spark, sf_dir))


@registered(
    "bi_scatter", "select sugars_100g, energy_100g, fat_100g, nutrition_grade_fr from mart_feature"
)
def bi_scatter(spark, sf_dir):
    return dashboards.feature_scatter(stages.feature_mart(spark, sf_dir))


@registered(
    "bi_mean_kpis",
    """select avg(sugars_100g) as avg_sugars, avg(energy_100g) as avg_energy,
              avg(proteins_100g) as avg_proteins
       from mart_feature where nutrition_grade_fr in ('D', 'E') and main_category = 'economy'""",
)
def bi_mean_kpis(spark, sf_dir):
    return dashboards.feature_kpis(
        stages.feature_mart(spark, sf_dir), grade=["D", "E"], category=["economy"]
    )
