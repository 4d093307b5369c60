"""Oracle SQL: the pipeline stages as common table expressions and a select per query."""

from __future__ import annotations

import re

from larder.workload.inputs import (
    INGEST_DATE,
    LISTING_NUMBERS,
    RAW_COUNTRY_COLUMNS,
    RAW_PRODUCT_COLUMNS,
)


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{name}"' for name, sql in columns.items())


_NUMBERS = ", ".join(f"{sql} as {name}" for name, sql in LISTING_NUMBERS.items())
_DATE = f"{INGEST_DATE.year} as year, {INGEST_DATE.month} as month, {INGEST_DATE.day} as day"


def _comma(column: str) -> str:
    return f"try_cast(replace(\"{column}\", ',', '.') as double)"


STAGES = {
    "raw_products": f"""
        select {_columns(RAW_PRODUCT_COLUMNS)}
        from (select *, {_NUMBERS} from lineitem) l
        join part on l_partkey = p_partkey
        join supplier on l_suppkey = s_suppkey
        join (select n_nationkey as home_key, n_name as home_name from nation) on s_nationkey = home_key
        join (select n_nationkey as away_key, n_name as away_name from nation)
          on (s_nationkey + l_linenumber) % 25 = away_key""",
    "raw_countries": f"""
        select {_columns(RAW_COUNTRY_COLUMNS)}
        from (
          select n_name, n_nationkey, r_name, r_regionkey, c_mktsegment as segment,
                 count(*) as customers,
                 cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(18,2)) as balance
          from customer
          join nation on c_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey
          group by all)""",
    "bronze_products": f"""
        select code, product_name, countries_en, categories_en, main_category, nutrition_grade_fr,
               try_cast("nutrition-score-fr_100g" as double) as "nutrition-score-fr_100g",
               try_cast(energy_100g as double) as energy_100g,
               try_cast(fat_100g as double) as fat_100g,
               try_cast("saturated-fat_100g" as double) as "saturated-fat_100g",
               try_cast(sugars_100g as double) as sugars_100g,
               try_cast(fiber_100g as double) as fiber_100g,
               try_cast(proteins_100g as double) as proteins_100g,
               try_cast(salt_100g as double) as salt_100g,
               cast(trunc(try_cast(additives_n as double)) as integer) as additives_n,
               additives_tags, {_DATE}
        from raw_products""",
    "valid_products": """
        select code, product_name, countries_en, categories_en, main_category, nutrition_grade_fr,
               "nutrition-score-fr_100g" as nutriscore_score, energy_100g, fat_100g,
               "saturated-fat_100g" as saturated_fat_100g, sugars_100g, fiber_100g, proteins_100g,
               salt_100g, additives_n, additives_tags, year, month, day
        from bronze_products
        where product_name is not null and trim(product_name) <> ''
          and upper(trim(nutrition_grade_fr)) in ('A', 'B', 'C', 'D', 'E')
          and (sugars_100g is null or (sugars_100g >= 0 and sugars_100g <= 100))
          and (fat_100g is null or fat_100g >= 0)
          and (salt_100g is null or salt_100g >= 0)
          and (energy_100g is null or energy_100g >= 0)""",
    "clean_products": """
        select * exclude (place)
               replace (upper(trim(nutrition_grade_fr)) as nutrition_grade_fr,
                        lower(trim(countries_en)) as countries_en,
                        lower(trim(main_category)) as main_category)
        from (
          select *, row_number() over (
            partition by code
            order by product_name nulls last, countries_en nulls last, categories_en nulls last,
                     main_category nulls last, nutrition_grade_fr nulls last,
                     nutriscore_score nulls last, energy_100g nulls last, fat_100g nulls last,
                     saturated_fat_100g nulls last, sugars_100g nulls last, fiber_100g nulls last,
                     proteins_100g nulls last, salt_100g nulls last, additives_n nulls last,
                     additives_tags nulls last) as place
          from valid_products)
        where place = 1""",
    "clean_countries": f"""
        select * exclude (place) from (
          select *, row_number() over (
            partition by country_normalized
            order by population desc nulls last, country, region, area_sq_mi nulls last,
                     pop_density nulls last, coastline_ratio nulls last,
                     infant_mortality nulls last) as place
          from (
            select trim("Country") as country, trim("Region") as region,
                   cast("Population" as bigint) as population,
                   cast("Area (sq. mi.)" as bigint) as area_sq_mi,
                   {_comma("Pop. Density (per sq. mi.)")} as pop_density,
                   {_comma("Coastline (coast/area ratio)")} as coastline_ratio,
                   {_comma("Net migration")} as net_migration,
                   {_comma("Infant mortality (per 1000 births)")} as infant_mortality,
                   cast("GDP ($ per capita)" as bigint) as gdp_per_capita,
                   {_comma("Literacy (%)")} as literacy_pct,
                   {_comma("Phones (per 1000)")} as phones_per_1000,
                   {_comma("Arable (%)")} as arable_pct,
                   {_comma("Crops (%)")} as crops_pct,
                   {_comma("Other (%)")} as other_pct,
                   "Climate" as climate,
                   {_comma("Birthrate")} as birthrate,
                   {_comma("Deathrate")} as deathrate,
                   {_comma("Agriculture")} as agriculture,
                   {_comma("Industry")} as industry,
                   {_comma("Service")} as service,
                   {_DATE},
                   lower(trim("Country")) as country_normalized
            from raw_countries))
        where place = 1""",
    "listed_products": """
        select *, trim(item) as country_single
        from (select *, unnest(coalesce(string_split(countries_en, ','), [null])) as item
              from clean_products)""",
    "enriched": """
        select p.* exclude (item), c.* exclude (year, month, day)
        from listed_products p
        left join clean_countries c on p.country_single = c.country_normalized""",
    "ranked": """
        select *, row_number() over (
          partition by main_category
          order by sugars_100g desc nulls last, code nulls last, product_name nulls last,
                   countries_en nulls last, country_single nulls last) as sugar_rank_in_category
        from enriched""",
    "category_profile": """
        select main_category, avg(sugars_100g) as avg_sugars_100g, avg(fat_100g) as avg_fat_100g,
               avg(salt_100g) as avg_salt_100g, avg(energy_100g) as avg_energy_kj_100g,
               count(code) as product_count
        from enriched where main_category is not null and main_category <> ''
        group by main_category""",
    "country_grade_profile": """
        select country, nutrition_grade_fr, count(code) as product_count,
               avg(nutriscore_score) as avg_nutriscore_score
        from enriched where country_normalized is not null group by all""",
    "additive_items": """
        select *, trim(tag) as item
        from (select *, unnest(string_split(trim(additives_tags), ',')) as tag
              from enriched where additives_tags is not null and additives_tags <> '')
        where trim(tag) <> ''""",
    "additive_frequency": """
        select item, count(*) as occurrences, count(distinct main_category) as categories
        from additive_items group by item""",
    "mart_sugar": """
        select main_category as category, product_name, sugars_100g, nutrition_grade_fr,
               cast(place as integer) as sugar_rank_in_category
        from (
          select *, row_number() over (
            partition by main_category
            order by sugars_100g desc nulls last, code nulls last) as place
          from (
            select distinct code, main_category, product_name, sugars_100g, nutrition_grade_fr
            from enriched where main_category is not null and main_category <> ''))
        where place <= 10""",
    "mart_grade": """
        select country, region, nutrition_grade_fr, count(code) as nb_products,
               avg(nutriscore_score) as avg_nutriscore_score
        from enriched where country is not null and nutrition_grade_fr is not null
        group by country, region, nutrition_grade_fr""",
    "mart_additive": """
        select item as additive_tag, occurrences as total_occurrences,
               categories as nb_distinct_categories,
               cast(row_number() over (order by occurrences desc, item) as integer) as rank_overall,
               cast(round(cast(occurrences / cast((select count(*) from enriched) as double) * 100
                               as decimal(38, 10)), 4) as double) as pct_of_total
        from additive_frequency""",
    "mart_feature": """
        select code, sugars_100g, fat_100g, saturated_fat_100g, salt_100g, energy_100g,
               proteins_100g, fiber_100g, additives_n, main_category, country_normalized,
               population, area_sq_mi, nutrition_grade_fr
        from (
          select *, row_number() over (
            partition by code order by country_normalized nulls last) as place
          from enriched where nutrition_grade_fr is not null)
        where place = 1""",
}


def with_stages(select: str) -> str:
    """``select`` preceded by the stages it uses, directly or through other stages."""
    needed: set[str] = set()
    texts = [select]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in words & STAGES.keys() - needed:
            needed.add(name)
            texts.append(STAGES[name])
    stages = [f"{name} as ({body})" for name, body in STAGES.items() if name in needed]
    if select.lstrip().startswith("with "):
        select = f"select * from ({select})"
    return (f"with {', '.join(stages)}\n" if stages else "") + select


def mean(column: str, digits: int = 2) -> str:
    """Rounded mean, rounding half away from zero on the decimal value."""
    return f"cast(round(cast(avg({column}) as decimal(38, 10)), {digits}) as double)"
