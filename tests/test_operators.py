import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from larder.functions import comma_decimal, lenient_double, lenient_int, lenient_long, path_text
from larder.functions.dates import parse_iso_date
from larder.operators.aggregates import class_share
from larder.operators.ordering import first_by, page_of, sample_rows
from larder.operators.predicates import at_least_or_null, within_or_null
from larder.operators.quality import rule_funnel
from larder.operators.ranking import (
    keep_one, ordering, rank_in_group, rank_overall, top_n_per_group, total_order,
)
from larder.operators.reuse import kept
from larder.operators.shape import conform, explode_items
from larder.plans import silver
from larder.schemas import PRODUCT_SCHEMA

SF = "/root/testdata/sf0.001"


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_lenient_numbers(spark):
    df = texts(spark, "3", "3.0", "3.7", "-3.7", "", "abc", None, "99999999999")
    assert column(df, lenient_int("t")) == [3, 3, 3, -3, None, None, None, None]
    assert column(df, lenient_double("t"))[4:7] == [None, None, None]
    assert column(df, lenient_long("t")) == [3, 3, 3, -3, None, None, None, 99999999999]
    largest = texts(spark, "9223372036854775807", "9223372036854775808")
    assert column(largest, lenient_long("t")) == [9223372036854775807, None]
    commas = texts(spark, "48,0", "1.234,5", "n/a", "7", None)
    assert column(commas, comma_decimal("t")) == [48.0, None, None, 7.0, None]


def test_nan_passes_the_lower_bound_only(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (50.0,)], "x double")
    assert column(df, within_or_null("x", 0, 100)) == [False, True, False, True]
    assert column(df, at_least_or_null("x", 0)) == [True, True, False, True]


def test_dates(spark):
    assert parse_iso_date("2024-05-14").day == 14
    with pytest.raises(ValueError):
        parse_iso_date("14/05/2024")
    df = spark.sql("select date'2024-05-04' as d")
    assert column(df, path_text("d")) == ["year=2024/month=05/day=04"]


def test_conform_fills_absent_columns(spark):
    df = conform(texts(spark, "x").withColumnRenamed("t", "code"), PRODUCT_SCHEMA)
    assert df.columns == PRODUCT_SCHEMA.names
    assert dict(df.dtypes)["saturated-fat_100g"] == "double"


def test_explode_items_modes(spark):
    df = texts(spark, "a, b,,", None, "")
    assert column(explode_items(df, "t", "i"), "i") == ["a", "b"]
    kept_all = explode_items(df, "t", "i", keep_missing=True, keep_empty=True)
    assert column(kept_all, "i") == ["a", "b", "", "", None, ""]


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, another is NULL; many values tie."""
    group = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, None).otherwise(
        F.concat(F.lit("g"), (F.col("id") % 23).cast("string"))
    )
    value = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5)
    return spark.range(0, 20000, 1, 6).select(group.alias("g"), value.alias("v"), "id")


def test_rank_across_tasks_equals_a_window(skewed, uncoalesced):
    order = ordering("-v", "id")
    ours = rank_in_group(skewed, ["g"], order, "r", window_rows=0)
    window = Window.partitionBy("g").orderBy(*order)
    theirs = skewed.withColumn("r", F.row_number().over(window).cast("bigint"))
    assert len(ours.inputFiles()) > 8  # several sorted files, then the two small tables
    assert ours.count() == 20000 and ours.exceptAll(theirs).count() == 0
    assert ours.dtypes == theirs.dtypes
    small = rank_in_group(skewed, ["g"], order, "r")
    assert small.exceptAll(theirs).count() == 0


def test_only_the_hot_group_is_ranked_across_tasks(skewed, uncoalesced, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    order = ordering("-v", "id")
    split = rank_in_group(skewed, ["g"], order, "r", window_rows=5000)
    window = Window.partitionBy("g").orderBy(*order)
    theirs = skewed.withColumn("r", F.row_number().over(window).cast("bigint"))
    assert split.count() == 20000 and split.exceptAll(theirs).count() == 0
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number") == 1
    # The hot rows meet the starts of their group by partition and group, not by group alone.
    assert "hashpartitioning(_in#" in [line for line in plan.splitlines() if "hashpartitioning" in line][-1]
    for threshold in (100, 1000, 100_000):
        other = rank_in_group(skewed, ["g"], order, "r", window_rows=threshold)
        assert other.exceptAll(split).count() == 0


def test_group_limit_threshold_is_the_sessions(skewed, setting):
    order = ordering("-v", "id")
    usual = top_n_per_group(skewed, ["g"], order, 5, "r").collect()
    setting("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    assert sorted(top_n_per_group(skewed, ["g"], order, 5, "r").collect(), key=str) == sorted(usual, key=str)


@pytest.mark.parametrize("width", ["1", "3", "17"])
def test_rank_overall_at_any_shuffle_width(skewed, setting, uncoalesced, width):
    setting("spark.sql.shuffle.partitions", width)
    ranked = rank_overall(skewed, ordering("-v", "id"), "r")
    found = [r.r for r in ranked.orderBy(*ordering("-v", "id")).select("r").collect()]
    assert found == list(range(1, 20001))


def test_rank_of_nothing(skewed):
    empty = skewed.where("id < 0")
    assert rank_in_group(empty, ["g"], ordering("id"), "r").count() == 0
    assert rank_in_group(empty, ["g"], ordering("id"), "r", window_rows=-1).count() == 0


@pytest.mark.parametrize("width", ["1", "13"])
def test_keep_one_does_not_depend_on_the_shuffle(skewed, setting, width):
    setting("spark.sql.shuffle.partitions", width)
    found = sorted(keep_one(skewed, ["g"], total_order(skewed, "-v")).collect(), key=str)
    best = {}
    for row in skewed.collect():
        key = (-(row.v if row.v is not None else -1), row.id)
        if row.g not in best or key < best[row.g][0]:
            best[row.g] = (key, row)
    assert found == sorted((row for _, row in best.values()), key=str)


def test_top_n_keeps_ranks_dense(skewed):
    top = top_n_per_group(skewed, ["g"], ordering("-v", "id"), 4, "r").collect()
    places = {}
    for row in top:
        places.setdefault(row.g, []).append(row.r)
    assert all(sorted(p) == [1, 2, 3, 4] for p in places.values())


def test_large_cuts_equal_small_ones(skewed):
    order = ordering("-v", "id")
    large = top_n_per_group(skewed, ["g"], order, 1500, "r")
    small = top_n_per_group(skewed, ["g"], order, 900, "r")
    assert large.dtypes == small.dtypes
    assert large.where("r <= 900").exceptAll(small).count() == 0
    assert large.where("g = 'hot'").count() == 1500


def test_funnel_adds_up_and_matches_the_cleaning(spark):
    from larder.workload import stages

    bronze = stages.bronze_products(spark, SF)
    funnel = rule_funnel(bronze, silver.product_rules(), ["code"]).collect()
    assert funnel[0].removed + funnel[0].remaining == bronze.count()
    for before, after in zip(funnel, funnel[1:]):
        assert before.remaining - after.removed == after.remaining
    assert funnel[-1].remaining == silver.clean_products(bronze).count()


def test_no_product_is_lost_by_the_join(spark):
    from larder.workload import stages

    products, enriched = stages.clean_products(spark, SF), stages.enriched(spark, SF)
    lost = products.join(enriched, products.code.eqNullSafe(enriched.code), "left_anti")
    assert lost.count() == 0
    features = stages.feature_mart(spark, SF)
    assert features.count() == features.select("code").distinct().count() == products.count()


def test_join_agrees_with_and_without_broadcast(spark, setting):
    from larder.workload import stages

    products, countries = stages.clean_products(spark, SF), stages.clean_countries(spark, SF)
    small = silver.enrich(products, countries).collect()
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert sorted(silver.enrich(products, countries).collect(), key=str) == sorted(small, key=str)


def test_pages_cover_the_result_once(skewed):
    order = ordering("-v", "id")
    seen = []
    for number in range(1, 5):
        seen += [r.id for r in page_of(skewed.where("id < 1000"), order, number, 300).items.collect()]
    assert len(seen) == len(set(seen)) == 1000
    far = page_of(skewed, order, 60, 300).items
    assert [r.id for r in far.collect()] == [
        r.id for r in skewed.orderBy(*order).offset(59 * 300).limit(300).collect()
    ]
    assert "limit=18000" not in far._jdf.queryExecution().executedPlan().toString()
    keyed = page_of(skewed, ordering("id"), 2, 300, key="id", after=299).items
    assert [r.id for r in keyed.collect()] == list(range(300, 600))
    for page, limit in [(0, 10), (1, 0), (1, 501)]:
        with pytest.raises(ValueError):
            page_of(skewed, order, page, limit)


@pytest.mark.parametrize("n", [3, 700, 30000])
def test_first_by_equals_the_sorted_limit(skewed, n):
    order = ordering("id", "v")
    doubled = skewed.unionByName(skewed)
    assert first_by(doubled, "id", order, n, one_in=8).collect() == doubled.orderBy(*order).limit(n).collect()


def test_sample_depends_on_the_seed_only(skewed):
    def draw(df, seed):
        return [r.id for r in sample_rows(df, "id", 20, seed).collect()]

    assert draw(skewed, 1) == draw(skewed.repartition(3), 1) != draw(skewed, 2)


def test_shares_are_whole(skewed):
    shares = class_share(skewed, "g").collect()
    assert abs(sum(r.pct for r in shares) - 100) < 1e-9
    assert class_share(skewed.where("id < 0"), "g").count() == 0


def test_kept_frame_is_released(skewed):
    with kept(skewed) as held:
        assert held.is_cached
    assert not held.is_cached
