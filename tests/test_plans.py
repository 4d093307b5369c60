"""The physical plans that carry the weight at scale."""

import contextlib
import io
import re
from datetime import date

from larder.operators.ranking import keep_one, ordering, top_n_per_group
from larder.operators.shape import stamp_date
from larder.plans import gold, serving, silver
from larder.sources.lake import read_dated, write_dated
from larder.workload import stages
from larder.workload.inputs import table

SF = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df):
    return plan(df).split("\n\n\n")[0]


def test_stored_dimension_is_broadcast_by_size(spark, setting):
    enriched = silver.enrich(stages.clean_products(spark, SF), stages.clean_countries(spark, SF))
    assert "BroadcastHashJoin LeftOuter BuildRight" in tree(enriched)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = silver.enrich(stages.clean_products(spark, SF), stages.clean_countries(spark, SF))
    assert "SortMergeJoin LeftOuter" in tree(large) and "Broadcast" not in tree(large)


def test_group_limits_run_before_the_shuffle(spark):
    lineitem = table(spark, SF, "lineitem").select("l_partkey", "l_orderkey")
    for df in (
        keep_one(lineitem, ["l_partkey"], ordering("l_orderkey")),
        top_n_per_group(lineitem, ["l_partkey"], ordering("l_orderkey"), 10, "r"),
    ):
        shape = tree(df)
        assert shape.count("WindowGroupLimit") == 2
        assert shape.index("WindowGroupLimit") < shape.index("Exchange") < shape.rindex("WindowGroupLimit")


def test_aggregates_combine_before_the_shuffle(spark):
    shape = tree(gold.grade_mart(stages.enriched(spark, SF)))
    assert shape.count("HashAggregate") == 2 and shape.count("Exchange") == 1


def test_pages_do_not_sort_everything(spark):
    items = serving.feature_page(stages.feature_mart(spark, SF), page=2, limit=10).items
    shape = tree(items)
    assert "TakeOrderedAndProject" in shape and "Sort" not in shape.replace("TakeOrderedAndProject", "")


def test_no_cross_join_for_shares(spark):
    enriched = stages.enriched(spark, SF)
    for df in (
        silver.additive_profile(enriched),
        gold.additive_mart(enriched),
        silver.clean_products(stages.bronze_products(spark, SF)),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_date_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "dated")
    for day in (1, 2, 3):
        write_dated(stamp_date(spark.range(10), date(2024, 5, day)), path)
    text = plan(read_dated(spark, path, date(2024, 5, 2)))
    assert re.search(r"PartitionFilters: \[.*day.* = 2", text)
    assert read_dated(spark, path, date(2024, 5, 2)).inputFiles() != []


def test_filters_and_columns_reach_the_scan(spark):
    page = serving.sugar_page(stages.sugar_mart(spark, SF), category="promo", min_sugars=10)
    text = plan(page.items)
    assert "EqualTo(category,promo)" in text and "GreaterThanOrEqual(sugars_100g,10" in text
    grades = serving.grade_page(stages.grade_mart(spark, SF), grade="c")
    assert "EqualTo(nutrition_grade_fr,C)" in plan(grades.items)
    means = plan(silver.category_profile(stages.enriched(spark, SF)))
    read = re.search(r"ReadSchema: struct<(.*?)>", means).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "code", "energy_100g", "fat_100g", "main_category", "salt_100g", "sugars_100g",
    }


def test_sugar_mart_reads_its_columns_only(spark):
    text = plan(gold.sugar_mart(stages.enriched(spark, SF)))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert len(read.split(",")) == 5
