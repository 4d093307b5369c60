"""Wide rows are sorted in small parts and shuffled once on their way to the marts."""

import contextlib
import io

from pyspark.sql import functions as F

from larder.operators.ranking import keep_one, keep_one_of_rare, total_order
from larder.operators.shape import PART_BYTES, partitions_for
from larder.plans import gold, silver
from larder.sources import lake, scratch
from larder.workload import registry, stages

SF = "/root/testdata/sf0.001"


def tree(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue().split("\n\n\n")[0]


def test_cleaning_deals_rare_codes_before_it_sorts(spark):
    shape = tree(silver.clean_products(stages.bronze_products(spark, SF)))
    rare = shape[: shape.index("BroadcastExchange")]  # the first branch of the union
    assert rare.count("Sort") == 1 and rare.index("Sort") < rare.index("Exchange")


def test_rare_and_frequent_keys_keep_the_same_rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
    rows = spark.range(20_000, numPartitions=5).select(
        F.when((F.col("id") % 3 == 0) | (F.col("id") % 7 == 0), key)
        .otherwise((F.col("id") % 4_000).cast("string")).alias("code"),
        F.xxhash64("id").alias("v"),
    )
    order = total_order(rows, "v")
    plain = keep_one(rows, ["code"], order)
    for partitions in (None, 3):
        dealt = keep_one_of_rare(rows, "code", order, partitions)
        assert sorted(dealt.collect(), key=str) == sorted(plain.collect(), key=str)
    empty = rows.limit(0)
    assert keep_one_of_rare(empty, "code", order).count() == 0


def test_partitions_follow_the_size_of_the_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(200_000).select(F.rand(1).alias("a")).write.parquet(path)
    files = spark.read.parquet(path)
    at_least = spark.sparkContext.defaultParallelism
    assert partitions_for(files) == at_least
    assert partitions_for(files, 1 << 14) > partitions_for(files, 1 << 15) > at_least
    assert PART_BYTES > 1 << 15


def test_features_of_stored_rows_need_no_shuffle(spark):
    assert "Exchange" not in tree(gold.feature_mart(stages.enriched(spark, SF)))


def test_contract_check_builds_the_feature_mart_once(spark, monkeypatch):
    built, build = [], gold.feature_mart
    monkeypatch.setattr(gold, "feature_mart", lambda rows: built.append(1) or build(rows))
    monkeypatch.setattr(stages, "_stored", {})
    registry.mart_contract_check(spark, SF).collect()
    assert len(built) == 1


def test_bronze_of_one_date_is_not_sorted_by_date(spark, monkeypatch):
    written, write = [], lake.write_dated
    monkeypatch.setattr(lake, "write_dated", lambda *a, **k: written.append(1) or write(*a, **k))
    registry.volume_gate(spark, SF).collect()
    assert written == []


def test_sugar_rank_stores_narrow_rows(spark, monkeypatch):
    ranked, rank = [], silver.rank_in_group
    monkeypatch.setattr(silver, "rank_in_group", lambda df, *a, **k: ranked.append(df.columns) or rank(df, *a, **k))
    registry.sugar_rank_in_category(spark, SF)
    assert [len(columns) for columns in ranked] == [4]


def test_additive_marts_do_not_store_the_enriched_rows(spark, monkeypatch):
    monkeypatch.setattr(stages, "_stored", {})
    ranked = registry.additive_ranking(spark, SF).collect()
    assert ranked == stages.additive_mart(spark, SF).orderBy("rank_overall").collect()
    assert "products_enriched" not in {stage for _, _, stage in stages._stored}
    assert ranked == gold.additive_mart(stages.enriched(spark, SF)).orderBy("rank_overall").collect()


def test_bucketed_writes_keep_few_files_open_instead_of_sorting(spark, monkeypatch):
    seen, put = {}, type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: seen.setdefault(k, v) and put(self, k, v))
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option)
    rows = spark.range(1_000, numPartitions=2).select(F.col("id").cast("string").alias("code"))
    for buckets in (3, 16):  # fewer than the open files, and more
        stored = scratch.store_bucketed(rows, "few", "code", buckets)
        assert sorted(stored.collect()) == sorted(rows.collect())
        assert "Exchange" not in tree(stored.groupBy("code").count())
    assert int(seen[option]) > 3 and spark.conf.get(option) == before
