from datetime import date
from unittest.mock import MagicMock

import golden_data
import pytest
from pyspark.sql import functions as F

from larder import __main__ as cli
from larder.operators.shape import stamp_date
from larder.plans import bronze, gold, silver
from larder.plans.runner import run_steps
from larder.schemas import MART_LOOKUP_COLUMNS, MART_SCHEMAS, MART_SORT_KEYS
from larder.sources import scratch
from larder.sources.delimited import read_text_table
from larder.sources.export import export_csv
from larder.sources.jdbc import Database, read_jdbc, write_jdbc
from larder.sources.lake import read_dated, write_clustered, write_date, write_dated
from larder.sources.tables import ensure_database, list_databases, tables_exist

FIRST, SECOND = date(2024, 5, 13), date(2024, 5, 14)


def test_ragged_rows(spark, tmp_path):
    file = tmp_path / "ragged.tsv"
    file.write_text('a\tb\tc\n1\t"say ""hi"""\n2\tx\ty\tz\n3\t\t\n', encoding="utf-8")
    assert [tuple(r) for r in read_text_table(spark, str(file)).collect()] == [
        ("1", 'say "hi"', None), ("2", "x", "y"), ("3", None, None),
    ]


def test_rerun_replaces_only_its_date(spark, tmp_path):
    path = str(tmp_path / "dated")
    write_dated(stamp_date(spark.range(5), FIRST), path)
    write_dated(stamp_date(spark.range(7), SECOND), path)
    write_dated(stamp_date(spark.range(2), SECOND), path)
    assert read_dated(spark, path, FIRST).count() == 5
    assert read_dated(spark, path, SECOND).count() == 2


def test_sample_run_is_held_to_the_sample_size(spark, golden):
    targets = {"products": f"{golden.folder}/bronze_p", "countries": f"{golden.folder}/bronze_c"}
    verdicts = bronze.check_volumes(spark, targets, golden_data.DAY, sample_rows=10).collect()
    assert [(r.source, r.rows, r.min_rows, r.ok) for r in verdicts] == [
        ("products", 13, 10, True), ("countries", 5, 200, False),
    ]
    assert not bronze.check_volumes(spark, targets, golden_data.DAY).first().ok


def test_sample_ingest(spark, tmp_path):
    products, _ = golden_data.write_files(str(tmp_path))
    metrics = bronze.ingest_products(spark, products, str(tmp_path / "out"), FIRST, sample_rows=4)
    assert (metrics["rows_read"], metrics["rows_written"]) == (13, 4)
    kept = read_dated(spark, str(tmp_path / "out"), FIRST)
    assert sorted(r.code for r in kept.collect()) == ["001", "001", "002", "003"]


def test_refine_publishes_every_table_twice(spark, golden):
    database = scratch.new_path(spark, "refine").rsplit("/", 1)[-1].replace("-", "_")
    ensure_database(spark, database, scratch.new_path(spark, "refine_db"))
    target = scratch.new_path(spark, "silver")
    rows = silver.refine(
        spark, f"{golden.folder}/bronze_p", f"{golden.folder}/bronze_c", target, database,
        golden_data.DAY,
    )
    assert rows.ok
    assert rows.results == {"products_clean": 7, "countries_clean": 4, "products_enriched": 10}
    assert all(tables_exist(spark, [f"{database}.{name}" for name in rows.results]).values())
    assert database in [r[0] for r in list_databases(spark).collect()]
    stored = spark.table(f"{database}.products_enriched")
    assert stored.count() == read_dated(spark, f"{target}/products_enriched", golden_data.DAY).count()
    assert stored.where("main_category = 'snacks'").agg(F.max("sugar_rank_in_category")).first()[0] == 5


def test_refine_survives_a_failing_rank(spark, golden, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("no rank")

    monkeypatch.setattr(silver, "with_sugar_rank", broken)
    database = scratch.new_path(spark, "norank").rsplit("/", 1)[-1].replace("-", "_")
    ensure_database(spark, database, scratch.new_path(spark, "norank_db"))
    rows = silver.refine(
        spark, f"{golden.folder}/bronze_p", f"{golden.folder}/bronze_c",
        scratch.new_path(spark, "norank_silver"), database, golden_data.DAY,
    )
    assert rows.results["products_enriched"] == 10
    assert rows.errors == {"sugar_rank_in_category": "no rank"}
    ranks = spark.table(f"{database}.products_enriched").select("sugar_rank_in_category")
    assert ranks.dtypes == [("sugar_rank_in_category", "bigint")] and ranks.dropna().count() == 0


def test_refine_survives_a_rank_that_fails_while_it_is_written(spark, golden, monkeypatch):
    def late(df, *_, **__):
        return df.withColumn("sugar_rank_in_category", F.raise_error(F.lit("late")).cast("bigint"))

    monkeypatch.setattr(silver, "with_sugar_rank", late)
    database = scratch.new_path(spark, "laterank").rsplit("/", 1)[-1].replace("-", "_")
    ensure_database(spark, database, scratch.new_path(spark, "laterank_db"))
    report = silver.refine(
        spark, f"{golden.folder}/bronze_p", f"{golden.folder}/bronze_c",
        scratch.new_path(spark, "laterank_silver"), database, golden_data.DAY,
    )
    assert not report.ok and "late" in report.errors["sugar_rank_in_category"]
    ranks = spark.table(f"{database}.products_enriched").select("sugar_rank_in_category")
    assert ranks.count() == 10 and ranks.dropna().count() == 0


def test_empty_rerun_leaves_an_empty_date(spark, tmp_path):
    path = str(tmp_path / "rerun")
    ids = spark.range(5)
    write_date(ids, path, FIRST)
    for rows in (7, 0, 3):
        write_date(spark.range(rows), path, SECOND)
        assert read_dated(spark, path, SECOND, ids.schema).count() == rows
        assert read_dated(spark, path, FIRST, ids.schema).count() == 5


def test_header_only_file_replaces_the_run_before(spark, tmp_path):
    products, _ = golden_data.write_files(str(tmp_path))
    target = str(tmp_path / "out")
    bronze.ingest_products(spark, products, target, FIRST)
    empty = tmp_path / "empty.tsv"
    with open(products, encoding="utf-8") as file:
        empty.write_text(file.readline(), encoding="utf-8")
    metrics = bronze.ingest_products(spark, str(empty), target, FIRST)
    assert (metrics["rows_read"], metrics["rows_written"]) == (0, 0)
    assert not bronze.check_volumes(spark, {"products": target}, FIRST, min_rows={"products": 1}).first().ok


def test_hot_pair_of_the_feature_mart_fills_several_files(spark, tmp_path, uncoalesced):
    path = str(tmp_path / "features")
    rows = spark.range(0, 8000, 1, 4).select(
        F.when(F.col("id") % 5 < 4, "C").otherwise("D").alias("nutrition_grade_fr"),
        F.when(F.col("id") % 5 == 4, F.lit(None)).otherwise(F.lit("snacks")).alias("main_category"),
        F.format_string("%05d", F.col("id")).alias("code"),
    )
    lookup, *spread = MART_LOOKUP_COLUMNS["dm_ml_nutriscore_prediction"]
    write_clustered(rows, path, lookup, spread)
    sizes = [r[1] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * 8000 / len(sizes)


def test_marts_publish_and_export(spark, golden, tmp_path):
    path, output = str(tmp_path / "marts"), str(tmp_path / "csv")
    report = gold.publish_marts(golden.enriched, path, top_n=2).raise_on_error()
    assert report.results == {
        "dm_sugar_by_category": 5, "dm_nutriscore_by_country": 6, "dm_additives_analysis": 4,
        "dm_ml_nutriscore_prediction": 7,
    }
    assert gold.export_marts(spark, path, output, single_file=True).results == report.results
    (file,) = (tmp_path / "csv" / "dm_sugar_by_category").glob("*.csv")
    assert file.read_bytes() == (
        b"\xef\xbb\xbfcategory,product_name,sugars_100g,nutrition_grade_fr,sugar_rank_in_category\r\n"
        b"beverages,Cola,10.6,E,1\r\nbeverages,Water,,B,2\r\nlegumes,Lentils,2.0,A,1\r\n"
        b"snacks,Choco bar,55.5,E,1\r\nsnacks,Biscuit,55.5,D,2\r\n"
    )
    ordered = gold.ordered_mart(spark, path, "dm_ml_nutriscore_prediction")
    codes = [r.code for r in ordered.collect()]
    assert codes == sorted(codes) and set(MART_SORT_KEYS) == set(MART_SCHEMAS)


def test_one_failing_mart_leaves_the_others(golden, tmp_path):
    broken = golden.enriched.drop("additives_tags")
    report = gold.publish_marts(broken, str(tmp_path / "marts"))
    assert list(report.errors) == ["dm_additives_analysis"] and len(report.results) == 3
    with pytest.raises(RuntimeError):
        report.raise_on_error()


def test_large_export_is_ordered_across_files(spark, tmp_path, uncoalesced):
    path = tmp_path / "export"
    rows = spark.range(0, 5000, 1, 4).select((F.lit(4999) - F.col("id")).alias("id"), F.lit('a "b", c').alias("t"))
    assert export_csv(rows, str(path), ["id"]) == 5000
    files = sorted(path.glob("part-*.csv"))
    assert len(files) > 1
    lines = []
    for file in files:
        head, *body = file.read_bytes().decode("utf-8").split("\r\n")
        assert head == "﻿id,t" and body.pop() == ""
        lines += body
    assert lines == [f'{i},"a ""b"", c"' for i in range(5000)]


def test_clustered_files_cover_narrow_ranges(spark, tmp_path, uncoalesced):
    path = str(tmp_path / "clustered")
    df = spark.range(0, 4000, 1, 4).select((F.col("id") * 7919 % 4000).alias("k"), "id")
    write_clustered(df, path, "k", ["id"])
    spans = [(r[1], r[2]) for r in spark.read.parquet(path)
             .groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect()]
    spans.sort()
    assert len(spans) > 1
    assert all(left[1] <= right[0] for left, right in zip(spans, spans[1:]))


def test_runner():
    report = run_steps({"a": lambda: 1, "b": lambda: 1 / 0, "c": lambda: 3})
    assert report.results == {"a": 1, "c": 3} and "b" in report.errors and not report.ok
    assert run_steps({"a": lambda: 1, "b": lambda: 2}, only=["b"]).results == {"b": 2}
    with pytest.raises(ValueError):
        run_steps({"a": lambda: 1}, only=["z"])


def test_database_properties_hide_the_password():
    database = Database("jdbc:x", "some.Driver", "reader", "hidden")
    assert database.properties() == {
        "driver": "some.Driver", "user": "reader", "password": "hidden", "batchsize": "10000",
    }
    assert "hidden" not in repr(database)


def test_jdbc_calls():
    """No database is at hand: only what is handed to Spark is checked."""
    database = Database("jdbc:x", "some.Driver", "writer", "hidden", batch_rows=500)
    frame, session = MagicMock(), MagicMock()
    write_jdbc(frame, database, "t", connections=4)
    frame.write.mode.assert_called_once_with("overwrite")
    writer = frame.write.mode.return_value.option
    writer.assert_called_once_with("numPartitions", 4)
    writer.return_value.jdbc.assert_called_once_with(
        url="jdbc:x", table="t", properties=database.properties()
    )
    read_jdbc(session, database, "t", slices=["k < 10", "k >= 10"])
    session.read.jdbc.assert_called_once_with(
        "jdbc:x", "t", predicates=["k < 10", "k >= 10"], properties=database.properties()
    )


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.new_path(spark, "x")
    if root:
        assert path.startswith(f"{root}/larder/{spark.sparkContext.applicationId}/x-")
    assert scratch.new_path(spark, "x") != path


def test_command_line_runs_the_jobs_in_order(spark, tmp_path):
    products, countries = golden_data.write_files(str(tmp_path))
    database = scratch.new_path(spark, "cli").rsplit("/", 1)[-1].replace("-", "_")
    ensure_database(spark, database, scratch.new_path(spark, "cli_db"))

    def job(*arguments):
        return cli.run(spark, cli.parse([str(a) for a in arguments]))

    dated = ["--date", "2024-05-14"]
    report = job("ingest", "--bronze", tmp_path / "b", "--products", products,
                 "--countries", countries, *dated)
    assert list(report.results) == ["products", "countries"]
    assert sorted(report.errors) == ["volume of countries", "volume of products"]
    report = job("refine", "--bronze", tmp_path / "b", "--silver", tmp_path / "s",
                 "--database", database, *dated)
    assert report.ok and report.results["silver"]["products_enriched"] == 10
    report = job("report", "--bronze", tmp_path / "b", "--database", database, *dated)
    assert report.ok and report.results["countries matched"][0]["matched"] == 8
    assert sum(r["rows"] for r in report.results["products per grade"]) == 7
    assert [r["removed"] for r in report.results["rejected rows"]] == [1, 2, 2, 1]
    assert report.results["most frequent additives"][0]["additive"] == "en:e322"
    # Ten product-country rows, one of them without sugar.
    assert len(report.results["most sugary products"]) == 9
    report = job("marts", "--database", database, "--gold", tmp_path / "g", "--top", 2)
    assert report.ok and report.results["dm_sugar_by_category"] == 5
    report = job("export", "--gold", tmp_path / "g", "--output", tmp_path / "o",
                 "--only", "dm_additives_analysis")
    assert report.results == {"dm_additives_analysis": 4}
    lenient = job("ingest", "--bronze", tmp_path / "b", "--products", products, "--countries", countries,
                  "--min-products", 13, "--min-countries", 5, "--encoding", "utf-8", *dated)
    assert lenient.ok
    missing = job("ingest", "--bronze", tmp_path / "b2", "--products", tmp_path / "none.tsv",
                  "--source", "products", *dated)
    assert "products" in missing.errors and not missing.results
