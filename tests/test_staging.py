"""Replacing a date: what a run leaves that fails or stops at any step."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from larder.plans import gold
from larder.sources import lake, staging, tables
from larder.sources.lake import read_dated, write_date
from larder.sources.scratch import new_path

DAY, OTHER = date(2024, 5, 14), date(2024, 5, 13)


def breaking(spark, rows):
    """``rows`` numbers; the task that reaches the last one fails after others are written."""
    last = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("planned"))).otherwise(F.col("id"))
    return spark.range(rows).repartition(4).withColumn("id", last.cast("bigint"))


@pytest.fixture
def published(spark):
    path = new_path(spark, "staged")
    database = new_path(spark, "staged_db").rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_database(spark, database, new_path(spark, "staged_db_files"))
    name = f"{database}.numbers"
    tables.publish_twice(spark.range(3), path, name, OTHER)
    assert tables.publish_twice(spark.range(5), path, name, DAY) == 5
    return path, name


def copies(spark, path, name):
    schema = spark.range(1).schema
    dated = [sorted(r.id for r in read_dated(spark, path, d, schema).collect()) for d in (DAY, OTHER)]
    assert dated[1] == [0, 1, 2]
    return dated[0], sorted(r.id for r in spark.table(name).collect())


def test_a_failed_task_keeps_the_date(spark, tmp_path):
    path = str(tmp_path / "dated")
    write_date(spark.range(5), path, DAY)
    with pytest.raises(Exception, match="planned"):
        write_date(breaking(spark, 1000), path, DAY)
    assert read_dated(spark, path, DAY).count() == 5
    write_date(read_dated(spark, path, DAY).select((F.col("id") + 10).alias("id")), path, DAY)
    assert sorted(r.id for r in read_dated(spark, path, DAY).collect()) == [10, 11, 12, 13, 14]
    write_date(spark.range(0), path, DAY)
    assert read_dated(spark, path, DAY, spark.range(1).schema).count() == 0


def test_a_failed_task_keeps_both_copies(spark, published):
    with pytest.raises(Exception, match="planned"):
        tables.publish_twice(breaking(spark, 1000), *published, DAY)
    assert copies(spark, *published) == ([0, 1, 2, 3, 4],) * 2


def test_copies_that_differ_are_not_committed(spark, published, monkeypatch):
    write = tables.overwrite_table
    monkeypatch.setattr(tables, "overwrite_table", lambda df, name: write(df.limit(2), name))
    with pytest.raises(ValueError, match="2 rows and its path 7"):
        tables.publish_twice(spark.range(7), *published, DAY)
    assert copies(spark, *published) == ([0, 1, 2, 3, 4],) * 2


@pytest.mark.parametrize("step", range(7))
def test_a_run_that_stops_is_finished_or_dropped(spark, published, monkeypatch, step):
    """Stop before the nth rename, deletion or table swap; the next run's first step mends it."""
    calls = 0

    def counted(call):
        def wrapper(*args):
            nonlocal calls
            calls += 1
            if calls > step:
                raise KeyboardInterrupt
            return call(*args)

        return wrapper

    with monkeypatch.context() as patch:
        patch.setattr(staging._Folders, "rename", counted(staging._Folders.rename))
        patch.setattr(staging._Folders, "delete", counted(staging._Folders.delete))
        patch.setattr(staging, "swap_table", counted(staging.swap_table))
        with pytest.raises(KeyboardInterrupt):
            tables.publish_twice(spark.range(7), *published, DAY)
    lake.replace_date(spark, published[0], DAY)
    committed = step >= 2  # the first call deletes leftovers, the second writes the marker
    assert copies(spark, *published) == (list(range(7 if committed else 5)),) * 2
    assert tables.publish_twice(spark.range(9), *published, DAY) == 9
    assert copies(spark, *published) == (list(range(9)),) * 2


def test_swapping_a_table_can_be_repeated(spark, published):
    _, name = published
    for rows in (4, 6):
        tables.overwrite_table(spark.range(rows), staging.next_table(name))
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")  # as if stopped between the renames
        staging.swap_table(spark, name)
        staging.swap_table(spark, name)
        assert spark.table(name).count() == rows
    assert not spark.catalog.tableExists(f"{name}__old")


def test_a_mart_with_a_repeated_code_is_refused(spark, golden, tmp_path, monkeypatch):
    path, name = str(tmp_path / "marts"), "dm_ml_nutriscore_prediction"
    before = gold.publish_marts(golden.enriched, path).raise_on_error().results[name]
    once = gold.feature_mart
    monkeypatch.setattr(gold, "feature_mart", lambda enriched: once(enriched).union(once(enriched).limit(1)))
    report = gold.publish_marts(golden.enriched, path)
    assert list(report.errors) == [name] and "1 rows repeat" in report.errors[name] and len(report.results) == 3
    assert gold.read_mart(spark, path, name).count() == before
    monkeypatch.undo()
    assert gold.publish_marts(golden.enriched, path, [name]).raise_on_error().results[name] == before
