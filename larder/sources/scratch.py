"""Intermediate results written to the shared folder the session names.

The folder is ``spark.checkpoint.dir``.  A machine-local temporary folder is used
only when that setting is absent and the session runs in local mode.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_AUTO_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
#: Files that a task of a bucketed write keeps open before it sorts its rows by bucket.
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root and root.startswith("file:") and not _is_local(spark):
        raise ValueError(f"{_SETTING} is a machine's own folder: {root}")
    if root:
        return f"{root.rstrip('/')}/larder/{spark.sparkContext.applicationId}"
    if not _is_local(spark):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="larder-")
    return _local_roots[app]


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def discard_scratch(spark: SparkSession) -> None:
    """Delete what this application stored, databases in its scratch folder included."""
    root = shared_folder(spark)
    for database in spark.catalog.listDatabases():
        if database.locationUri and root in database.locationUri:
            spark.sql(f"DROP DATABASE `{database.name}` CASCADE")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored rows.

    Ends the lineage in files that outlive any executor, and gives the planner the
    true size of the result, so joins to it are broadcast only when it is small.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_bucketed(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """``store`` in ``buckets`` by the hash of ``column``; grouping by it later needs no shuffle.

    Rows that are dealt by ``column`` to as many partitions already, or read from as many such
    buckets, give one file each; so a bucketed source is read bucket by bucket, and nothing is
    sorted where a task meets few buckets.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{path}'")
    during = {_AUTO_BUCKETS: "false", _OPEN_FILES: "4"}
    before = {option: spark.conf.get(option) for option in during}
    for option, value in during.items():
        spark.conf.set(option, value)
    try:
        writer = df.write.format("parquet").option("compression", "zstd")
        writer.bucketBy(buckets, column).saveAsTable(f"{name}.rows")
    finally:
        for option, value in before.items():
            spark.conf.set(option, value)
    return spark.table(f"{name}.rows")
