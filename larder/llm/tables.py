"""Reading the corpus tables and the conventions every operator here shares.

Operators take a DataFrame of documents and use only the columns they name (``doc_id``,
``text``, ``source``, ``lang``).  The whole input row travels in one struct column, so
extra columns may have any name.  A null text is an empty text.
"""

from __future__ import annotations

import ctypes
import gc
import os
import string
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import larder
from larder.sources.scratch import new_path, shared_folder, store

#: A word is a run of characters other than space, tab and the four other line breaks.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the application, once, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    handle, path = tempfile.mkstemp(prefix="larder-", suffix=".zip")
    root = Path(larder.__file__).parent
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as package:
        for module in sorted(root.rglob("*.py")):
            package.write(module, module.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])


def bounded_sample(df: DataFrame, keys: list[str], n: int, total: int, seed: int = 20240601) -> DataFrame:
    """At most ``n`` of the ``total`` rows of ``df``, those of smallest hash of ``keys``.

    Only rows whose hash is low enough for about ``2 * n`` of them are sorted, so that no
    task sends ``n`` rows however many tasks there are.
    """
    steps = 1 << 30
    low = steps if 2 * n >= total else max(steps * 2 * n // total, 1)
    order = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(steps))
    return df.filter(order < low).orderBy(order, *keys).limit(n)


def release_memory() -> None:
    """Give memory that Python no longer uses back to the system, where its C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; ``compression`` as Parquet names it.

    The shuffles that made it are no longer needed then; collecting the driver's garbage
    lets Spark delete their files at once instead of at some later time.
    """
    spark = df.sparkSession
    ship_package(spark)
    if compression is None:
        out = store(df, label)
    else:
        path = new_path(spark, label)
        df.write.option("compression", compression).parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    del df
    release_memory()
    spark.sparkContext._jvm.System.gc()
    return out


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> Iterator[None]:
    """Send Python workers batches of at most so many rows and bytes for what runs inside.

    The JVM and the worker each hold a batch of what goes in and of what comes out, beside the
    heap, so large columns need smaller batches than Spark's.  The session's settings return.
    """
    wanted = {"maxRecordsPerBatch": str(rows), "maxBytesPerBatch": size}
    wanted = {f"spark.sql.execution.arrow.{name}": value for name, value in wanted.items()}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables, as ``stored`` gave them, that nothing will read any more."""
    for table in tables:
        spark = table.sparkSession
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        inside = files.makeQualified(root).toUri().getPath()
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            if not path.toUri().getPath().startswith(f"{inside}/"):
                raise ValueError(f"{folder} is not in the folder for stored tables")
            files.delete(path, True)
