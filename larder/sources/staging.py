"""Replacing one ingest date, in its folder and in a table, only once the new rows are written.

The rows of a date are written beside it, under a folder that readers do not list.  When they
are complete, and where there is a table its next version too, a marker commits the
replacement; renames then put the new version in the place of the old one.

A run that fails before the marker changes nothing.  One that stops after it is finished by the
next ``settle``, which every replacement begins with: each step looks at what is there, so the
steps can be repeated from any point.  Between the two renames the date is briefly absent.

One writer at a time may replace a date.  On a store without folder renames they are copies.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

#: Hidden from readers by the underscore; holds one folder for each date being replaced.
STAGING = "_replacing"
_NEXT, _OLD = "__next", "__old"


class _Folders:
    """The file system calls that a replacement needs, on any store Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._store.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        self._store.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._store.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._store.delete(self._path(path), True)

    def write_line(self, path: str, line: str) -> None:
        """All of it or nothing: written under another name, then renamed."""
        out = self._store.create(self._path(f"{path}.part"), True)
        out.writeUTF(line)
        out.close()
        self.rename(f"{path}.part", path)

    def read_line(self, path: str) -> str:
        source = self._store.open(self._path(path))
        line = source.readUTF()
        source.close()
        return line


class Replacement:
    """The replacement of one date under ``path`` by rows still to be written."""

    def __init__(self, spark: SparkSession, path: str, ingest_date: date, date_folder: str):
        self._spark, self._folders = spark, _Folders(spark, path)
        self._date = date_folder
        self._work = f"{path}/{STAGING}/{ingest_date.isoformat()}"
        self._old, self._marker = f"{self._work}/old", f"{self._work}/committed"
        #: Where the new rows of the date go.
        self.folder = f"{self._work}/new"

    def settle(self) -> None:
        """Finish a committed replacement, and drop one that was not."""
        if self._folders.exists(self._marker):
            self._swap_folder()
            table = self._folders.read_line(self._marker)
            if table:
                swap_table(self._spark, table)
            # The marker goes last: until then these steps can be repeated.
            self._folders.delete(self._old)
            self._spark.catalog.refreshByPath(self._date)
        elif self._folders.exists(self._old):
            raise OSError(f"{self._old} holds rows of a replacement whose marker is gone")
        self._folders.delete(self._work)

    def commit(self, table: str = "") -> None:
        """From here on the new rows count; ``table`` has its next version ready."""
        self._folders.write_line(self._marker, table)
        self.settle()

    def drop(self) -> None:
        """Give up the new rows; the date stays as it was."""
        if not self._folders.exists(self._marker):
            self._folders.delete(self._work)

    def _swap_folder(self) -> None:
        if self._folders.exists(self.folder):
            if self._folders.exists(self._date):
                self._folders.rename(self._date, self._old)
            self._folders.rename(self.folder, self._date)


def put_in_place(spark: SparkSession, new: str, target: str) -> None:
    """Let the folder ``new`` take the place of ``target``, which it may read or not find.

    If a run stops between the two renames, ``target`` is absent until the next run.
    """
    folders, old = _Folders(spark, target), f"{new}{_OLD}"
    folders.delete(old)
    if folders.exists(target):
        folders.rename(target, old)
    folders.rename(new, target)
    folders.delete(old)
    spark.catalog.refreshByPath(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    _Folders(spark, path).delete(path)


def next_table(table: str) -> str:
    """Name under which the next version of ``table`` is written."""
    return f"{table}{_NEXT}"


def swap_table(spark: SparkSession, table: str) -> None:
    """Put the next version of a managed table in its place; repeatable from any point."""
    new, old = next_table(table), f"{table}{_OLD}"
    if spark.catalog.tableExists(new):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.catalog.refreshTable(table)


def check_same(path_rows: DataFrame, table_rows: DataFrame, name: str) -> int:
    """The rows of both copies, counted from Parquet footers; raises where columns or counts differ."""
    columns = [(f.name, f.dataType) for f in path_rows.schema], [(f.name, f.dataType) for f in table_rows.schema]
    counts = path_rows.count(), table_rows.count()
    if columns[0] != columns[1] or counts[0] != counts[1]:
        raise ValueError(f"{name} has {counts[1]} rows and its path {counts[0]}, or other columns")
    return counts[0]
