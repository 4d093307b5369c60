"""Delimited text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_text_table(
    spark: SparkSession, path: str, sep: str = "\t", encoding: str = "utf-8"
) -> DataFrame:
    """Header row, every column a string, one record per line.

    Short lines are padded with NULL and surplus fields dropped.  The file is not
    scanned for types, and single-line records let one large file be split.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("inferSchema", False)
        .option("multiLine", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_typed_table(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "utf-8",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Header row, types from ``schema``, else inferred.

    Inference reads the file a second time, so leave ``schema`` out for small
    reference files only.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
    )
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)
