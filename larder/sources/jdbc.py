"""Relational tables over JDBC.  Connection details always come from the caller."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.schemas import JDBC_BATCH_ROWS

CONNECTIONS = 8  # open at once while writing


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    batch_rows: int = JDBC_BATCH_ROWS

    def properties(self) -> dict[str, str]:
        pairs = {
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "batchsize": str(self.batch_rows),
        }
        return {name: value for name, value in pairs.items() if value}


def write_jdbc(
    df: DataFrame,
    database: Database,
    table: str,
    mode: str = "overwrite",
    connections: int = CONNECTIONS,
) -> None:
    """Write ``df``; ``overwrite`` drops and recreates the table from the DataFrame schema.

    Every task opens a connection, so ``connections`` bounds how many run at once.
    """
    writer = df.write.mode(mode).option("numPartitions", connections)
    writer.jdbc(url=database.url, table=table, properties=database.properties())


def read_jdbc(
    spark: SparkSession,
    database: Database,
    table: str,
    order: Sequence[str] = (),
    slices: Sequence[str] = (),
) -> DataFrame:
    """Whole table, ordered by ``order`` with NULLs last.

    ``slices`` are predicates that part the table, one task each; without them one
    task reads it all, which suits small marts only.
    """
    if slices:
        df = spark.read.jdbc(
            database.url, table, predicates=list(slices), properties=database.properties()
        )
    else:
        df = spark.read.jdbc(database.url, table, properties=database.properties())
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in order)) if order else df
