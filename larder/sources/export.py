"""Ordered CSV export for spreadsheet and BI tools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"


def export_csv(
    df: DataFrame, path: str, order: Sequence[str], single_file: bool = False
) -> int:
    """Write ``df`` as CSV sorted by ``order``: header, UTF-8 with BOM, CRLF line ends.

    The result is one or more files, each with the header; file names follow the sort
    order, so the files read in name order are the sorted result.  ``single_file`` asks for
    exactly one, which one task sorts and writes.  Returns the rows written.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    ordered = df.repartition(1).sortWithinPartitions(*keys) if single_file else df.orderBy(*keys)
    first, *others = df.columns
    written = Observation()
    marked = ordered.select(F.col(first).alias(BYTE_ORDER_MARK + first), *others).observe(
        written, F.count(F.lit(1)).alias("rows")
    )
    (
        marked.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("lineSep", "\r\n")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return written.get["rows"]
