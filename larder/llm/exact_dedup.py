"""Exact deduplication with the frequent texts split off.

A Misra-Gries sketch (``approx_top_k``, a DataSketches frequent-items summary) proposes
digests that may be frequent.  An exact count verifies them; the verified winners, at
most ``HEAVY`` rows, are broadcast and resolve their copies on the map side.  A digest that
is not a winner has few copies (no more than ``1 / HEAVY`` of the rows and the sketch's
error), so the rest goes through one ordinary shuffle by digest.

Both ways give the same rows, so which digests win changes only where the work is done.

* Null text counts as empty; all empty texts are equal.
* Of equal texts the largest ``doc_id`` stays; a null ``doc_id`` stays only where no copy
  has an id.
* Rows that repeat a ``doc_id`` and its text are one document: all of them get its verdict,
  and all of them count in ``group_size``.
* An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.tables import ascii_lower, stored, text_or_empty, whole_row

#: Most digests broadcast (33 bytes each and an id), and counters of the sketch.
HEAVY, COUNTERS = 1024, 16384


def text_digest() -> F.Column:
    return F.unhex(F.sha2(ascii_lower(text_or_empty()), 256))


def frequent_digests(digests: DataFrame) -> DataFrame:
    """Exact size and largest id of the digests that the sketch proposes; ``HEAVY`` rows at most."""
    proposed = digests.agg(F.expr(f"approx_top_k(hex(digest), {HEAVY}, {COUNTERS})").alias("top"))
    proposed = proposed.select(F.explode("top").alias("top")).select(
        F.unhex("top.item").alias("digest")
    )
    return (
        digests.join(F.broadcast(proposed), "digest")  # HEAVY rows at most
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = stored(docs.select("doc_id", text_digest().alias("digest")), "digests")
    winners = stored(frequent_digests(digests), "frequent")
    heavy = digests.join(F.broadcast(winners), "digest")  # HEAVY rows at most
    rest = digests.join(F.broadcast(winners), "digest", "left_anti")
    same = Window.partitionBy("digest")
    light = rest.select(
        "digest",
        "doc_id",
        F.max("doc_id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
    )
    return heavy.unionByName(light).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns as they are."""
    verdicts = exact_groups(docs).filter("not kept").select("doc_id", "text_sha256").distinct()
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col("doc_id").alias("id"),
        F.lower(F.hex(text_digest())).alias("sha"),
    )
    dropped = rows["id"].eqNullSafe(verdicts["doc_id"]) & (rows["sha"] == verdicts["text_sha256"])
    return rows.join(verdicts, dropped, "left_anti").select("row.*")
