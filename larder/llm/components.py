"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the smallest node reachable.

    Each round gives every node the smallest label among itself and its neighbours, then
    the label of its label, so a chain of n links takes about log n rounds.  A node with very
    many links is combined before the shuffle; rounds are stored, not kept in lineage.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("comp")).select(
            F.col("a").alias("node"), F.least("a", "comp").alias("comp")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("comp").alias("near"))
            .withColumnRenamed("a", "node")
        )
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("further"))
        new = stored(
            lower.join(jump, "low").select(
                "node", F.least("low", "further").alias("comp"), (F.least("low", "further") < F.col("comp")).alias("changed")
            ),
            "labels",
        )
        labels = new.select("node", "comp")
        if new.filter("changed").isEmpty():
            return labels
