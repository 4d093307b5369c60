"""Mixing sources to target weights by a hypergeometric splitting tree.

1. Every source is cut into ``BLOCKS`` blocks by a seeded hash of doc_id, or of the text of
   rows without one.
2. Target words per source: its weight's share of ``SHARE`` times all words, at most
   ``MOST`` times its own words; what is over is shared again by weight.  The water level is
   found in closed form over the sources sorted by the level at which they fill up.
3. A source gives whole copies of itself while its target allows, then blocks in permuted
   order while they fit, then the one document closest in size to what is missing.
   Documents are taken whole.
4. The block quotas of all sources stand at the root of a binary tree.  Each node halves its
   number of draws and deals every source's quota to its children by successive
   hypergeometric draws, down to ``2 ** levels`` output shards.
5. A source's block copies in permuted order fill its shares of the shards one after the
   other, so the draws are disjoint; each shard is put in order by a seeded hash.

All draws come from hashes of the seed, so reruns agree.  Quotas, blocks and the tree are
tables of the sources and ``BLOCKS``, not of the documents; a hot source is spread over its
blocks, and its sums are combined before the shuffle.

* A null text has size 0.  A null source is a source of its own and comes last.
* Sources without words have target 0.  An empty table gives no rows.
* Rows that repeat a doc_id within a source are taken together, as are rows without an id of
  equal text, whatever their number.  A row without an id is never the closest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.tables import WORD, stored, text_or_empty, whole_row

#: Blocks per source, levels of the tree, the mix's words over all words, most copies.
BLOCKS, LEVELS, SHARE, MOST = 512, 4, 1.5, 2
WEIGHTS = (5, 2, 1)
SEED = 20240601


def _name(text: str = "text") -> list[Column]:
    """What a row is hashed by: its doc_id, else its text.  Hashes pass over nulls."""
    return [F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col(text))]


def _block() -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), *_name()), F.lit(BLOCKS)).cast("int")


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, words and block of every document."""
    words = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), _block().alias("block"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: sid (from 1, by code point), source, weight, source_size, target."""
    everything = Window.orderBy("sid").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    )
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    sources = sources.withColumn(
        "weight", F.element_at(weights, (F.col("sid") - 1) % len(WEIGHTS) + 1)
    ).withColumn("most", (F.col("source_size") * MOST).cast("double"))
    sources = sources.withColumn("fills_at", F.col("most") / F.col("weight"))
    by_level = Window.orderBy("fills_at", "sid")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * SHARE
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(
        onwards
    )
    sources = sources.withColumn("level", level)
    # Sources fill up in order of fills_at; the first that does not fill sets the level.
    reached = F.min(F.when(F.col("level") < F.col("fills_at"), F.struct("fills_at", "sid", "level")))
    return sources.withColumn("water", reached.over(everything)["level"]).select(
        "sid",
        "source",
        "weight",
        "source_size",
        F.when(F.col("water").isNull(), F.col("most"))
        .otherwise(F.least("most", F.col("water") * F.col("weight")))
        .alias("target"),
    )


def _copies() -> Column:
    return F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST)).cast("int")
    )


def _chosen_blocks(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Blocks of each source with how often they are taken and what is still missing."""
    blocks = sized.groupBy("sid", "block").agg(F.sum("size").alias("block_size"))
    blocks = blocks.join(targets, "sid").withColumn("copies", _copies())
    permuted = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(SEED + 1), "sid", "block"), "block")
    fitted = permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("sid")
    blocks = blocks.withColumn(
        "wanted", F.col("target") - F.col("copies") * F.col("source_size")
    ).withColumn("more", F.sum("block_size").over(fitted) <= F.col("wanted"))
    filled = F.sum(F.when(F.col("more"), F.col("block_size")).otherwise(F.lit(0))).over(whole)
    return blocks.select(
        "sid",
        "block",
        "copies",
        "more",
        F.when(F.col("copies") < MOST, F.col("wanted") - filled).otherwise(F.lit(0.0)).alias("missing"),
    )


def _closest_documents(sized: DataFrame, chosen: DataFrame) -> DataFrame:
    """Per source the untaken document that brings it closest to its target, if any does."""
    left = sized.join(chosen.filter("not more and missing > 0"), ["sid", "block"])
    off = F.abs(F.col("size") - F.col("missing"))
    return (
        left.filter(F.col("doc_id").isNotNull() & (off < F.col("missing")))
        .groupBy("sid")
        .agg(F.min(F.struct(off.alias("off"), "doc_id")).alias("best"))
        .select("sid", F.col("best.doc_id").alias("fill_id"))
    )


def _split(counts: str, node: str) -> str:
    """SQL: of ``counts`` (per source) those that go to the left child of ``node``.

    Of ``rest`` draws not yet dealt, ``left`` go left.  Each draw of source i goes left with
    probability (left still to fill) / (draws still to deal): a hypergeometric draw.
    """
    uniform = f"pmod(xxhash64({SEED + 2}, {node}, i, d), 1073741824) / 1073741824.0D"
    draw = f"""aggregate(sequence(1L, {counts}[i]), struct(acc.rest as rest, acc.left as left),
        (at, d) -> struct(
            at.rest - 1 as rest,
            at.left - IF({uniform} * at.rest < at.left, 1L, 0L) as left))"""
    step = f"""IF({counts}[i] = 0,
        struct(acc.rest as rest, acc.left as left, array_append(acc.taken, 0L) as taken),
        transform(array({draw}), at -> struct(
            at.rest as rest, at.left as left,
            array_append(acc.taken, acc.left - at.left) as taken))[0])"""
    total = f"aggregate({counts}, 0L, (a, x) -> a + x)"
    return f"""aggregate(sequence(0, size({counts}) - 1),
        struct({total} as rest, {total} div 2 as left, cast(array() as array<bigint>) as taken),
        (acc, i) -> {step}).taken"""


def shard_quotas(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(sid, quota) dealt out to shards: (shard, sid, quota), by the splitting tree."""
    ordered = F.array_sort(F.collect_list(F.struct("sid", "quota")))
    tree = quotas.agg(ordered.alias("all")).select(
        F.lit(1).alias("node"), F.col("all.sid").alias("sids"), F.col("all.quota").alias("counts")
    )
    tree = tree.filter(F.size("sids") > 0)
    for _ in range(levels):
        tree = tree.selectExpr("node", "sids", "counts", f"{_split('counts', 'node')} as drawn")
        tree = tree.selectExpr(
            "sids",
            "explode(array(struct(node * 2 as node, drawn as counts), struct(node * 2 + 1 as node, "
            "zip_with(counts, drawn, (a, b) -> a - b) as counts))) as child",
        ).select("child.node", "sids", "child.counts")
    leaf = tree.selectExpr(f"node - {2**levels} as shard", "explode(arrays_zip(sids, counts)) as q")
    return leaf.select("shard", "q.sids", "q.counts").toDF("shard", "sid", "quota")


def block_draws(sizes: DataFrame, targets: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """The drawn blocks (sid, block, shards: one for each time it is taken) and the closest documents."""
    same = sizes["source"].eqNullSafe(targets["source"])
    sized = sizes.join(targets.select("sid", "source"), same).select("sid", "doc_id", "size", "block")
    chosen = stored(_chosen_blocks(sized, targets), "mix-blocks")
    fills = stored(_closest_documents(sized, chosen), "mix-fills")
    times = chosen.select(
        "sid", "block", (F.col("copies") + F.col("more").cast("int")).alias("times")
    ).unionByName(
        fills.join(chosen.groupBy("sid").agg(F.max("copies").alias("copies")), "sid").select(
            "sid", F.lit(BLOCKS).alias("block"), (F.col("copies") + 1).alias("times")
        )
    )
    instances = times.filter("times > 0").select(
        "sid", "block", F.explode(F.sequence(F.lit(1), "times")).alias("copy")
    )
    permuted = Window.partitionBy("sid").orderBy(
        F.xxhash64(F.lit(SEED + 3), "sid", "block", "copy"), "block", "copy"
    )
    instances = instances.withColumn("place", F.row_number().over(permuted))
    quotas = shard_quotas(
        instances.groupBy("sid").agg(F.count(F.lit(1)).alias("quota")), levels
    )
    upto = Window.partitionBy("sid").orderBy("shard")
    shares = (
        quotas.withColumn("end", F.sum("quota").over(upto))
        .filter("quota > 0")
        .selectExpr(
            "sid", "shard", "explode(sequence(cast(end - quota + 1 as int), cast(end as int))) as place"
        )
    )
    drawn = instances.join(shares, ["sid", "place"])
    drawn = drawn.groupBy("sid", "block").agg(F.array_sort(F.collect_list("shard")).alias("shards"))
    return stored(drawn, "mix-draws"), fills


def _with_draws(rows: DataFrame, drawn: DataFrame, fills: DataFrame) -> DataFrame:
    """``rows`` (sid, doc_id, block, ...) with the shards that take each."""
    rows = rows.join(fills, "sid", "left").withColumn(
        "block", F.when(F.col("doc_id") == F.col("fill_id"), BLOCKS).otherwise(F.col("block"))
    )
    return rows.drop("fill_id").join(drawn, ["sid", "block"], "left")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted)."""
    sizes = stored(document_sizes(docs), "mix-sizes")
    targets = stored(source_targets(sizes), "mix-targets")
    drawn, fills = block_draws(sizes, targets)
    same = sizes["source"].eqNullSafe(targets["source"])
    rows = sizes.join(targets, same).select(
        "sid", "doc_id", "block", "size", "source_size", "target"
    )
    times = F.coalesce(F.size("shards"), F.lit(0))
    return _with_draws(rows, drawn, fills).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mix(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The mix: all columns of ``docs`` once per time a row is taken, in shuffled order.

    Rows are range-partitioned by shard and a seeded hash and sorted by them, so each
    shard is a run of partitions, however large it is.
    """
    sizes = stored(document_sizes(docs), "mix-sizes")
    targets = stored(source_targets(sizes), "mix-targets")
    drawn, fills = block_draws(sizes, targets, levels)
    rows = docs.select(
        whole_row(docs).alias("row"), "doc_id", F.col("source").alias("from"), _block().alias("block")
    )
    same = rows["from"].eqNullSafe(targets["source"])
    rows = rows.join(targets.select("sid", "source"), same).select("row", "sid", "doc_id", "block")
    taken = _with_draws(rows, drawn, fills).select(
        "row", "doc_id", F.posexplode("shards").alias("copy", "shard")
    )
    order = F.xxhash64(F.lit(SEED + 4), "shard", *_name("row.text"), "copy")
    return (
        taken.withColumn("order", order)
        .repartitionByRange("shard", "order")
        .sortWithinPartitions("shard", "order")
        .select("row.*")
    )
