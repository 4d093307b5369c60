"""Quality rules: rule statistics of whole texts and an isolation forest over them.

Every document gets its rule statistics in one pass over its whole text.  The base rules
reject short texts and texts made of repeats.  An isolation forest gives each document the
mean path length over random splits; short paths mark anomalies.  The share of anomalies to
reject is calibrated on all rows with a quality label that pass the base rules: the threshold
is the one of best balanced accuracy among those that keep ``KEEP`` of the good rows.

* Null and empty texts have no words, fail the base rules and are not kept.
* As the method has it, each tree is grown on ``TREE_ROWS`` rows; each tree draws its own from all
  rows that pass the base rules: those of smallest hash with the tree's number, the same in reruns.
* Without labelled rows of both kinds only the base rules reject.
* Rows that repeat a doc_id and its text get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from larder.llm.nptext import Chunk, Hasher, chunks, mixed, sums, text_of, words
from larder.llm.tables import stored
from larder.operators.ranking import top_n_per_group

TREES, TREE_ROWS, DEPTH = 200, 256, 10
#: Share of labelled good rows that the threshold must keep.
KEEP = 0.995
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
SEED = 20240601

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_marks", "n_chars_seen")
_is_symbol = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_is_mark = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum()])
_is_char = (np.arange(256) & 0xC0) != 0x80


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` occur more than once."""
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[place] > 1


def _in_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mixed(hashes + text.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _repeat_words(hasher: Hasher, starts, ends, firsts) -> np.ndarray:
    n = len(starts)
    if n < 3:
        return np.zeros(n, bool)
    h = hasher.stretches(starts, ends)
    text = text_of(firsts)
    grams = h[:-2] + mixed(h[1:-1] + np.uint64(1)) + mixed(h[2:] + np.uint64(2))
    whole = np.flatnonzero(text[:-2] == text[2:])
    twice = whole[_repeats(_in_text(mixed(grams[whole]), text[whole]))]
    covered = np.zeros(n, bool)
    for offset in range(3):
        covered[twice + offset] = True
    return covered


def _dup_lines(chunk: Chunk, hasher: Hasher, inside_before: np.ndarray) -> np.ndarray:
    """Per text its lines with a word that equal an earlier line of it."""
    breaks = np.flatnonzero(chunk.data == 0x0A)
    starts = np.sort(np.concatenate([chunk.bounds[:-1], breaks + 1]))
    text = np.searchsorted(chunk.bounds, starts, "right") - 1
    # A text that ends in a line break has an empty last line; it holds no word.
    ends = np.append(starts[1:], len(chunk.data))
    is_break = np.zeros(len(chunk.data) + 1, bool)
    is_break[breaks] = True
    ends = ends - ((ends > starts) & is_break[np.maximum(ends - 1, 0)])
    worded = inside_before[ends] > inside_before[starts]
    starts, ends, text = starts[worded], ends[worded], text[worded]
    keys = _in_text(hasher.stretches(starts, ends), text)
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return np.bincount(text, again, minlength=len(chunk.bounds) - 1).astype(np.int64)


def chunk_statistics(chunk: Chunk) -> dict[str, np.ndarray]:
    """The statistics of each text of a chunk."""
    starts, ends, firsts = words(chunk)
    data = chunk.data
    hasher = Hasher(data)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside)[:-1].astype(bool)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=before[1:])
    by_text = chunk.bounds
    return {
        "n_words": np.diff(firsts),
        "word_chars": sums(_is_char[data] & inside, by_text),
        "n_symbols": sums(_is_symbol[data], by_text),
        "n_dup_lines": _dup_lines(chunk, hasher, before),
        "n_repeat_words": sums(_repeat_words(hasher, starts, ends, firsts), firsts),
        "n_marks": sums(_is_mark[data], by_text),
        "n_chars_seen": sums(_is_char[data], by_text),
    }


def statistics() -> Column:
    """Struct of the rule statistics of the column ``text``."""
    names = BASE + EXTRA

    @arrow_udf("struct<" + ",".join(f"{n}:bigint" for n in names) + ">")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [chunk_statistics(chunk) for chunk in chunks(texts)]
            columns = [
                np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, np.int64)
                for n in names
            ]
            yield pa.StructArray.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], list(names)
            )

    return measure(F.col("text"))


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest sees: mean word length and the shares of symbols and of all marks.

    Length, repeats, digits and capitals vary as much among labelled good rows as among bad
    ones; in an unsupervised forest they would hide what sets the bad ones apart.
    The README has the figures with repeats and length added.
    """
    words_ = np.maximum(columns["n_words"], 1)
    chars = np.maximum(columns["n_chars_seen"], 1)
    return np.column_stack(
        [
            columns["word_chars"] / words_,
            np.sqrt(columns["n_symbols"] / words_),
            np.sqrt(columns["n_marks"] / chars),
        ]
    )


def _mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), n > 1)


class Forest:
    """Isolation trees in arrays: at each node a feature (-1 at leaves), a cut, and its children."""

    def __init__(self, rows: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(TREES):
            pick = rng.choice(len(rows), min(TREE_ROWS, len(rows)), replace=False)
            self.trees.append(self._grow(rows[pick], rng))
        self.usual = float(_mean_path(min(TREE_ROWS, len(rows)))) or 1.0

    @classmethod
    def of(cls, trees: list[tuple[np.ndarray, ...]], rows: int) -> Forest:
        """Trees that were grown on ``rows`` rows each."""
        forest = cls.__new__(cls)
        forest.trees, forest.usual = trees, float(_mean_path(rows)) or 1.0
        return forest

    @staticmethod
    def _grow(rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, cut, child, length = [], [], [], []
        queue = [(rows, 0)]
        while len(feature) < len(queue):
            part, depth = queue[len(feature)]
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
            wide = np.flatnonzero(high > low)
            length.append(depth + float(_mean_path(len(part))))
            if depth >= DEPTH or len(part) < 2 or not len(wide):
                feature.append(-1), cut.append(0.0), child.append(0)
                continue
            f = rng.choice(wide)
            at = rng.uniform(low[f], high[f])
            feature.append(f), cut.append(at), child.append(len(queue))
            queue += [(part[part[:, f] <= at], depth + 1), (part[part[:, f] > at], depth + 1)]
        return np.array(feature), np.array(cut), np.array(child), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1; about a half and more is unusual."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, child, length in self.trees:
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                below = child[node] + (rows[every, f] > cut[node])
                node = np.where(f < 0, node, below)
            total += length[node]
        return 2.0 ** (-total / (TREES * self.usual))


def threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """Scores above it are rejected; infinite where the labels cannot tell."""
    if not good.any() or good.all():
        return float("inf")
    # Halfway down from a bad score to the next lower score, so that equal scores stay on one side.
    bad, every = np.unique(scores[~good]), np.unique(scores)
    bad = bad[bad > every[0]]
    below = every[np.searchsorted(every, bad) - 1]
    cuts = below + (bad - below) / 2
    cuts = np.where(cuts < bad, cuts, below)
    kept = np.searchsorted(np.sort(scores[good]), cuts, "right") / good.sum()
    caught = 1 - np.searchsorted(np.sort(scores[~good]), cuts, "right") / (~good).sum()
    allowed = kept >= KEEP
    if not allowed.any():
        return float("inf")
    best = np.argmax(np.where(allowed, kept + caught, -1))
    return float(cuts[best])


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


_TREE = "feature array<int>, cut array<double>, child array<int>, length array<double>, n int"


def _grown(key: tuple, rows: pa.Table) -> pa.Table:
    """The tree of the rows that one tree has drawn."""
    # The order of a group's rows may differ between runs; that of their features does not.
    points = features({n: rows[n].to_numpy() for n in BASE + EXTRA})
    points = points[np.lexsort(points.T)]
    tree = Forest._grow(points, np.random.default_rng([SEED, key[0].as_py()]))
    names, types = ("feature", "cut", "child", "length"), (pa.int32(), pa.float64(), pa.int32(), pa.float64())
    columns = {n: pa.array([part.tolist()], pa.list_(t)) for n, part, t in zip(names, tree, types, strict=True)}
    return pa.table({**columns, "n": pa.array([len(points)], pa.int32())})


def grown(passed: DataFrame) -> Forest | None:
    """The forest of all rows of ``passed``, each tree grown in a task of its own rows."""
    total, steps = passed.count(), 1 << 30
    if not total:
        return None
    # Rows that come into question for a tree: about twice as many as it takes, or all.
    low = steps if 2 * TREE_ROWS >= total else max(steps * 2 * TREE_ROWS // total, 1)
    keys = ["doc_id", *BASE]
    place = lambda tree: F.pmod(F.xxhash64("_row", tree), F.lit(steps))
    trees = F.filter(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda tree: place(tree) < low)
    drawn = passed.withColumn("_row", F.xxhash64(F.lit(SEED), *keys)).withColumn("tree", F.explode(trees))
    drawn = top_n_per_group(drawn, ["tree"], [place(F.col("tree")), *map(F.col, keys)], TREE_ROWS, "_place")
    found = drawn.select("tree", *BASE, *EXTRA).groupBy("tree").applyInArrow(_grown, _TREE).collect()
    # The order in which trees arrive changes sums of path lengths in their last bits.
    parts = sorted((r["feature"], r["cut"], r["child"], r["length"]) for r in found)
    kinds = (np.int64, np.float64, np.int64, np.float64)
    return Forest.of(
        [tuple(np.array(p, kind) for p, kind in zip(tree, kinds, strict=True)) for tree in parts],
        max(r["n"] for r in found),
    )


def threshold_of(scored: DataFrame) -> float:
    """``threshold`` for all rows of ``scored`` (anomaly, quality), which no task gathers."""
    counts = scored.groupBy("anomaly").agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")
    )
    placed = counts.repartitionByRange("anomaly").withColumn("_part", F.spark_partition_id())
    placed = stored(placed, "labelled-scores")
    totals = placed.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not totals["good"] or not totals["bad"]:
        return float("inf")
    parts = placed.groupBy("_part").agg(
        F.sum("good").alias("g"), F.sum("bad").alias("b"), F.max("anomaly").alias("top")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = parts.select(
        "_part",
        *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in ("g", "b")),
        F.max("top").over(earlier).alias("top"),
    )
    inside = Window.partitionBy("_part").orderBy("anomaly")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    kept = (F.col("g") + F.coalesce(F.sum("good").over(before), F.lit(0))) / F.lit(totals["good"])
    missed = (F.col("b") + F.coalesce(F.sum("bad").over(before), F.lit(0))) / F.lit(totals["bad"])
    cuts = placed.join(F.broadcast(starts), "_part").select(
        "anomaly", "bad", F.coalesce(F.lag("anomaly").over(inside), "top").alias("below"),
        kept.alias("kept"), (1 - missed).alias("caught"),
    )
    cuts = cuts.filter((F.col("bad") > 0) & F.col("below").isNotNull() & (F.col("kept") >= KEEP))
    best = cuts.orderBy((F.col("kept") + F.col("caught")).desc(), "anomaly").first()
    if best is None:
        return float("inf")
    low, high = best["below"], best["anomaly"]
    cut = low + (high - low) / 2
    return cut if cut < high else low


def _anomaly(forest: Forest | None) -> Column:
    @arrow_udf("double")
    def anomaly(*columns: pa.Array) -> pa.Array:
        values = dict(zip(BASE + EXTRA, (c.to_numpy(zero_copy_only=False) for c in columns), strict=True))
        rows = features(values)
        return pa.array(forest.score(rows) if forest else np.zeros(len(rows)))

    return anomaly(*[F.col(n) for n in BASE + EXTRA])


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, anomaly."""
    measured = docs.select("doc_id", statistics().alias("m")).select("doc_id", "m.*")
    measured = stored(measured, "statistics")
    failed = _base_failed()
    passed = measured.filter(~failed)
    forest, cut = grown(passed), float("inf")
    if forest:
        marked = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
        cut = threshold_of(passed.join(marked, "doc_id").select(_anomaly(forest).alias("anomaly"), "quality"))
    return measured.withColumn("anomaly", _anomaly(forest)).select(
        "doc_id",
        *BASE,
        failed.alias("base_failed"),
        (~failed & (F.col("anomaly") <= F.lit(cut))).alias("kept"),
        "anomaly",
    )
