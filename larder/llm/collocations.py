"""Phrases of up to four words that stand together more often than their parts suggest.

Everything is counted per language.  Words are ranked by frequency, pairs of neighbouring words
are counted, the frequent ones are ranked by frequency in turn, and so on: two frequent pairs
that overlap make a triple, two triples a phrase of four.

Documents are gathered into blocks of up to ``BLOCK`` bytes of text of one language.  A block holds
the numbers of the frequent words it uses, by falling frequency in the whole language, and its
text as places in that list, so frequent words have small places.  Pairs of places are counted in tiles of ``TILE`` x ``TILE`` cells: a tile with many
pairs is an array addressed by its cells and counted by ``bincount``, the pairs of all other tiles
are sorted and counted as coordinates.  Each block thus sends one row for each of its distinct
pairs, with their count, so a very frequent pair costs no more than one row a block.  Spark adds
the counts up and sends the frequent pairs with their numbers back to the blocks that have them.

No table is broadcast by this module, and nothing is collected.

* Texts are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line breaks LF, VT, FF, CR, and
  pieces into words at space and tab; phrases stay within pieces.
* Null and empty texts have no words; a null language is ``und``.
* Repeated rows count again.  An empty table, or one without frequent phrases, gives no rows.
* Ties of a score go to the larger count, then to the smaller phrase in UTF-8 byte order.
* Products are taken as decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.tables import discard, ship_package
from larder.llm.tables import stored as stored_as
from larder.operators.ranking import top_n_per_group

#: Blocks and uses are most of what the operator keeps on disk, so they are packed well.
stored = partial(stored_as, compression="zstd")

#: Bytes of text in a block, cells along a tile's side, pairs per cell of a dense tile at least.
BLOCK, TILE, DENSE = 1 << 25, 256, 1 / 2

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_AS_SEPARATORS = bytes(0x0A if b in _PIECE_ENDS else 0x20 if b == 0x09 else b for b in range(256))


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Block:
    """Texts of one language as numbers of words, -1 where a piece ends."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers({b"": 0, b"\n": 1}), [], 0

    def add(self, text: bytes) -> None:
        words = text.lower().translate(_AS_SEPARATORS).replace(b"\n", b" \n ").split(b" ")
        codes = np.array([*map(self.numbers.__getitem__, words), 1], np.int32)
        self.parts.append(codes[codes > 0] - 2)
        self.size += len(text)

    def row(self, block: int, lang: str) -> tuple:
        codes = np.concatenate(self.parts)
        counts = np.bincount(codes[codes >= 0], minlength=len(self.numbers) - 2)
        words = [w.decode() for w in self.numbers][2:]
        return block, lang, words, counts, _packed(codes, "<i4")


_BLOCKS = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string()))]
    + [("counts", pa.list_(pa.int64())), ("codes", pa.binary())]
)


def _gather(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows (lang, text) of one task; those open at a time hold ``limit`` bytes and a text at most."""
    blocks: dict[str, _Block] = {}
    number = TaskContext.get().partitionId() << 32

    def closed() -> Iterator[pa.RecordBatch]:
        nonlocal number
        for lang, block in blocks.items():
            yield pa.RecordBatch.from_pylist([], _BLOCKS) if not block.parts else pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(block.row(number, lang), _BLOCKS)], schema=_BLOCKS
            )
            number += 1
        blocks.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
            if text.is_valid:
                blocks.setdefault(lang.as_py(), _Block()).add(text.as_py())
                if sum(b.size for b in blocks.values()) >= limit:
                    yield from closed()
    yield from closed()


def count_tiled(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs (x, y) of small numbers and how often each occurs."""
    side = int(max(x.max(initial=0), y.max(initial=0))) // TILE + 1
    tile = (x // TILE) * side + y // TILE
    # Tiles are many where numbers are, so count those near the frequent numbers only.
    near = min(side, 64)
    close = (x < near * TILE) & (y < near * TILE)
    sizes = np.bincount((x[close] // TILE) * near + y[close] // TILE, minlength=near * near)
    dense = np.flatnonzero(sizes >= DENSE * TILE * TILE)
    slots = np.full(near * near, -1)
    slots[dense] = np.arange(len(dense))
    slot = np.full(len(x), -1)
    slot[close] = slots[(x[close] // TILE) * near + y[close] // TILE]
    inside = slot >= 0
    cells = slot[inside] * TILE**2 + (x[inside] % TILE) * TILE + y[inside] % TILE
    table = np.bincount(cells, minlength=len(dense) * TILE**2)
    used = np.flatnonzero(table)
    tiles = dense[used // TILE**2]
    dense_x = tiles // near * TILE + used // TILE % TILE
    dense_y = tiles % near * TILE + used % TILE
    # Coordinates of the sparse tiles, sorted tile by tile.
    key = (tile[~inside] * TILE + x[~inside] % TILE) * TILE + y[~inside] % TILE
    key, counts = np.unique(key, return_counts=True)
    sparse_x = key // TILE**2 // side * TILE + key // TILE % TILE
    sparse_y = key // TILE**2 % side * TILE + key % TILE
    return (
        np.concatenate([dense_x, sparse_x]),
        np.concatenate([dense_y, sparse_y]),
        np.concatenate([table[used], counts]),
    )


def _neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where two numbers stand side by side, and both."""
    codes = codes.astype(np.int64)
    at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    return at, codes[at], codes[at + 1]


def _array(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def _packed(values: np.ndarray, kind: str) -> bytes:
    """The values' lowest bytes, then their second bytes and so on, as the high ones are alike."""
    values = np.ascontiguousarray(values, kind)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unpacked(values: pa.Scalar, kind: str) -> np.ndarray:
    raw = np.frombuffer(values.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def _contents(ids: pa.Scalar, codes: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    return _unpacked(ids, "<i8"), _unpacked(codes, "<i4")


_STEP = 1 << 16


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, x, y, n): the distinct neighbours of each block, and their number."""
    for batch in batches:
        for block, ids, codes in zip(*batch.columns):
            ids, codes = _contents(ids, codes)
            x, y, n = count_tiled(*_neighbours(codes)[1:])
            # Rows that share a number stand together, so that the shuffle packs them well.
            order = np.argsort(x * len(ids) + y)
            x, y, n = x[order], y[order], n[order]
            for at in range(0, len(n), _STEP):
                part = slice(at, at + _STEP)
                blocks = np.full(len(n[part]), block.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in (blocks, ids[x[part]], ids[y[part]], n[part])], ["block", "x", "y", "n"]
                )


def _encoded_block(block: int, ids: np.ndarray, codes: np.ndarray) -> pa.Table:
    """One row: the numbers in use, ranked, and the text as places in them; gaps are one -1."""
    codes = codes[(codes >= 0) | (np.append(codes[1:], -1) >= 0)]
    values = [block, _packed(ids, "<i8"), _packed(codes, "<i4")]
    names = ["block", "ids", "codes"]
    return pa.table({k: pa.array([v], t) for k, v, t in zip(names, values, (pa.int64(), pa.binary(), pa.binary()))})


def _by_frequency(known: pa.Table) -> np.ndarray:
    return np.lexsort((_array(known, "id"), -_array(known, "a")))


def _number_words(texts: pa.Table, known: pa.Table) -> pa.Table:
    """A block's words by the numbers of the frequent ones; -1 is any other word or the end of a piece."""
    codes = _unpacked(texts.column("codes")[0], "<i4")
    place, ids = _array(known, "place"), _array(known, "id")
    order = _by_frequency(known)
    new = np.full(max(codes.max(initial=0), place.max(initial=0)) + 2, -1, np.int64)
    new[place[order]] = np.arange(len(order))
    return _encoded_block(texts.column("block")[0].as_py(), ids[order], new[codes])


def _number_pairs(texts: pa.Table, known: pa.Table) -> pa.Table:
    """A block's neighbours by the numbers of the frequent pairs; -1 is any other pair."""
    before, codes = _contents(texts.column("ids")[0], texts.column("codes")[0])
    at, x, y = _neighbours(codes)
    ids = _array(known, "id")
    order = _by_frequency(known)
    by_id = np.argsort(before)
    x_of, y_of = (by_id[np.searchsorted(before, _array(known, c), sorter=by_id)] for c in ("x", "y"))
    keys = x_of * len(before) + y_of
    by_key = np.argsort(keys)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(order))
    pairs = x * len(before) + y
    found = np.minimum(np.searchsorted(keys[by_key], pairs), len(keys) - 1)
    hit = keys[by_key][found] == pairs
    new = np.full(len(codes), -1, np.int64)
    new[at[hit]] = rank[by_key[found[hit]]]
    return _encoded_block(texts.column("block")[0].as_py(), ids[order], new)


_ENCODED = "block bigint, ids binary, codes binary"


def _numbered(blocks: DataFrame, known: DataFrame, renumber) -> DataFrame:
    """``blocks`` in new numbers; those without a frequent item drop out, as they have no phrase."""

    def work(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows or not known.num_rows:
            return _encoded_block(0, np.zeros(0), np.zeros(0, np.int64)).slice(1)
        return renumber(texts, known)

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(work, _ENCODED)


def _frequent(parts: DataFrame, item: list[str], least: int) -> DataFrame:
    """The rows of ``parts`` whose item occurs ``least`` times in all: with that number ``a`` and the item's ``id``.

    An item has a row for each block that holds it, so no item has more rows than there are blocks.
    Its id is the number of the ``first`` of its rows; blocks order ids by falling ``a``.
    """
    same = Window.partitionBy(*item)
    rows = parts.withColumn("a", F.sum("n").over(same)).filter(F.col("a") >= least).drop("n")
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.min("row").over(same))
    return rows.withColumn("first", F.col("row") == F.col("id")).drop("row")


def _words(docs: DataFrame, least: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The numbered blocks, the uses of the frequent words, and the words of each language in all."""
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    schema = "block bigint, lang string, words array<string>, counts array<bigint>, codes binary"
    blocks = stored(rows.mapInArrow(partial(_gather, limit), schema), "blocks")
    listed = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "word"))
    words = listed.select("block", "lang", "place", F.col("word.words").alias("word"), F.col("word.counts").alias("n"))
    n = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    uses = _frequent(words, ["lang", "word"], least)
    # Only the first use says which word it is.
    uses = stored(uses.withColumns({c: F.when(F.col("first"), F.col(c)) for c in ("lang", "word")}), "uses-1")
    places = uses.select("block", "place", "a", "id")
    numbered = stored(_numbered(blocks.select("block", "codes"), places, _number_words), "level-1")
    discard(blocks)
    return numbered, uses, n


def _single(uses: DataFrame) -> DataFrame:
    """The frequent words as phrases of one word."""
    none = F.array().cast("array<bigint>")
    return uses.filter("first").select(
        "id", "lang", "a", F.col("word").alias("phrase"), F.col("word").alias("last"),
        none.alias("firsts"), none.alias("lasts"),
    )


def _uses(blocks: DataFrame, least: int, level: int) -> DataFrame:
    """Where the frequent pairs of the blocks' items are used."""
    pairs = blocks.mapInArrow(_pairs, "block bigint, x bigint, y bigint, n bigint")
    return stored(_frequent(pairs, ["x", "y"], least), f"uses-{level}")


def _longer(uses: DataFrame, shorter: DataFrame, level: int) -> DataFrame:
    """The frequent phrases that pairs of ``shorter`` ones make, one word longer."""
    left = shorter.select(
        F.col("id").alias("x"), "lang", F.col("phrase").alias("head"), F.col("firsts").alias("before"),
        F.col("a").alias("x_a"),
    )
    right = shorter.select(
        F.col("id").alias("y"), "last", F.col("lasts").alias("after"), F.col("a").alias("y_a")
    )
    phrases = uses.filter("first").select("id", "x", "y", "a").join(left, "x").join(right, "y").select(
        "id", "lang", "a", F.concat_ws(" ", "head", "last").alias("phrase"), "last",
        F.concat("before", F.array("x_a")).alias("firsts"), F.concat("after", F.array("y_a")).alias("lasts"),
        "x", "y",
    )
    return stored(phrases, f"phrases-{level}")


def _cut(k: int, words: int) -> Column:
    """Score, place and parts of the cut after ``k`` of so many words."""
    first, rest = F.col("firsts")[k - 1], F.col("lasts")[words - k - 1]
    whole = F.expr("cast(a as decimal(28, 0)) * 2000000")
    score = F.call_function("div", whole, first.cast("decimal(20,0)") + rest.cast("decimal(20,0)"))
    return F.struct(score.alias("score"), F.lit(k).alias("k"), first.alias("l"), rest.alias("r"))


def _scored(phrases: DataFrame, words: int, longer: DataFrame | None, inside: int) -> DataFrame:
    """``phrases`` by their lowest cut, without those of which a longer one holds ``inside`` percent.

    Looking at phrases one word longer is enough: a still longer one is no more frequent.
    """
    cuts = [_cut(k, words) for k in range(1, words)]
    scored = phrases.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
    if longer is not None:
        most = longer.select(F.explode(F.array("x", "y")).alias("id"), F.col("a").alias("most"))
        most = most.groupBy("id").agg(F.max("most").alias("most"))
        held = F.coalesce(F.expr(f"cast(most as decimal(28, 0)) * 100 >= cast(a as decimal(28, 0)) * {inside}"), F.lit(False))
        scored = scored.join(most, "id", "left").filter(~held)
    return scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, least: int = 30, inside: int = 80, best: int = 2000, block: int = BLOCK
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``best`` phrases of each language.

    ``a`` is the number of occurrences, ``least`` at least; ``l`` and ``r`` are those of the two parts of
    the cut with the lowest score, floor(2000000 * a / (l + r)); ``n`` counts the language's words.
    ``block``, bytes of text, affects speed and memory only.
    """
    ship_package(docs.sparkSession)
    blocks, uses, n = _words(docs, least, block)
    phrases = [_single(uses)]
    for level in (2, 3, 4):
        pairs = _uses(blocks, least, level)
        phrases.append(_longer(pairs, phrases[-1], level))
        discard(uses)
        uses, before = pairs, blocks
        if level < 4:
            numbers = uses.select("block", "x", "y", "a", "id")
            blocks = stored(_numbered(blocks, numbers, _number_pairs), f"level-{level}")
        discard(before)
    discard(uses)
    _, pairs, triples, fours = phrases
    found = _scored(pairs, 2, triples, inside)
    found = found.unionByName(_scored(triples, 3, fours, inside)).unionByName(_scored(fours, 4, None, inside))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    top = top_n_per_group(found, ["lang"], order, best, "rank")
    total = n.withColumnRenamed("lang", "of")
    return top.join(total, top["lang"] == total["of"]).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
