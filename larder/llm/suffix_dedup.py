"""Removal of byte strings that stand elsewhere too, by sparse distributed prefix doubling.

Every byte covered by a ``LENGTH``-byte string that also starts at another place is removed.
Ranking all positions would shuffle each byte's position at every doubling, so the ranks
start at synchronising positions: the smallest hash among the ``SYNC``-byte strings of each
``LENGTH``-byte window.  Equal windows have equal synchronising strings at equal offsets, so a
window that repeats holds one that repeats.

1. Spark sorts the ``SYNC``-byte strings of the synchronising positions and ranks those that
   occur at least twice; unique positions leave.
2. The surviving ranks are paired with the names of the ``LENGTH - SYNC`` bytes on either side,
   and the pairs are sorted and ranked again.  A pair that occurs twice is past the threshold:
   all it spans is removed.
3. A window about a position holds half of those bytes on one side at least, so a pair goes on
   only on the sides where another pair of its rank has the same half.
4. One position of each such pair gives blocks of ``BLOCK`` neighbouring windows: what all
   of them share, and all that they span together, are paired and ranked the same way.
   Where a shared part has several spans, one position of each span gives its single windows.
5. The pairs of the windows' two names are ranked, and those not unique are removed.

The result is exactly that of comparing all windows.  Names are pairs of 64-bit hashes.

* Null and empty texts, and texts shorter than ``LENGTH`` bytes, lose nothing.
* Matches never cross documents; strings may overlap.  Judged on the input.
* Rows that repeat a doc_id and its text are copies of each other, so all they share goes.
* Frequent names are counted before the shuffle; joins back are left to adaptive skew
  handling.  The positions of one document are gathered in one row, never those of a name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.nptext import Hasher, chunks
from larder.llm.tables import stored

LENGTH, SYNC, BLOCK = 200, 120, 10
_WINDOW = LENGTH - SYNC + 1
_SIDE, _HALF = LENGTH - SYNC, (LENGTH - SYNC) // 2
_POSITION_BITS = 32


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return pick(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def _window_bounds(bounds: np.ndarray, n: int) -> np.ndarray:
    """Which of the first ``n`` positions begin a window that stays in its text."""
    inside = np.zeros(n + 1, np.int32)
    sizes = np.diff(bounds)
    long = sizes >= LENGTH
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, np.minimum(bounds[1:][long] - LENGTH + 1, n), -1)
    return np.cumsum(inside[:-1]) > 0


def _synchronising(bounds: np.ndarray, names: np.ndarray):
    """Smallest name in each window (by its start), which windows are whole, which positions are picked."""
    least = _sliding(names, _WINDOW, np.minimum)
    whole = _window_bounds(bounds, len(least))
    # A position is picked if a whole window that holds it has its name as the smallest.
    seen = np.where(whole, least, np.uint64(0))
    padded = np.concatenate([np.zeros(_WINDOW - 1, np.uint64), seen, np.zeros(_WINDOW - 1, np.uint64)])
    highest = _sliding(padded, _WINDOW, np.maximum)
    return least, whole, (highest == names) & (names > 0)


def _packed(hashes: np.ndarray, row: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array(((hashes[row] << _POSITION_BITS) | at).astype(np.int64))


def _sync_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, place, name) of every synchronising position."""
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(2)):
            if len(chunk.data) < LENGTH:
                continue
            names = Hasher(chunk.data).all_of(SYNC)
            _, _, picked = _synchronising(chunk.bounds, names)
            at = np.flatnonzero(picked)
            text = np.searchsorted(chunk.bounds, at, "right") - 1
            row = chunk.first + text
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row)),
                    _packed(hashes, row, at - chunk.bounds[text]),
                    pa.array(names[at].view(np.int64)),
                ],
                ["doc_id", "place", "name"],
            )


def _listed(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The items of list rows ``first`` to ``last``, and the row of each."""
    part = column.slice(first, last - first)
    sizes = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return part.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(last - first), sizes)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranked positions of each text with the names of the bytes around them."""
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(2)):
            hasher = Hasher(chunk.data)
            place, text = _listed(batch.column(3), chunk.first, chunk.last)
            rank, _ = _listed(batch.column(4), chunk.first, chunk.last)
            at = chunk.bounds[text] + place
            # At the ends of a text there are fewer bytes on a side; their number is in the name.
            start = {n: np.maximum(at - n, chunk.bounds[text]) for n in (_SIDE, _HALF)}
            end = {n: np.minimum(at + SYNC + n, chunk.bounds[text + 1]) for n in (_SIDE, _HALF)}
            names = [Hasher(chunk.data, seed=1).stretches(start[_SIDE], end[_SIDE])]
            for n in (_SIDE, _HALF):
                names.append(hasher.stretches(start[n], at) + (at - start[n]).astype(np.uint64))
                names.append(hasher.stretches(at + SYNC, end[n]) + (end[n] - at).astype(np.uint64))
            row = chunk.first + text
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row)),
                    _packed(hashes, row, place),
                    pa.array(rank),
                    *[pa.array(n.view(np.int64)) for n in names],
                ],
                ["doc_id", "place", "rank", "check", "before", "after", "near_before", "near_after"],
            )


def _gaps(intervals: np.ndarray) -> np.ndarray:
    """Intervals (start, end) merged where they touch."""
    if not len(intervals):
        return intervals.reshape(0, 2)
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(intervals[:, 1])
    fresh = np.ones(len(intervals), bool)
    fresh[1:] = intervals[1:, 0] > reach[:-1]
    first = np.flatnonzero(fresh)
    return np.column_stack([intervals[first, 0], reach[np.append(first[1:], len(intervals)) - 1]])


def _removed(raw: np.ndarray, spans: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, runs of them and the digest of the rest."""
    runs = _gaps(spans)
    kept, at = hashlib.sha256(), 0
    for start, end in runs:
        kept.update(raw[at:start])
        at = end
    kept.update(raw[at:])
    return int((runs[:, 1] - runs[:, 0]).sum()), len(runs), kept.hexdigest()


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of windows about the places asked for: the part they share and all they span.

    A block at s holds the windows that start at s - BLOCK to s.
    """
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(2)):
            wanted = np.zeros(len(chunk.data) + 1, bool)
            for side, offsets in ((0, range(_HALF, _SIDE, BLOCK)), (1, range(0, _HALF, BLOCK))):
                place, text = _listed(batch.column(3 + side), chunk.first, chunk.last)
                for offset in offsets:
                    fits = place >= offset
                    wanted[(chunk.bounds[text] + place - offset)[fits]] = True
            start = np.flatnonzero(wanted)
            text = np.searchsorted(chunk.bounds, start, "right") - 1
            end = start + LENGTH - BLOCK
            whole = end <= chunk.bounds[text + 1]
            start, end, text = start[whole], end[whole], text[whole]
            low = np.maximum(start - BLOCK, chunk.bounds[text])
            high = np.minimum(start + LENGTH, chunk.bounds[text + 1])
            hasher, second = Hasher(chunk.data), Hasher(chunk.data, seed=1)
            # The shared part's place within the span is part of the span's name.
            wide = hasher.stretches(low, high) + (start - low).astype(np.uint64)
            row = chunk.first + text
            names = (hasher.stretches(start, end), wide, second.stretches(low, high))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row)),
                    _packed(hashes, row, start - chunk.bounds[text]),
                    *[pa.array(n.view(np.int64)) for n in names],
                ],
                ["doc_id", "place", "core", "wide", "check"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the blocks asked for."""
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(2)):
            if len(chunk.data) < LENGTH:
                continue
            place, text = _listed(batch.column(3), chunk.first, chunk.last)
            wanted = np.zeros(len(chunk.data) + 1, bool)
            for offset in range(BLOCK + 1):
                fits = place >= offset
                wanted[(chunk.bounds[text] + place - offset)[fits]] = True
            start = np.flatnonzero(wanted)
            text = np.searchsorted(chunk.bounds, start, "right") - 1
            whole = start + LENGTH <= chunk.bounds[text + 1]
            start, text = start[whole], text[whole]
            hasher, second = Hasher(chunk.data), Hasher(chunk.data, seed=1)
            names = (hasher.stretches(start, start + LENGTH), second.stretches(start, start + LENGTH))
            row = chunk.first + text
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row)),
                    _packed(hashes, row, start - chunk.bounds[text]),
                    *[pa.array(n.view(np.int64)) for n in names],
                ],
                ["doc_id", "place", "name", "check"],
            )


def _places(column: pa.Array, i: int) -> np.ndarray:
    item = column[i]
    return np.asarray(item.values, np.int64) if item.is_valid else np.zeros(0, np.int64)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            text = batch.column(1)[i]
            raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            # Lists of positions, with how far what repeats reaches before and after them.
            reaches = ((2, _SIDE, LENGTH), (3, BLOCK, LENGTH), (4, 0, LENGTH))
            spans = []
            for column, before, after in reaches:
                at = _places(batch.column(column), i)
                spans.append(
                    np.column_stack([np.maximum(at - before, 0), np.minimum(at + after, len(raw))])
                )
            spans = np.concatenate(spans)
            out.append((len(raw), *_removed(raw, spans)))
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _text_hash() -> Column:
    """31 bits that tell the texts of a repeated doc_id apart."""
    return F.pmod(F.xxhash64("text"), F.lit((1 << 31) - 1))


def _split_place(place: str = "place") -> tuple[Column, Column]:
    at = F.col(place).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return F.shiftright(place, _POSITION_BITS).alias("hash"), at.alias("at")


def _ranked(names: DataFrame, *columns: str) -> DataFrame:
    """Distinct ``names`` in sorted order with ranks that keep the order."""
    return stored(
        names.orderBy(*columns).withColumn("rank", F.monotonically_increasing_id()), "ranks"
    )


def _per_document(places: DataFrame, **collected: Column) -> DataFrame:
    """One row per document with lists of its places; joined by ``_same_document``."""
    lists = [F.collect_list(column).alias(name) for name, column in collected.items()]
    grouped = places.groupBy("doc_id", "hash").agg(*lists)
    return grouped.withColumnsRenamed({"doc_id": "info_id", "hash": "info_hash"})


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("info_id")) & (F.col("hash") == F.col("info_hash"))


def _ranked_positions(rows: DataFrame) -> DataFrame:
    """Per document the synchronising positions whose string occurs twice, with its rank."""
    sync = rows.mapInArrow(_sync_rows, "doc_id bigint, place bigint, name bigint")
    names = sync.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    alive = sync.join(_ranked(names, "name"), "name").select("doc_id", *_split_place(), "rank")
    found = _per_document(alive.distinct(), both=F.struct("at", "rank"))
    return found.select(
        "info_id", "info_hash", F.col("both.at").alias("at"), F.col("both.rank").alias("rank")
    )


def _open_pairs(around: DataFrame) -> DataFrame:
    """Pairs that occur twice or may share a window with another pair of their rank."""
    pair = ("rank", "check", "before", "after")
    pairs = around.groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc_id", "place")).alias("one"),
        F.first("near_before").alias("near_before"),
        F.first("near_after").alias("near_after"),
    )
    pairs = stored(pairs.orderBy(*pair), "pairs")
    for side, half in (("ask_before", "near_before"), ("ask_after", "near_after")):
        shared = pairs.groupBy("rank", half).agg(F.count(F.lit(1)).alias("pairs")).filter("pairs > 1")
        shared = shared.select("rank", half, F.lit(True).alias(side))
        pairs = pairs.join(shared, ["rank", half], "left")
    return pairs.select(
        *pair,
        (F.col("n") > 1).alias("twice"),
        F.coalesce("ask_before", F.lit(False)).alias("ask_before"),
        F.coalesce("ask_after", F.lit(False)).alias("ask_after"),
        "one",
    ).filter("twice or ask_before or ask_after")


def _marked_positions(around: DataFrame) -> DataFrame:
    """(doc_id, hash, at, twice, ask_before, ask_after) of the positions that go on."""
    pairs = _open_pairs(around)
    asks = F.struct("doc_id", "place") == F.col("one")
    marked = around.join(pairs, ["rank", "check", "before", "after"]).select(
        "doc_id",
        *_split_place(),
        "twice",
        (F.col("ask_before") & asks).alias("ask_before"),
        (F.col("ask_after") & asks).alias("ask_after"),
    )
    return marked.filter("twice or ask_before or ask_after")


def _marked_blocks(blocks: DataFrame) -> DataFrame:
    """(doc_id, hash, at, twice, asked) of the blocks whose span repeats or may match another."""
    span = ("core", "wide", "check")
    place = F.struct("doc_id", "place")
    spans = blocks.groupBy(*span).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one"))
    spans = stored(spans.orderBy(*span), "spans")
    several = spans.groupBy("core").agg(F.count(F.lit(1)).alias("spans")).filter("spans > 1")
    spans = spans.join(several, "core", "left").filter("spans > 1 or n > 1")
    return blocks.join(spans, list(span)).select(
        "doc_id",
        *_split_place(),
        (F.col("n") > 1).alias("twice"),
        (F.col("spans").isNotNull() & (place == F.col("one"))).alias("asked"),
    )


def _in_texts(rows: DataFrame, places: DataFrame, work, columns: str) -> DataFrame:
    """``work`` on the text of each document that has ``places``, and their lists."""
    lists = [c for c in places.columns if c not in ("info_id", "info_hash")]
    joined = rows.join(places, _same_document()).select("doc_id", "hash", "text", *lists)
    return joined.mapInArrow(work, columns)


def repeats_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_hash().alias("hash"), "text")
    place = "doc_id bigint, place bigint"
    positions = stored(_ranked_positions(rows), "positions")
    names = "rank bigint, check bigint, before bigint, after bigint, near_before bigint, near_after bigint"
    around = stored(_in_texts(rows, positions, _pair_rows, f"{place}, {names}"), "around")
    pairs = stored(_marked_positions(around), "marked-pairs")
    asked = _per_document(
        pairs.filter("ask_before or ask_after"),
        ask_before=F.expr("if(ask_before, at, null)"),
        ask_after=F.expr("if(ask_after, at, null)"),
    )
    names = "core bigint, wide bigint, check bigint"
    blocks = stored(_in_texts(rows, stored(asked, "asked"), _block_rows, f"{place}, {names}"), "blocks")
    spans = stored(_marked_blocks(blocks), "marked-blocks")
    asked = stored(_per_document(spans.filter("asked"), asked=F.col("at")), "asked")
    names = "name bigint, check bigint"
    windows = stored(_in_texts(rows, asked, _window_rows, f"{place}, {names}"), "windows")
    again = windows.groupBy("name", "check").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = _ranked(again.select("name", "check"), "name", "check")
    edges = windows.join(again, ["name", "check"]).select("doc_id", *_split_place())

    ends = pairs.filter("twice").select("doc_id", "hash", "at", F.lit(0).alias("kind"))
    ends = ends.unionByName(spans.filter("twice").select("doc_id", "hash", "at", F.lit(1).alias("kind")))
    ends = ends.unionByName(edges.withColumn("kind", F.lit(2)))
    kinds = {f"kind{k}": F.expr(f"if(kind = {k}, at, null)") for k in range(3)}
    ends = stored(_per_document(ends, **kinds), "ends")
    whole = rows.join(ends, _same_document(), "left")
    return whole.select("doc_id", "text", *kinds).mapInArrow(_finish, _RESULT)
