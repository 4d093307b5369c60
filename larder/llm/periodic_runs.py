"""Runs of repeating words, found from string synchronising sets.

A run is a stretch of words with smallest period q, at least ``EXPONENT`` periods and ``LEAST``
words long, that no neighbouring word extends.  Periods below ``DIRECT`` are found directly, by
comparing each word with the one q further on.  Periods q of tau to 2 tau words, for tau =
``DIRECT``, twice that and so on, come from a synchronising set of that scale:

* Of the windows of tau words, each has a hash.  A position i is in the set when the smallest
  hash at i to i + tau stands at either end.  So equal stretches of 2 tau words choose alike,
  and every tau neighbouring positions hold one of the set.
* Windows of period tau / 4 or less are left out: they lie in runs that smaller scales have
  found already.  A set thus stays sparse inside long runs of a small period.
* A position of the set and the next one with the same 2 tau words propose their distance as a
  period.  Proposals that overlap are joined, extended word by word at both ends, and kept if
  long enough; of equal stretches the smallest period stays.

In a run of period q the same 2 tau words come back after q words and not before, and a
position of the set lies in its first tau words, so every run is proposed.  Windows are named by
sorting pairs of names of half the length, so equal names mean equal words, without
collisions; only windows that occur twice in their document go on to the next scale.

* Words are maximal stretches without space, tab and the line breaks LF, VT, FF, CR.
* Null and empty texts, and texts without words, have no runs.
* Runs never cross documents.  Repeated rows give repeated results, an empty table none.
* Texts are handled whole, in chunks of about ``CHUNK`` bytes; a longer text is a chunk alone.
* Memory of a task is proportional to its longest chunk; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from larder.llm.nptext import mixed, text_of
from larder.llm.tables import ship_package

#: Least periods and least words of a run, first period found by a synchronising set, chunk.
EXPONENT, LEAST, DIRECT, CHUNK = 4, 6, 4, 1 << 20


def _stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of ``hit`` begin and end."""
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _repeated_names(keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A name for each of the places ``at`` whose key occurs twice, -1 elsewhere."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    names = np.full(size, -1)
    twice = count[name] > 1
    names[at[twice]] = name[twice]
    return names


def _doubled(names: np.ndarray, tau: int) -> np.ndarray:
    """Names of windows of 2 ``tau`` words from those of ``tau`` words."""
    at = np.flatnonzero((names[:-tau] >= 0) & (names[tau:] >= 0)) if tau < len(names) else np.zeros(0, int)
    if not len(at):
        return np.full(len(names), -1)
    return _repeated_names(names[at] * (names.max() + 1) + names[at + tau], at, len(names))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from each place on, by windows of doubled width."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        np.minimum(out[:-step], out[step:].copy(), out=out[:-step])
        have += step
    return out


def synchronising_set(names: np.ndarray, contexts: np.ndarray, tau: int, left_out: np.ndarray) -> np.ndarray:
    """Positions whose ``contexts`` (2 tau words) occur twice and whose ends hold the smallest hash.

    ``names`` are those of windows of tau words, ``left_out`` marks the highly periodic ones.
    """
    most = np.iinfo(np.uint64).max
    ids = np.where(left_out, most, mixed(names.astype(np.uint64) + np.uint64(1)) >> np.uint64(1))
    lowest = _smallest(ids, tau + 1)
    places = np.flatnonzero(contexts >= 0)
    low = lowest[places]
    return places[(low < most) & ((ids[places] == low) | (ids[places + tau] == low))]


def _matching(words: np.ndarray, start: np.ndarray, q: np.ndarray, step: int, width: int) -> np.ndarray:
    """How far words[start + i * step] equals the word q further on, for i = 0, 1, 2 and so on."""
    length = np.zeros(len(start), np.int64)
    alive = np.arange(len(start))
    offsets = np.arange(width)
    block = max(1, (1 << 22) // width)
    while len(alive):
        more = []
        for first in range(0, len(alive), block):
            part = alive[first : first + block]
            at = start[part, None] + step * (length[part, None] + offsets)
            other = at + q[part, None]
            inside = (at >= 0) & (other < len(words))
            same = inside & (words[np.where(inside, at, 0)] == words[np.where(inside, other, 0)])
            reach = np.where(same.all(1), width, same.argmin(1))
            length[part] += reach
            more.append(part[reach == width])
        alive = np.concatenate(more)
    return length


def _proposed(words: np.ndarray, chosen: np.ndarray, contexts: np.ndarray, tau: int) -> np.ndarray:
    """Stretches (start, end, period) that repeat with a period of tau to 2 tau words."""
    order = chosen[np.lexsort((chosen, contexts[chosen]))]
    gap = np.diff(order)
    near = (contexts[order[1:]] == contexts[order[:-1]]) & (gap >= tau) & (gap < 2 * tau)
    at, q = order[:-1][near], gap[near]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # Each says that the 2 tau words from there on equal those q further; join what overlaps.
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (at[1:] > at[:-1] + 2 * tau)
    first = np.flatnonzero(fresh)
    start, q = at[first], q[first]
    end = at[np.append(first[1:], len(at)) - 1] + 2 * tau
    end = end + _matching(words, end, q, 1, min(4 * tau, 64))
    start = start - _matching(words, start - 1, q, -1, min(4 * tau, 64))
    return np.column_stack([start, end + q, q])


def repetitions(words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """(start, end, period) of the maximal stretches of ``EXPONENT`` periods or more.

    ``words`` are numbers, ``docs`` the document of each word; a word of one document equals
    none of another.
    """
    numbers, words = np.unique(words, return_inverse=True)
    words = docs * max(len(numbers), 1) + words
    found = []
    for q in range(1, DIRECT):
        start, end = _stretches(words[q:] == words[:-q])
        found.append(np.column_stack([start, end + q, np.full(len(start), q)]))
    runs = _kept(np.concatenate(found))
    names = _repeated_names(words, np.arange(len(words)), len(words))
    tau = 1
    while tau < DIRECT:
        names, tau = _doubled(names, tau), 2 * tau
    while True:
        contexts = _doubled(names, tau)
        if contexts.max(initial=-1) < 0:
            return runs
        periodic = runs[(4 * runs[:, 2] <= tau) & (runs[:, 1] - runs[:, 0] >= tau)]
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, periodic[:, 0], 1)
        np.add.at(marks, periodic[:, 1] - tau + 1, -1)
        chosen = synchronising_set(names, contexts, tau, np.cumsum(marks[:-1]) > 0)
        runs = _kept(np.concatenate([runs, _proposed(words, chosen, contexts, tau)]))
        names, tau = contexts, 2 * tau


def _kept(runs: np.ndarray) -> np.ndarray:
    """Long enough ones by start and period, of equal stretches that of the smallest period."""
    runs = runs[runs[:, 1] - runs[:, 0] >= EXPONENT * runs[:, 2]]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (np.diff(runs[:, :2], axis=0) != 0).any(1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _read(texts: list[pa.Scalar]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text; all of them as numbers; where each text begins (one more at the end)."""
    words = [text.as_py().split() if text.is_valid else [] for text in texts]
    bounds = np.cumsum([0, *map(len, words)])
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for text in words for w in text]
    return words, np.array(codes, np.int64), bounds


def _runs_of(texts: list[pa.Scalar]) -> tuple[list[list[bytes]], list[np.ndarray], np.ndarray, np.ndarray]:
    """Words and runs (word number, end, period) of each text; words to drop, by where each text begins."""
    words, codes, bounds = _read(texts)
    runs = repetitions(codes, text_of(bounds))
    runs = runs[runs[:, 1] - runs[:, 0] >= LEAST]
    marks = np.zeros(len(codes) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 1], -1)
    owner = np.searchsorted(bounds, runs[:, 0], "right") - 1
    runs[:, :2] -= bounds[owner, None]
    return words, np.split(runs, np.searchsorted(owner, np.arange(1, len(words)))), np.cumsum(marks[:-1]) > 0, bounds


def _chunks(texts: pa.Array) -> Iterator[list[pa.Scalar]]:
    part, size = [], 0
    for text in texts.cast(pa.large_binary()):
        part.append(text)
        size += len(text.as_buffer()) if text.is_valid else 0
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def runs_of(text: str = "text") -> Column:
    """The runs of a column of texts, by start and period: array of start, length, period."""

    @arrow_udf("array<struct<start:bigint,length:bigint,period:bigint>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for part in _chunks(texts):
                for runs in _runs_of(part)[1]:
                    rows = zip(runs[:, 0].tolist(), (runs[:, 1] - runs[:, 0]).tolist(), runs[:, 2].tolist())
                    out.append([dict(zip(("start", "length", "period"), row)) for row in rows])
            yield pa.array(out, pa.list_(_RUN))

    return find(F.col(text))


def collapsed(text: str = "text") -> Column:
    """A column of texts with the first period of each run only, words joined by one space."""

    @arrow_udf("string")
    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([b" ".join(kept).decode() for _, kept in _collapsed(texts)], pa.string())

    return keep(F.col(text))


def _collapsed(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Runs and kept words of each text."""
    for part in _chunks(texts):
        words, runs, dropped, bounds = _runs_of(part)
        for i, text in enumerate(words):
            yield runs[i], list(compress(text, (~dropped[bounds[i] : bounds[i + 1]]).tolist()))


_REPORT = pa.struct(
    [(name, pa.int64()) for name in ("n_runs", "start", "length", "period", "exponent_milli")]
    + [(name, pa.string()) for name in ("runs_sha256", "collapsed_sha256")]
)


def _line(runs: np.ndarray, kept: list[bytes]) -> tuple:
    start, length, period = runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()))
    longest = (None,) * 4
    if len(runs):
        i = np.lexsort((period, start, -length))[0]
        longest = (*(int(a[i]) for a in (start, length, period)), int(1000 * length[i] // period[i]))
    digests = (hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(kept)))
    return (len(runs), *longest, *digests)


def run_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli), digests of runs and collapsed text."""
    ship_package(docs.sparkSession)

    @arrow_udf("struct<n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,"
               "runs_sha256:string,collapsed_sha256:string>")
    def report(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            lines = [_line(runs, kept) for runs, kept in _collapsed(texts)]
            columns = list(zip(*lines, strict=True)) if lines else [()] * len(_REPORT)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _REPORT, strict=True)]
            yield pa.StructArray.from_arrays(arrays, [f.name for f in _REPORT])

    return docs.select("doc_id", report(F.col(text)).alias("r")).select("doc_id", "r.*")


def with_cycles(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a cycle of words in about one document of ten.

    With h the crc32 of the decimal doc_id and g = h / 10: where h is divisible by 10, the n words
    go on from word a = g % n as a cycle of 1 + (n - a) / (3 + g % 8) words (whole quotients).
    Rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)")))
    rows = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    rows = rows.withColumns({"n": F.size("words"), "a": F.expr("if(size(words) > 0, g % size(words), null)")})
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    cycle = F.expr("concat_ws(' ', transform(sequence(0, n - 1), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)]))")
    return rows.select("doc_id", F.when(F.col("n") > 0, cycle).otherwise(F.col("text")).alias("text"))
