"""Vectorised work on the UTF-8 bytes of an Arrow column of texts.

Texts are taken in chunks of about ``CHUNK`` bytes, so a batch of long texts needs no more
memory than its longest text.  Hashes are 64-bit: polynomial over random byte values,
modulo 2**64, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = _BYTES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_powers: dict[int, np.ndarray] = {}


@dataclass
class Chunk:
    """Texts ``first`` to ``last`` of a batch: their bytes, and where each begins (one more at the end)."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """The bytes of ``texts``; null is empty."""
    if len(texts) == 0:
        return
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64, len(filled) + 1, filled.offset * 8)
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(filled):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(filled))
        start, end = offsets[first], offsets[last]
        yield Chunk(first, last, data[start:end], offsets[first : last + 1] - start)
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, CHUNK + 1), base % 2**64, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if len(table) <= 1 << 23:
            _powers[base] = table
    return table


class Hasher:
    """Hashes of any stretch of ``data``; ``fold`` reads A-Z as a-z, ``seed`` picks the polynomial."""

    def __init__(self, data: np.ndarray, fold: bool = False, seed: int = 0):
        base = _BASE + 2 * seed * 0x51ED270B
        n = len(data) + 1
        self._prefix = np.zeros(n, np.uint64)
        values = (_FOLDED if fold else _BYTES)[data]
        values *= _power_table(base, n)[: n - 1]
        np.cumsum(values, out=self._prefix[1:])
        self._inverse = _power_table(pow(base, -1, 2**64), n)[:n]

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._prefix[ends] - self._prefix[starts]) * self._inverse[starts])

    def all_of(self, length: int) -> np.ndarray:
        """Of every stretch of ``length`` bytes, by its start."""
        if len(self._prefix) <= length:
            return np.zeros(0, np.uint64)
        sums = self._prefix[length:] - self._prefix[:-length]
        sums *= self._inverse[: len(sums)]
        return mixed(sums)


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the first word of each text (one more at the end)."""
    inside = ~_SPACE[chunk.data]
    edges = chunk.bounds[:-1][chunk.bounds[:-1] < len(inside)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = chunk.bounds[1:][chunk.bounds[1:] > 0] - 1
    stops[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, chunk.bounds)


def text_of(bounds: np.ndarray) -> np.ndarray:
    """For every item the text it belongs to, where text i has items bounds[i] to bounds[i + 1]."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i] : bounds[i + 1]] for every i."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
