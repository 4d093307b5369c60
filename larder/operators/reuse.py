"""Keeping a frame that several results are built from."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Persist ``df`` to memory and disk for the block; the first action fills it.

    Blocks of a lost executor are recomputed.  For work that must not be repeated,
    store the frame instead.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
