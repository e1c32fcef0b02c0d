"""What the operators of this package share: tables, fold numbers, Arrow batches and word arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a task works on; a single longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


#: What operators keep in a worker between tasks, with the call that lets go of it.
_KEPT: dict[str, Callable[[], None]] = {}


#: The C library's call that gives freed memory back to the system, where there is one (glibc).
_GIVE_BACK = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold but no longer use."""
    pa.default_memory_pool().release_unused()
    if _GIVE_BACK is not None:
        _GIVE_BACK(0)


def keep(owner: str, let_go: Callable[[], None]) -> None:
    _KEPT[owner] = let_go


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", owner: str = "") -> Iterator[pa.RecordBatch]:
    """Cuts record batches into pieces of about ``STEP_BYTES`` of text, at row borders.

    Workers outlive tasks: what another operator has kept in this one is let go first, and memory that is free goes
    back to the system before and after the task, since idle workers count as well.
    """
    for name, let_go in _KEPT.items():
        if name != owner:
            let_go()
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(
            pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
        )
        step = np.cumsum(sizes) // STEP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    batch = None
    give_back()


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def flat_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each text starts (one more entry than texts)."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def columns_to_batch(names: str, *columns) -> pa.RecordBatch:
    """A record batch from arrays; ``names`` is comma-separated."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns], names.split(",")
    )
