"""Memory of Python workers: the size of the Arrow batches they get, and what they keep between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

#: What a worker keeps for later tasks of the same kind, by kind, and how it lets go of it.
_KEPT: dict[str, Callable[[], None]] = {}

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send at most ``rows`` rows at once, for rows that hold whole texts; restored afterwards."""
    held = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, str(min(rows, int(held)) if int(held) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, held)


def parts(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """In a worker: batches in parts of some rows with whole texts, as a frame that is run later has the session's batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def keeps(kind: str, clear: Callable[[], None]) -> None:
    """Registers tables that a worker keeps from task to task while it does work of this kind."""
    _KEPT[kind] = clear


@contextmanager
def worker_task(kind: str) -> Iterator[None]:
    """In a worker: drops what was kept for work of other kinds, and gives freed memory back to the system at the end.

    Workers outlive their tasks, so that the tables of one operator would else stand beside those of the next.
    """
    for other, clear in _KEPT.items():
        if other != kind:
            clear()
    try:
        yield
    finally:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # only some C libraries have it
            pass
