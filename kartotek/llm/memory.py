"""What a pass over Arrow batches leaves behind in its Python worker."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

_Pass = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Free memory that Arrow and the C library still hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(run: _Pass) -> _Pass:
    """``run``, giving memory back when a partition ends. Spark keeps idle workers and takes them in turns, so
    the free memory of every worker that an executor ever needed at once would add up."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
