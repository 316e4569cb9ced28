"""Python workers stay after a task; they give back what it has used."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(work: Batches) -> Batches:
    """``work``, after which the worker's free memory goes back to the system."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(parts)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return run
