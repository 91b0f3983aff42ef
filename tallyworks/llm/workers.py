"""Memory of Python workers, which Spark keeps for the tasks of later stages."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

from tallyworks.llm import encoding


def release() -> None:
    """Give back what unused cycles and the allocators keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only some C libraries have it
        pass


def lean(function: Callable, encodes: bool = False) -> Callable:
    """The function over a task's batches (or a group's table), leaving no memory behind.

    Without `encodes`, words that earlier stages have encoded are forgotten first.
    """

    @functools.wraps(function)
    def run(data):
        if not encodes:
            encoding.forget()
        result = function(data)
        if isinstance(result, pa.Table):
            release()
            return result
        return drained(result)

    return run


def lean_pair(function: Callable) -> Callable:
    """The same for a function over the two tables of a group."""

    def run(left, right):
        encoding.forget()
        result = function(left, right)
        release()
        return result

    return run


def drained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        yield from batches
    finally:
        release()
