"""Memory of the Python workers, which Spark uses again for later tasks and for other operators.

A worker keeps what its allocators once took, so an executor would add up the peaks of all stages. Functions marked
``thrifty`` give back what is free when a task ends, and caches that belong to one operator go when another one comes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa

#: The caches of the operator that ran last, by what clears them.
_held: list[Callable[[], None]] = []


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's call that returns free memory to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def clear() -> None:
    while _held:
        _held.pop()()


def hold(clear_own: Callable[[], None]) -> None:
    """Keep a cache beyond the task; ``clear_own`` empties it when a task of another kind begins."""
    if clear_own not in _held:
        clear()
        _held.append(clear_own)


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for mapInArrow, as one that leaves little memory behind; unless it ``keeps`` caches, those of others go first."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            clear()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
