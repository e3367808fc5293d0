"""What a Python worker holds from one task to the next.

Spark hands its workers from stage to stage and from query to query, and what they hold counts as their executor's memory.  A
function that is ``lean`` begins by dropping what other operators' tasks left (a tokenizer's memo) and ends by giving freed memory
back to the system, which the allocators would keep.  Results never depend on it.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

_held: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None]) -> None:
    """Name what drops the things that ``owner`` keeps between tasks."""
    _held[owner] = drop


def drop_others(*keeps: str) -> None:
    for owner in [x for x in _held if x not in keeps]:
        _held.pop(owner)()


def give_back() -> None:
    """Free pages of Arrow's pool and of the C heap, where the system's library can do that (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(*keeps: str):
    """A function of ``mapInArrow`` that drops what owners other than ``keeps`` hold, and gives memory back as a task ends."""

    def wrap(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        @functools.wraps(f)
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_others(*keeps)
            try:
                yield from f(batches)
            finally:
                give_back()

        return run

    return wrap
