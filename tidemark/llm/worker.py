"""What a Python worker holds between tasks.

Spark keeps workers alive, and the next task of a worker may be of another operator. What one
operator caches would stay beside what the next one needs, and the C library and Arrow keep freed
memory for later, so an executor that runs one operator after the other grows with each of them.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_caches: dict[str, Callable[[], None]] = {}


def cache(name: str, clear: Callable[[], None]) -> None:
    """Make a cache of this process known by name."""
    _caches[name] = clear


def begin(uses: tuple[str, ...]) -> None:
    """Empty all caches but those named."""
    for name, clear in _caches.items():
        if name not in uses:
            clear()


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def lean(run: Callable, *uses: str) -> Callable:
    """``run`` as a task that starts with the caches it uses only and gives freed memory back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(uses)
        yield from run(batches)
        give_back()

    return task
