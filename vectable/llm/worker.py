"""What a Python worker keeps between tasks.

The package's functions travel with each task, and so do its module globals; only what hangs
on a module of the worker itself outlives the task.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable
from typing import Any

import pyarrow as pa


def kept_by_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """The worker's value for ``key``, made on first use."""
    cache = sys.__dict__.setdefault("_vectable_worker_cache", {})
    if key not in cache:
        cache[key] = make()
    return cache[key]


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and what they hold adds up in an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)
