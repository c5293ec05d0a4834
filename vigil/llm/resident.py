"""What a Python worker keeps in memory from batch to batch and from task to task."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_kept: dict[str, dict[Hashable, Any]] = {}
# Only glibc has it; other C libraries give freed memory back by themselves, or not at all.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def serve(owner: str) -> dict[Hashable, Any]:
    """What this worker keeps for an owner; what it kept for another one goes.

    Spark hands a worker the tasks of one operator after another: without this it would hold the
    tables and caches of all it has served. Allocators keep freed memory for later, so it is
    given back to the system too.
    """
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = {}
        gc.collect()
        pa.default_memory_pool().release_unused()
        if _trim:
            _trim(0)
    return _kept[owner]


def resident(owner: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` gives, made once and kept until the worker serves another owner."""
    own = serve(owner)
    if key not in own:
        own[key] = make()
    return own[key]
