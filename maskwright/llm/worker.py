"""What a Python worker keeps from task to task."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import pyarrow as pa


def kept(name: object, make: Callable[[], object]) -> object:
    """``make()``, made once per worker process.

    Code reaches the workers by value, so its own global names are new in every task; a module of the process is not.
    """
    store = sys.modules.setdefault("_maskwright_kept", ModuleType("_maskwright_kept")).__dict__.setdefault("values", {})
    if name not in store:
        store[name] = make()
    return store[name]


def give_back(*keeping: str) -> None:
    """Return to the system what earlier tasks of this process have freed: workers serve many stages.

    What they have kept is freed too, but for what is named (by its name, or the first part of it).
    """
    store = sys.modules.get("_maskwright_kept")
    values = store.__dict__.get("values", {}) if store is not None else {}
    for name in list(values):
        if (name[0] if isinstance(name, tuple) else name) not in keeping:
            del values[name]
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def giving_back(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """The same task function, which frees its memory for other stages when it ends."""
    def whole(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole
