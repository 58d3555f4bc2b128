"""Things a Python worker keeps from one task to the next."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

_HOME = "_corpus_worker"


def kept(name: str, make: Callable):
    """The object of that name in this worker process, made on first use.

    The functions of this package travel by value, so their module globals end
    with the task; this store lives as long as the process. It holds one object:
    when the worker turns to another operator, the last one's goes.
    """
    home = sys.modules.setdefault(_HOME, types.ModuleType(_HOME))
    if getattr(home, "name", None) != name:
        home.name = home.held = None
        _give_back()
        home.held = make()
        home.name = name
    return home.held


def _give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that; so does what Arrow holds in reserve."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
