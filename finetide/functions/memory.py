"""Memory of Python workers."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def hand_back() -> None:
    """Gives freed memory back to the system: workers live on from task to task and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
