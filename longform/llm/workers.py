"""Memory of Python workers, which Spark uses again for other operators' tasks.

Tables that an operator keeps between its tasks (known words, a lattice) stay in the worker
after its last task. ``enter`` is called first in every task: it drops what tasks of other operators have left, and
gives freed memory back to the system, so that a long session holds the tables of one operator at a time.
"""

from __future__ import annotations

from collections.abc import Callable

_held: dict[str, Callable[[], None]] = {}


def enter(name: str, forget: Callable[[], None] | None = None) -> None:
    """A task of the operator ``name`` begins; ``forget`` drops what the worker keeps for it from now on."""
    others = [held for held in _held if held != name]
    for other in others:
        _held.pop(other)()
    if forget:
        _held[name] = forget
    if others:
        trim()


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass
