"""The object that a worker process keeps between the tasks it runs, such as a loaded vocabulary.

Losing a process loses nothing but the time to make it again.  A process keeps one object: what the
stages of a pipeline need one after the other is not held at once.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable


def kept(key: Hashable, make: Callable):
    """What ``make`` gave for this key in this process, if no other key was asked for since."""
    store = sys.modules.setdefault("_tablecheck_kept", types.ModuleType("_tablecheck_kept")).__dict__
    if "kept" not in store or store["kept"][0] != key:
        store.pop("kept", None)
        store["kept"] = key, make()
    return store["kept"][1]
