"""Texts cut where any byte-level tokenizer with a space-prefix pattern must cut as well."""

from __future__ import annotations

from collections.abc import Callable, Iterable

#: Chunks that a process remembers at most.  Bounds memory, drops nothing.
REMEMBERED = 600_000


class Memory(dict):
    """What ``work`` gives for a chunk, remembered for up to ``most`` chunks in two generations.

    When the young one is full it becomes the old one, and the old one goes; what is asked for again
    returns to the young one, so frequent chunks stay.
    """

    def __init__(self, work: Callable, most: int = REMEMBERED):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def keep(self, chunk, found) -> None:
        if len(chunk) <= 64:
            if len(self) >= self.most // 2:
                self.old = dict(self)
                self.clear()
            self[chunk] = found

    def keep_all(self, found: dict) -> None:
        if len(self) + len(found) > self.most // 2:
            self.old = dict(self)
            self.clear()
        self.update(found)

    def __missing__(self, chunk):
        found = self.old.get(chunk)
        if found is None:
            found = self.work(chunk)
        self.keep(chunk, found)
        return found


def spaced(text: str) -> list[str] | None:
    """The text cut before every single space; None where a space meets other white space.

    A space between other characters and a character that is no white space always begins a
    piece of the pattern, and what follows does not depend on what went before.  Runs of white
    space are where that ends, so such texts are taken as a whole.
    """
    first, *rest = text.split(" ")
    if "" in rest:
        return None
    for part in rest:
        if part[0].isspace():
            return None
    return [first, *map(" ".__add__, rest)] if first else [*map(" ".__add__, rest)]


def missing(memory: Memory, chunks: Iterable[str]) -> list[str]:
    """The chunks not yet remembered, each once, in any order."""
    old = memory.old
    return [c for c in set(chunks) if c not in memory and c not in old]
