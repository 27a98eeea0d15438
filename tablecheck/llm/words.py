"""Words of raw UTF-8 texts, a stretch at a time, so that no text need be held as a list of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes of a stretch: what is split into words at once.
STRETCH = 1 << 20

_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def lowered(text: bytes) -> bytes:
    """A to Z in lower case, nothing else changed (``bytes.lower`` knows ASCII only)."""
    return text.lower()


def stretches(text: bytes, size: int = STRETCH) -> Iterator[bytes]:
    """The text cut at white space into stretches of about ``size`` bytes, or longer where a word is."""
    start, n = 0, len(text)
    while n - start > size:
        gap = _WHITE.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:]


def spaced_words(text: bytes, size: int = STRETCH) -> Iterator[list[bytes]]:
    """Lists of the words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none are lost at the cuts."""
    for part in stretches(text, size):
        found = part.split()
        if found:
            yield found
