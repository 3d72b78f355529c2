"""White-space separated words of one text, a slice at a time, so that long texts stay small."""

from __future__ import annotations

import re
from collections.abc import Iterator

SLICE = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_slices(text: bytes, most: int | None = None) -> Iterator[list[bytes]]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order, in lists of about `most` bytes of it.

    `bytes.split()` separates by exactly these six characters. A slice ends at white space; a
    longer word is in one slice.
    """
    most = most or SLICE
    if len(text) <= most:
        yield text.split()
        return
    at = 0
    while at < len(text):
        cut = _WHITE.search(text, at + most)
        to = cut.start() if cut else len(text)
        yield text[at:to].split()
        at = to
