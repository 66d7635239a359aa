"""Whole texts in pieces: where a text may be cut without changing how byte-level BPE splits it into words."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import regex

#: Before one space between two characters that are no white space, or between a letter and a digit.  A word of the
#: pattern below holds white space at its start only, and never both letters and digits, so a word ends there in any case.
SAFE = regex.compile(r"(?<=\S)(?= \S)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def pieces(text: str, size: int, boundary: regex.Pattern = SAFE) -> Iterator[str]:
    """Pieces of about `size` characters, cut where `boundary` matches (what it matches is left out); one longer piece where it never does."""
    at = 0
    while len(text) - at > size:
        m = boundary.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def batches_by_bytes(texts: list[str], most: int, size: int, boundary: regex.Pattern | None = SAFE) -> Iterator[list[tuple[int, str]]]:
    """(index of the text, piece) in lists of about equal UTF-8 bytes, `most` or a little more; each text's pieces come in order.

    Texts above `size` bytes are cut at boundaries, and with boundary None never.
    """
    parts, ends, total = [], [], 0
    for i, text in enumerate(texts):
        n = n_bytes(text)
        for piece in pieces(text, max(1, size * len(text) // n), boundary) if boundary and n > size else (text,):
            total += n_bytes(piece)
            parts.append((i, piece))
            ends.append(total)
    share, at = total / max(1, -(-total // most)), 0
    while at < len(parts):
        to = bisect.bisect_left(ends, (ends[at - 1] if at else 0) + share) + 1
        to = bisect.bisect_right(ends, ends[min(to, len(parts)) - 1])  # empty texts come along
        yield parts[at:to]
        at = to
