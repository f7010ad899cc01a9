"""Reading long texts in pieces."""

from __future__ import annotations

from collections.abc import Iterator

BLANKS = b" \t\n\r\x0b\x0c"
STRIDE = 1 << 20


def pieces(data: bytes, stride: int = STRIDE) -> Iterator[bytes]:
    """The text in pieces of about ``stride`` bytes; every piece but the last ends before a blank."""
    start = 0
    while start < len(data):
        stop = start + stride
        while stop < len(data) and data[stop] not in BLANKS:
            stop += 1
        yield data[start:stop]
        start = stop
