"""Large texts split into runs of letters or words part by part, at C speed."""

from __future__ import annotations

from collections.abc import Iterator

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: A-Z becomes a-z; every other byte below 128 a space; bytes from 128 up stay.
_TABLE = bytes(
    _LOWER[_UPPER.index(b)] if b in _UPPER else b if b in _LOWER or b >= 128 else 32
    for b in range(256)
)
PIECE_BYTES = 1 << 20


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in parts of some ``size`` bytes, each but the last ending before a space.

    A longer stretch without a space is a part of its own.
    """
    low = 0
    while low < len(text):
        high = text.find(b" ", low + size)
        high = len(text) if high < 0 else high
        yield text[low:high]
        low = high


def letter_runs(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Runs of ASCII letters (A-Z lower-cased) and bytes from 128 up, part by part; none is cut."""
    for piece in pieces(text.translate(_TABLE), size):
        yield piece.split()
