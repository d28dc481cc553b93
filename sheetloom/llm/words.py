"""Words of many texts at once: blocks of texts are taken apart as arrays of code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points that a task takes apart at once (a longer text is taken by itself).
BLOCK = 1_000_000

ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TABLES: list[np.ndarray] = []


def _tables(largest: int) -> list[np.ndarray]:
    """Class (0 between words, 1 in words, 2 digit) and lower-case form of all code points up to the largest seen."""
    if not _TABLES or len(_TABLES[0]) <= largest:
        n = max(0x3000, largest + 1)
        chars = [chr(i) for i in range(n)]
        lower = [c.lower() for c in chars]
        _TABLES[:] = [np.array([2 if c.isdecimal() else int(c.isalnum()) for c in chars], np.uint8), np.array([ord(c) if len(c) == 1 else i for i, c in enumerate(lower)], np.uint32)]
    return _TABLES


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Words:
    """Words (runs of letters and digits, case ignored) of texts taken apart together: ids, starts (code points from the block's
    beginning), digits (whether a word has one) and of (number of its text); at (where each text begins, and one past the last), sizes."""

    def __init__(self, texts: list[str]) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        kinds, lower = _tables(int(points.max(initial=0)))
        kind = kinds[points]
        inside = kind > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        self.starts, lengths = edges[::2], edges[1::2] - edges[::2]
        self.ids, self.digits = np.empty(0, np.int64), np.empty(0, bool)
        if len(lengths):
            at = np.flatnonzero(inside)
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            with np.errstate(over="ignore"):
                powers = np.cumprod(np.full(int(lengths.max()), ODD, np.uint64))
                letters = (lower[points[at]].astype(np.uint64) + np.uint64(1)) * powers[at - np.repeat(self.starts, lengths)]
                self.ids = (mixed(np.add.reduceat(letters, begin)) >> np.uint64(1)).astype(np.int64)
            self.digits = np.maximum.reduceat(kind[at], begin) == 2
        self.of = np.searchsorted(self.at, self.starts, side="right") - 1


def in_blocks(texts: list[str], size: int = 0) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of at most about BLOCK code points together, each with the number of its first text."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        if i > begin and total + len(text) > (size or BLOCK):
            yield begin, texts[begin:i]
            begin, total = i, 0
        total += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]
