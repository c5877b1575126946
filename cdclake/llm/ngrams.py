"""Hashed character n-grams of whole texts in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points that are hashed at once: bounds memory for texts of any length.
BLOCK = 1 << 18
FACTOR, SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def hashed_ngrams(text: str, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Buckets in 0 to 2**bits - 1 of the n-grams of the text in lower case with a space at either end, block by block."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(codes), BLOCK):
        c = codes[at : at + BLOCK + max(sizes) - 1].astype(np.uint64)
        h = np.zeros(len(c), np.uint64)
        for n in range(1, max(sizes) + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = h[:m] * FACTOR + c[n - 1 :]
            if n in sizes:
                own = h[: min(m, BLOCK)]  # the rest begins in the next block
                yield (((own ^ (own >> np.uint64(29))) + np.uint64(n)) * SPREAD >> np.uint64(64 - bits)).astype(np.int64)


def bucket_counts(text: str, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur, ascending, and how often."""
    total = None
    for h in hashed_ngrams(text, sizes, bits):
        own = np.bincount(h, minlength=1 << bits)
        total = own if total is None else total + own
    if total is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(total)
    return at, total[at]


class Presence:
    """Which buckets occur, by a board that is used again for each text."""

    def __init__(self, sizes: tuple[int, ...], bits: int):
        self.sizes, self.bits, self.board = sizes, bits, np.zeros(1 << bits, bool)

    def __call__(self, text: str) -> np.ndarray:
        for h in hashed_ngrams(text, self.sizes, self.bits):
            self.board[h] = True
        at = np.flatnonzero(self.board)
        self.board[at] = False
        return at
