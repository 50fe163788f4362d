"""Numpy helpers on many texts at once: one byte buffer, words found by their
separators, and 64-bit polynomial hashes of any byte range.

The hash of a range is ``sum(T[byte] * P**i)`` modulo 2**64, taken from prefix sums
and brought to a common power by the inverse of ``P``; ``T`` is a fixed table of
random odd 64-bit numbers.  Ranges with equal bytes have equal hashes in any text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240611)
TABLE = _RANDOM.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z hash as a-z.
FOLDED = TABLE.copy()
FOLDED[65:91] = TABLE[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Fixed value: the separators of words, space and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes handled at once.
STEP_BYTES = 1_000_000

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n at least."""
    if len(_POWERS[0]) < n:
        for k, b in enumerate((BASE, INVERSE)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray, table: np.ndarray = TABLE):
        forward, self.back = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(table[buf] * forward[:len(buf)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


class Buffer:
    """Texts joined by one space: ``buf``, and where each text starts and ends."""

    def __init__(self, texts: list[bytes]):
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(self.size + 1) - 1
        self.start = self.end - self.size
        self.buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and the number of its text."""
        space = SPACE[self.buf]
        edge = np.diff(space.view(np.int8), prepend=np.int8(1))
        start, end = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
        return start, end, np.searchsorted(self.end, start)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4096) \
        -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """(rows, their texts) of about STEP_BYTES bytes and ``most`` rows; a longer
    text comes alone."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        lo, size, texts = 0, 0, []
        for at in range(batch.num_rows):
            t = column[at].as_py()
            if texts and (size + len(t) > STEP_BYTES or len(texts) >= most):
                yield batch.slice(lo, at - lo), texts
                lo, size, texts = at, 0, []
            texts.append(t)
            size += len(t)
        if texts:
            yield batch.slice(lo), texts
