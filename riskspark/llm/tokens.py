"""Words of many texts at once: positions and hashes from the texts' bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Kinds of bytes: 0 separates, 1 is part of words, 2 of runs of marks.
KINDS = np.array([1 if chr(b).isalnum() or b >= 0x80 else 2 if 33 <= b < 127 else 0 for b in range(256)], np.uint8)
WORDS = np.where(KINDS == 2, 0, KINDS).astype(np.uint8)
_MULT = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64)]


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Runs:
    """Maximal runs of bytes of one kind over joined texts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: the text each run is in, and each text's first run (and one more)
    text: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each run's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        longest = int(size.max())
        if len(_powers[0]) < longest:
            steps = np.full(1 << longest.bit_length(), _MULT, np.uint64)
            steps[0] = 1
            _powers[0] = np.cumprod(steps)
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(first, size)
        value = (self.data[np.repeat(self.start, size) + at].astype(np.uint64) + np.uint64(1)) * _powers[0][at]
        return scramble(np.add.reduceat(value, first))


def runs(texts: list[bytes | None], kinds: np.ndarray, table: bytes | None = None) -> Runs:
    """The runs of all texts; bytes first go through `table`, if given."""
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    data = np.frombuffer(joined.translate(table) if table else joined, np.uint8)
    kind = kinds[data]
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True])
    start, end = edge[:-1], edge[1:]
    full = kind[start] > 0
    start, end = start[full], end[full]
    begin = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    return Runs(data, start, end, np.searchsorted(begin, start, side="right") - 1, np.searchsorted(start, begin))


def sum_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows of `values` by text; texts without runs get zeros."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out
