"""Texts of an Arrow batch as flat numpy arrays: bytes, words, lines and their hashes.

The operators that run Python work on slices of a batch that hold a MB of text (a longer text is a slice of its own), so
memory doesn't depend on the rows in a batch, and a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: Fixed value: the bytes that separate words, \x09 to \x0D and \x20.
SEPARATORS = (9, 10, 11, 12, 13, 32)
NEWLINE = 10

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SEPARATORS)] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2 ** 64 for i below n or more."""
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p)
    return _powers[base]


def byte_values(data: np.ndarray) -> np.ndarray:
    return _OF_BYTE[data]


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``values[start:end]``, equal for equal runs wherever they stand."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(_BASE, n)[:n], out=total[1:])
    return mix((total[end] - total[start]) * _power(_INVERSE, n + 1)[start])


@dataclass
class Texts:
    """Texts back to back: text i is ``data[offset[i]:offset[i + 1]]``.  A null text is empty."""

    data: np.ndarray
    offset: np.ndarray

    def __len__(self) -> int:
        return len(self.offset) - 1

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of per-byte values by text."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.offset[1:]] - total[self.offset[:-1]]

    def byte_values(self) -> np.ndarray:
        return byte_values(self.data)


@dataclass
class Words:
    """Words of texts: word j is ``data[start[j]:end[j]]``; those of text i are ``first[i]`` to ``first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, n: int) -> np.ndarray:
        """Word indices at which n words of one text start."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        at = np.arange(len(self.start))
        return at[at + n <= last]


def texts(column: pa.Array) -> Texts:
    column = column.cast(pa.large_string()).fill_null("") if column.type != pa.large_binary() else column.fill_null(b"")
    _, at, data = column.buffers()
    offset = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if at else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[offset[0] : offset[-1]] if data else np.zeros(0, np.uint8)
    return Texts(flat, offset - offset[0])


def words(t: Texts) -> Words:
    """Words never reach over the end of a text."""
    return runs(t, ~_IS_SPACE)


def runs(t: Texts, members: np.ndarray) -> Words:
    """Maximal runs, within a text, of the bytes that ``members`` (256 flags) names."""
    n = len(t.data)
    inside = members[t.data]
    cut = np.zeros(n + 1, bool)
    cut[t.offset] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(start)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, t.offset))


def lines(t: Texts) -> Words:
    """Lines between newlines, those without a character included; an empty text has one empty line."""
    breaks = np.flatnonzero(t.data == NEWLINE)
    starts = np.concatenate([t.offset[:-1], breaks + 1])
    # A newline at the very end of a text starts an empty line there, which sorts before the next text's first line.
    text = np.concatenate([np.arange(len(t)), np.searchsorted(t.offset, breaks, side="right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    ends = np.empty_like(starts)
    same = text[1:] == text[:-1] if len(text) else np.zeros(0, bool)
    if len(text):
        ends[:-1] = np.where(same, starts[1:] - 1, t.offset[text[:-1] + 1])
        ends[-1] = t.offset[text[-1] + 1]
    return Words(starts, ends, np.searchsorted(text, np.arange(len(t) + 1)))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Batches cut into runs of rows with at most ``most`` bytes of text, or one row."""
    for batch in batches:
        whole = texts(batch.column(column))
        lo, n = 0, len(whole)
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(whole.offset, whole.offset[lo] + most, side="right")) - 1)
            hi = min(hi, n)
            a, b = whole.offset[lo], whole.offset[hi]
            yield batch.slice(lo, hi - lo), Texts(whole.data[a:b], whole.offset[lo : hi + 1] - a)
            lo = hi
