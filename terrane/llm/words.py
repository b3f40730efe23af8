"""Word hashes of Arrow text columns, for whole batches at once.

A word is a maximal run of bytes outside space and tab to carriage return. A-Z
count as a-z where ``fold`` is set. Null texts hold no word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # text worked on at once inside a task; a longer single text is a slice of its own
SHINGLE = 5

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, raw[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


class Words:
    """The words of one slice: ``doc`` (row in the slice), ``start``, ``end`` (bytes) and ``hash``."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, fold: bool = True):
        n = len(raw)
        self.rows = len(off) - 1
        if fold:
            raw = _FOLD[raw]
        inside = ~_SEPARATOR[raw]
        cut = np.zeros(n + 1, bool)
        cut[off] = True
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1] | cut[1:n]
            last[:-1] &= ~inside[1:] | cut[1:n]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power("up", _PRIME, n), out=total[1:])
        value = (total[self.end] - total[self.start]) * _power("down", _INVERSE, n + 1)[self.start]
        self.hash = mix(value + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def count(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.rows)

    def shingles(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of ``size`` words; a text with fewer words is one shingle, an empty one none."""
        n, per = len(self.hash), self.count()
        at = np.concatenate([[0], np.cumsum(per)])
        begin = np.arange(n)
        left = at[self.doc + 1] - begin
        keep = (left >= size) | (begin == at[self.doc])
        begin, left = begin[keep], left[keep]
        value = np.zeros(len(begin), np.uint64)
        for k in range(size):
            there = left > k
            value[there] = mix(value[there] * np.uint64(0x9FB21C651E98DF25) + self.hash[begin[there] + k] + np.uint64(k + 1))
        return self.doc[begin], value


def occurrences(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, how many) of the distinct values of each row, ordered by row and value."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))
