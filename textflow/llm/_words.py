"""Texts of an Arrow batch as flat byte arrays: words, word hashes and word shingles without a loop over rows.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, as in the pattern [^\\x20\\x09-\\x0D]+ over code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64; kept up to 4M entries."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 20), base & _MASK, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if len(out) > 1 << 22:
            return out[:n]
        _POWERS[base] = have = out
    return have[:n]


def prefix_hash(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """P with P[i] = sum of (byte j + 1) * base ** j for j < i; window() turns two entries into a substring's hash."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), base), out=out[1:])
    return out


def window(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of data[start:end], the same wherever the bytes stand."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), pow(base, -1, 1 << 64))[start] + (end - start).astype(np.uint64))


@dataclass
class Texts:
    """Consecutive rows of a batch: row first + i has the bytes data[starts[i]:ends[i]]; nulls are empty."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def texts(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[Texts]:
    """The rows of a string column in order, in pieces of about most_bytes; a longer text is a piece of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most_bytes, "right")) - 1)
        j = min(j, len(column))
        yield Texts(i, raw[at[i] : at[j]], at[i:j] - at[i], at[i + 1 : j + 1] - at[i])
        i = j


@dataclass
class Words:
    """Words of Texts in order: bytes start:end, the row (index in the piece) and the number of words of each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    count: np.ndarray


def words(t: Texts) -> Words:
    solid = ~SPACE[t.data]
    n = len(solid)
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
        full = t.ends > t.starts
        before[t.starts[full]] = False
        after[t.ends[full] - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    count = np.searchsorted(start, t.ends) - np.searchsorted(start, t.starts)
    return Words(start, end, np.repeat(np.arange(len(t)), count), count)


_LAST = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [_MASK], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FIRST = mix(np.array([_STEP]))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], none empty: the sum of their blocks of eight bytes, each mixed with its place, mixed with the
    length. Unlike window() it isn't linear in the bytes, so no pattern of bytes makes words collide whatever the base; any two
    words do with a probability of 2 ** -64."""
    n = (end - start).astype(np.int64)
    blocks = (n + 7) >> 3
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    sums = mix((eight[start] & _LAST[np.minimum(n, 8)]) + _FIRST)
    more = np.flatnonzero(blocks > 1)
    if len(more):
        rest = blocks[more] - 1
        first = np.cumsum(rest) - rest
        k = np.arange(int(rest.sum())) - np.repeat(first, rest) + 1
        at = np.repeat(start[more], rest) + 8 * k
        x = eight[at] & _LAST[np.minimum(np.repeat(end[more], rest) - at, 8)]
        sums[more] += np.add.reduceat(mix(x + mix((k + 1).astype(np.uint64) * _STEP)), first)
    return mix(sums + n.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


_SLOTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(w: Words, h: np.ndarray, size: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each window of `size` words, in order; with `short`, a row of fewer words has one window of them all."""
    slots = np.resize(_SLOTS, size)
    n = len(h)
    if n >= size:
        x = np.zeros(n - size + 1, np.uint64)
        for i in range(size):
            x += h[i : n - size + 1 + i] * slots[i]
        inside = w.row[: n - size + 1] == w.row[size - 1 :]
        rows, out = w.row[: n - size + 1][inside], mix(x[inside])
    else:
        rows, out = np.empty(0, np.int64), np.empty(0, np.uint64)
    few = np.flatnonzero((w.count > 0) & (w.count < size)) if short else np.empty(0, np.int64)
    if len(few):
        begin = np.cumsum(w.count) - w.count
        x = np.zeros(len(few), np.uint64)
        for i in range(size - 1):
            has = w.count[few] > i
            x[has] += h[begin[few[has]] + i] * slots[i]
        rows = np.concatenate([rows, few])
        out = np.concatenate([out, mix(x + w.count[few].astype(np.uint64))])
        order = np.argsort(rows, kind="stable")
        rows, out = rows[order], out[order]
    return rows, out


def by_row_then_value(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values)
    order = order[np.argsort(rows[order].astype(np.uint16) if len(rows) and rows[-1] < 1 << 16 else rows[order], kind="stable")]
    return rows[order], values[order]


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted."""
    rows, values = by_row_then_value(rows, values)
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]
