"""Words and shingles of Arrow string columns, hashed a whole batch at a time with numpy.

A word is a run of bytes outside 0x20 and 0x09-0x0D; A-Z count as a-z where ``fold`` is set. A word
hash is a 64-bit polynomial over a fixed random byte table, read off prefix sums, so no Python loop
runs over words. Two different words or shingles collide with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.Generator(np.random.PCG64(20240229))
_PLAIN = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_FOLDED = _PLAIN.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
BLOCK = 1 << 18
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if n <= 2 * BLOCK:  # a table for one huge word isn't kept
            _POWERS[base] = have
    return have


def buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of a string column (null: empty) and the n + 1 row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def small(batches: Iterator[pa.RecordBatch], at: int, limit: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts (column ``at``) have at most ``limit`` bytes; a longer text is a
    batch of its own. So what a task holds is bounded by the limit or by its longest text."""
    for b in batches:
        _, offs = buffer(b.column(at))
        i = 0
        while i < b.num_rows:
            to = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
            yield b.slice(i, to - i)
            i = to


def word_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a row's end always ends a word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offs[1:] > offs[:-1]
    first, last = offs[:-1][full], offs[1:][full] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each span; spans are ascending and don't overlap."""
    out = np.empty(len(start), np.uint64)
    table, at = (_FOLDED if fold else _PLAIN), 0
    while at < len(start):
        low = start[at]
        to = max(at + 1, int(np.searchsorted(end, low + BLOCK, "right")))
        s, e = start[at:to] - low, end[at:to] - low
        n = int(e[-1])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[raw[low:low + n]] * _powers(_BASE, max(n + 1, BLOCK + 1))[:n], out=sums[1:])
        h = (sums[e] - sums[s]) * _powers(_INVERSE, max(n + 1, BLOCK + 1))[s]
        out[at:to] = mix(h ^ (e - s).astype(np.uint64))
        at = to
    return out


def words_of(column, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all rows one after another, n + 1 offsets of the rows in them)."""
    raw, offs = buffer(column)
    s, e = word_spans(raw, offs)
    return span_hashes(raw, s, e, fold), np.searchsorted(s, offs)


def _chain(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + p)
    return h


def shingle_sets(hashes: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row its distinct k-word shingles, ascending. A row with 1 to k-1 words has its whole
    sequence as the only one; a row without words has none."""
    n = len(hashes)
    whole = _chain([hashes[j:n - k + 1 + j] for j in range(k)]) if n >= k else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        if b - a >= k:
            u = np.sort(whole[a:b - k + 1])
            keep = np.ones(len(u), bool)
            np.not_equal(u[1:], u[:-1], out=keep[1:])
            out.append(u[keep])
        elif b > a:
            out.append(_chain([hashes[i:i + 1] for i in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_sets(column, k: int) -> list[np.ndarray]:
    return shingle_sets(*words_of(column), k)
