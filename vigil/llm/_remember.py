"""Ids of text pieces, remembered in hash tables that are probed a whole batch at a time with numpy.

A piece is known by its length, its first and last eight bytes and a 64-bit hash, so pieces of up to 16 bytes are compared
whole; longer ones are taken for equal where the hash and these 16 bytes agree. There are two tables: when the new one
is full it becomes the old one, and what is found in the old one moves to the new, so pieces in use stay known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

from vigil.llm._text import mix

WHOLE = 16
_MASKS = np.array([(1 << 8 * min(i, 8)) - 1 for i in range(9)], np.uint64)


def piece_keys(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first eight bytes, last eight bytes) of every piece; the bytes of shorter pieces all stand in the first."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    size = end - start
    first = words[start] & _MASKS[np.minimum(size, 8)]
    last = np.where(size > 8, words[np.maximum(end - 8, 0)], np.uint64(0))
    key = mix(first ^ mix(last ^ size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    long = np.flatnonzero(size > WHOLE)
    if len(long):
        view = memoryview(padded)
        key[long] = np.frombuffer(b"".join(hashlib.blake2b(view[a:b], digest_size=8).digest()
                                           for a, b in zip(start[long].tolist(), end[long].tolist())), "<u8")
    return key, first, last


class _Table:
    """Open addressing with linear probing, at most half full. A slot holds the number of a piece, which stays the same as the table grows."""

    def __init__(self, slots: int) -> None:
        self.slots = np.full(slots, -1, np.int32)
        half = slots // 2
        self.keys = [np.zeros(half, np.uint64) for _ in range(3)]
        self.at, self.count = np.zeros(half, np.int64), np.zeros(half, np.int32)
        self.ids, self.used, self.n = np.zeros(1 << 14, np.uint32), 0, 0

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, *keys: np.ndarray) -> np.ndarray:
        """The number of every piece, or -1."""
        out = np.full(len(keys[0]), -1, np.int64)
        slot, open_ = self._home(keys[0]), np.arange(len(keys[0]))
        while len(open_):
            piece = self.slots[slot[open_]]
            there = piece >= 0
            hit = there.copy()
            for mine, theirs in zip(self.keys, keys):
                hit &= mine[piece] == theirs[open_]
            out[open_[hit]] = piece[hit]
            open_ = open_[there & ~hit]
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
        return out

    def add(self, keys: list[np.ndarray], flat: np.ndarray, count: np.ndarray) -> None:
        """Put in pieces that aren't there; ``flat`` has their ids one after another."""
        n = self.n + len(count)
        if 2 * n > len(self.slots):
            half = 1 << (n - 1).bit_length()
            self.slots = np.full(2 * half, -1, np.int32)
            self.keys = [np.concatenate([k[:self.n], np.zeros(half - self.n, k.dtype)]) for k in self.keys]
            self.at, self.count = (np.concatenate([k[:self.n], np.zeros(half - self.n, k.dtype)]) for k in (self.at, self.count))
            self._place(np.arange(self.n))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        for mine, new in zip([*self.keys, self.at, self.count], [*keys, self.used + np.cumsum(count) - count, count]):
            mine[self.n:n] = new
        self.used += len(flat)
        self._place(np.arange(self.n, n))
        self.n = n

    def _place(self, piece: np.ndarray) -> None:
        slot, open_ = self._home(self.keys[0][piece]), np.arange(len(piece))
        while len(open_):
            free = open_[self.slots[slot[open_]] < 0]
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.slots[slot[won]] = piece[won]
            lost = np.ones(len(piece), bool)
            lost[won] = False
            open_ = open_[lost[open_]]
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)

    def of(self, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces by their numbers, one after another, the number of each piece's ids)."""
        count = self.count[piece].astype(np.int64)
        ends = np.cumsum(count)
        return self.ids[np.repeat(self.at[piece] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)], count


class Remembered:
    """``encode`` gives the ids of a list of pieces as a list of arrays; a table has ``size`` pieces when it's full."""

    def __init__(self, encode: Callable[[list[str]], list], size: int) -> None:
        self.encode, self.size = encode, size
        self.new, self.old = _Table(1 << 12), _Table(2)

    def of(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, the number of each piece's ids)."""
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.new.n >= self.size:
            self.new, self.old = _Table(1 << 12), self.new
        keys = piece_keys(raw, start, end)
        piece = self.new.find(*keys)
        missing = np.flatnonzero(piece < 0)
        if len(missing):
            one = missing[np.unique(keys[0][missing], return_index=True)[1]]
            was = self.old.find(*(k[one] for k in keys))
            known, unknown = one[was >= 0], one[was < 0]
            if len(known):
                self.new.add([k[known] for k in keys], *self.old.of(was[was >= 0]))
            if len(unknown):
                got = self._encoded(raw, start[unknown], end[unknown])
                self.new.add([k[unknown] for k in keys], np.concatenate(got), np.array([len(x) for x in got], np.int64))
            piece[missing] = self.new.find(*(k[missing] for k in keys))
            lost = np.flatnonzero(piece < 0)
            if len(lost):  # another piece of the batch has the same hash: encoded on its own, not remembered
                own = dict(zip(lost.tolist(), self._encoded(raw, start[lost], end[lost])))
                parts = [own[i] if i in own else self.new.of(piece[i:i + 1])[0] for i in range(len(piece))]
                return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return self.new.of(piece)

    def _encoded(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        view = memoryview(raw)
        return [np.asarray(x, np.uint32) for x in self.encode([bytes(view[a:b]).decode() for a, b in zip(start.tolist(), end.tolist())])]
