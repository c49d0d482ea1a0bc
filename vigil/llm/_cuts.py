"""Whole Arrow batches of texts cut into the pieces that byte-level tokenizers merge within, with numpy.

Cuts are those of the usual pattern (``USUAL``), for texts in code points up to U+024F; other texts are left
to the caller. Each worker remembers the ids of a bounded number of pieces (``_remember``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow.compute as pc

from vigil.llm._remember import Remembered
from vigil.llm._text import buffer

USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE, LETTER, NUMBER, OTHER, FAR = range(5)
#: The pattern's classes up to U+024F.
_LETTERS = "ªµº" + "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x250)]))
_NUMBERS = "0123456789²³¹¼½¾"
_CLASS = np.full(0x800, FAR, np.uint8)
_CLASS[:0x250] = OTHER
_CLASS[[ord(c) for c in _LETTERS]] = LETTER
_CLASS[[ord(c) for c in _NUMBERS]] = NUMBER
_CLASS[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]] = SPACE
_CLASS[0x1C:0x20] = FAR  # controls that libraries disagree on
_BYTE = np.where(np.arange(256) < 0x80, _CLASS[:256], OTHER).astype(np.uint8)
_BYTE[0xE0:] = FAR
_QUOTE = ord("'")


def classes(raw: np.ndarray) -> np.ndarray:
    """The class of every byte of UTF-8 text: that of its code point."""
    out = _BYTE[raw]
    lead = np.flatnonzero((raw >= 0xC0) & (raw < 0xE0))
    if len(lead):
        of = _CLASS[(raw[lead].astype(np.int64) & 0x1F) << 6 | raw[lead + 1] & 0x3F]
        out[lead] = of
        out[lead + 1] = of
    return out


def pieces(raw: np.ndarray, kind: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where pieces start; each ends at the next one's start (the last at the end). A text's start is one."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    start = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    full = offs[:-1][offs[1:] > offs[:-1]]
    first = np.zeros(n + 1, bool)
    first[full] = True
    first[n] = True
    start |= first
    # white space before something else of its text: its last character is a piece of its own, or joins
    # what follows if it's a blank
    run = np.flatnonzero(start[:n] & (kind != SPACE) & ~first[:n])
    run = run[kind[run - 1] == SPACE]
    tail = run - 1  # the last character's first byte
    wide = raw[tail] >= 0x80
    tail = tail - wide
    start[tail] = True
    start[run[raw[tail] == 0x20]] = False
    # a quote of its own with letters behind it, not joined by a blank, may begin a contraction
    at = np.flatnonzero(start[:n - 1] & (raw[:-1] == _QUOTE) & start[1:n] & (kind[1:] == LETTER) & ~first[1:n])
    if len(at):
        ends = np.append(full[1:], n)
        room = ends[np.searchsorted(full, at, "right") - 1] - at
        a = raw[at + 1]
        b = raw[np.minimum(at + 2, n - 1)]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = (room > 2) & ((a == ord("r")) & (b == ord("e")) | (a == ord("v")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        for hit, size in ((at[one], 2), (at[two], 3)):
            start[hit + 1] = False
            start[hit + size] = True
    return np.flatnonzero(start[:n])


class PieceIds:
    """Ids of texts through remembered pieces. ``encode`` gives the ids of new pieces, ``whole`` those of texts
    with far code points or one of the strings ``apart``; both as lists of arrays."""

    def __init__(self, encode: Callable[[list[str]], list], whole: Callable[[list[str]], list], size: int, apart: list[str] | None = None) -> None:
        self.known, self.whole, self.apart = Remembered(encode, size), whole, apart or []

    def of(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, n + 1 offsets of the texts in them)."""
        raw, offs = buffer(column)
        n = len(offs) - 1
        kind = classes(raw)
        far = np.diff(np.searchsorted(np.flatnonzero(kind == FAR), offs)) > 0
        for x in self.apart:
            far |= np.asarray(pc.fill_null(pc.match_substring(column, x), False))
        far = np.flatnonzero(far)
        start = pieces(raw, kind, offs)
        size = np.zeros(n, np.int64)
        flat = np.zeros(0, np.uint32)
        if len(start):
            end = np.append(start[1:], len(raw))
            text = np.searchsorted(offs, start, "right") - 1
            if len(far):
                near = ~np.isin(text, far)
                start, end, text = start[near], end[near], text[near]
        if len(start):
            flat, count = self.known.of(raw, start, end)
            size = np.bincount(text, count, n).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum(size)])
        if not len(far):
            return flat, cuts
        texts = column.to_pylist()
        whole = dict(zip(far.tolist(), (np.asarray(x, np.uint32) for x in self.whole([texts[i] for i in far]))))
        parts = [whole.get(i, flat[cuts[i]:cuts[i + 1]]) for i in range(n)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
