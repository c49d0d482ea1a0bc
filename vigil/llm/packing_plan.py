"""The plan of a packing, made from counts of lengths alone: its size depends on the capacity and the number
of groups, not on the number of items.

Large items, by descending length, are cut into groups of equal cardinality; every item counts as long as
its group's longest. A configuration says how many items of each group share a sequence. Their numbers come
from the linear program that covers all groups with the fewest sequences (columns by a knapsack over the
program's prices); it is rounded down, and what is left over is packed by best fit. Small items then go, longest first, to
the fullest sequence that has room.

Items are known by their place among those of their group or length, sequences by their place in an order, so a
plan tells any number of items their sequence by arithmetic.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

import numpy as np

#: Steps of the linear program at most; it only gets better by each, and any step's solution can be used.
STEPS = 2000


def group_counts(counts: np.ndarray, groups: int) -> list[tuple[int, int]]:
    """(rounded length, items) of the groups, longest first; ``counts[l]`` items have length l. Sizes of groups differ by one at most."""
    lengths = np.flatnonzero(counts)[::-1]
    ends = np.cumsum(counts[lengths])
    n = int(ends[-1]) if len(ends) else 0
    groups = min(groups, n)
    cuts = [n * g // groups for g in range(groups + 1)] if groups else []
    return [(int(lengths[np.searchsorted(ends, a, "right")]), b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def group_number(counts: np.ndarray, small_tokens: int, choices: Iterable[int] = (16, 32, 64, 128)) -> int:
    """The fewest groups whose rounding adds no more than half of what small items can fill again; else the most."""
    tokens = int((counts * np.arange(len(counts))).sum())
    for n in choices:
        if 2 * (sum(length * items for length, items in group_counts(counts, n)) - tokens) <= small_tokens:
            break
    return n


def _best_configuration(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity that has the highest price (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for i in np.flatnonzero(price > 1e-12).tolist():
        s = int(sizes[i])
        for at in range(s, capacity + 1, s):  # chunks of s places: each builds on the chunk before
            to = min(at + s, capacity + 1)
            got = best[at - s:to - s] + price[i]
            better = got > best[at:to] + 1e-12
            best[at:to][better] = got[better]
            last[at:to][better] = i
    took, at = np.zeros(len(sizes), np.int64), capacity
    while last[at] >= 0:
        took[last[at]] += 1
        at -= int(sizes[last[at]])
    return float(price @ took), took


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """(items of each size, sequences) that together hold exactly ``demand[i]`` items of ``sizes[i]``."""
    if not sizes:
        return []
    size, need = np.array(sizes, np.int64), np.array(demand, np.float64)
    basis = np.diag(capacity // size).astype(np.float64)
    inverse = np.diag(1.0 / np.diag(basis))
    for _ in range(STEPS):
        value, column = _best_configuration(size, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        turn = inverse @ column
        amount = inverse @ need
        ratio = np.where(turn > 1e-9, np.maximum(amount, 0) / np.where(turn > 1e-9, turn, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
    times = np.floor(np.maximum(inverse @ need, 0) + 1e-6).astype(np.int64)
    left, found = np.array(demand, np.int64), []
    for j in np.argsort(-(basis.T @ size), kind="stable").tolist():
        column = basis[:, j].astype(np.int64)
        there = column > 0
        n = min(int(times[j]), int((left[there] // column[there]).min()))
        if n > 0:
            found.append((column, n))
            left -= n * column
    return found + _best_fit_rest(size, left, capacity)


def _best_fit_rest(size: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    fit = BestFit(capacity)
    order = np.argsort(-size, kind="stable")
    held: dict[int, np.ndarray] = {}
    for i in order.tolist():
        for start, bins, each, items in fit.add(int(size[i]), int(left[i])):
            for b in range(start, start + bins):
                n = min(each, items)
                held.setdefault(b, np.zeros(len(size), np.int64))[i] += n
                items -= n
    return [(column, 1) for _, column in sorted(held.items())]


class LargePlan:
    """Where large items go: ``counts`` are those of all lengths, items from ``least`` tokens on are large."""

    def __init__(self, counts: np.ndarray, capacity: int, least: int) -> None:
        large = counts.copy()
        large[:least] = 0
        small_tokens = int((counts[:least] * np.arange(least)).sum())
        groups = group_counts(large, group_number(large, small_tokens))
        self.ends = np.cumsum([n for _, n in groups])
        found = configurations([length for length, _ in groups], [n for _, n in groups], capacity)
        #: For each group the configurations that use it: (items before them, items a sequence, first sequence).
        self.slots: list[list[tuple[int, int, int]]] = [[] for _ in groups]
        taken, self.n = [0] * len(groups), 0
        for column, times in found:
            for g in np.flatnonzero(column).tolist():
                self.slots[g].append((taken[g], int(column[g]), self.n))
                taken[g] += int(column[g]) * times
            self.n += times

    def sequences(self, rank: np.ndarray) -> np.ndarray:
        """The sequence of each large item, by its place among all of them, longest first."""
        out = np.empty(len(rank), np.int64)
        group = np.searchsorted(self.ends, rank, "right")
        for g in np.unique(group).tolist():
            rows = np.flatnonzero(group == g)
            place = rank[rows] - (self.ends[g - 1] if g else 0)
            before, each, first = np.array(self.slots[g]).T
            i = np.searchsorted(before, place, "right") - 1
            out[rows] = first[i] + (place - before[i]) // each[i]
        return out


class SmallPlan:
    """Where small items go: best fit, longest first, into sequences numbered by their free tokens."""

    def __init__(self, counts: np.ndarray, capacity: int, least: int, room: list[tuple[int, int]]) -> None:
        fit = BestFit(capacity, room)
        longer = int(counts[least:].sum())
        self.first = np.zeros(least + 1, np.int64)
        self.runs: dict[int, np.ndarray] = {}
        for length in range(least - 1, 0, -1):
            self.first[length] = longer
            if counts[length]:
                runs = np.array(fit.add(length, int(counts[length])))
                before = np.cumsum(runs[:, 3]) - runs[:, 3]
                self.runs[length] = np.stack([before, runs[:, 2], runs[:, 0]])
                longer += int(counts[length])
        self.n = fit.n

    def sequences(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The sequence of each small item, by its length and its place among all items, longest first."""
        out = np.empty(len(rank), np.int64)
        for size in np.unique(length).tolist():
            rows = np.flatnonzero(length == size)
            place = rank[rows] - self.first[size]
            before, each, start = self.runs[size]
            i = np.searchsorted(before, place, "right") - 1
            out[rows] = start[i] + (place - before[i]) // each[i]
        return out


class BestFit:
    """Best fit over sequences with known room, in runs of neighbours with equal room.

    ``room`` has (free tokens, sequences) of the sequences there are, numbered in this order from 0; new ones follow.
    """

    def __init__(self, capacity: int, room: Iterable[tuple[int, int]] = ()) -> None:
        self.capacity, self.n = capacity, 0
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.free: list[int] = []
        for free, n in room:
            self._put(free, self.n, n)
            self.n += n

    def _put(self, free: int, start: int, n: int) -> None:
        if n and free > 0:
            if free not in self.runs:
                self.runs[free] = []
                self.free.insert(bisect_left(self.free, free), free)
            self.runs[free].append((start, n))

    def _fill(self, length: int, items: int, free: int, start: int, n: int) -> tuple[int, int, int, int]:
        """Place items in a run whose sequences hold several of them each: (start, sequences, items a sequence, items)."""
        each = free // length
        whole, rest = divmod(items, each)
        if whole >= n:
            self._put(free - each * length, start, n)
            return start, n, each, n * each
        self._put(free - each * length, start, whole)
        self._put(free - rest * length, start + whole, 1 if rest else 0)
        self._put(free, start + whole + bool(rest), n - whole - bool(rest))
        return start, whole + bool(rest), each, items

    def add(self, length: int, items: int) -> list[tuple[int, int, int, int]]:
        """Place items of one length: (first sequence, sequences, items a sequence, items in all) in the items' order."""
        out = []
        while items:
            at = bisect_left(self.free, length)
            if at == len(self.free):
                n = -(-items // (self.capacity // length))
                out.append(self._fill(length, items, self.capacity, self.n, n))
                self.n += n
            else:
                free = self.free[at]
                runs = self.runs[free]
                start, n = runs.pop(0)
                if not runs:
                    del self.runs[free], self.free[at]
                out.append(self._fill(length, items, free, start, n))
            items -= out[-1][3]
        return out
