import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import hard_negatives
from vigil.llm._vectors import bound

SCHEMA = "vec_id long, embedding array<double>, label string, key long, slot int, anchor string, score long, x string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 7, 1, "a", 2, "x") for r in rows], SCHEMA).repartition(parts)


def by_hand(rows, positives=5, k=5, low=80, high=100):
    """Every window searched on its own."""
    ok = [(i, v, lab) for i, v, lab in rows if lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v, _ in ok), default=0)
    most = bound(dim, 100)
    ok = [(i, [min(max(math.floor(256 * c), -most), most) for c in v] + [0] * (dim - len(v)), lab) for i, v, lab in ok]
    order = lambda t: (-t[0], t[1] is None, t[1] or 0, t[2])
    out = []
    for n, (i, a, lab) in enumerate(ok):
        if i is None or i % 10:
            continue
        score = [(sum(x * y for x, y in zip(a, v)), j, m) for m, (j, v, _) in enumerate(ok)]
        near = sorted((s for s in score if s[2] != n and ok[s[2]][2] == lab), key=order)[:positives]
        far = sorted((s for s in score if ok[s[2]][2] != lab), key=order)
        for p, j, _ in near:
            for r, (s, g, _) in enumerate([s for s in far if low * p <= 100 * s[0] <= high * p][:k]):
                out.append((i, j, r + 1, g, p, s))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    return sorted((tuple(r) for r in hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, **kw).collect()), key=str)


def some(seed, n, dim=6, values=(-0.5, 0.0, 0.25, 0.5, 1.0)):
    rng = random.Random(seed)
    return [(i, [rng.choice(values) for _ in range(dim)], rng.choice("aab")) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"k": 1, "positives": 1}, {"k": 3, "positives": 8, "low": 50, "high": 130}, {"low": 0}])
def test_equals_windows_searched_alone(spark, kw):
    rows = some(1, 150)
    got = run(spark, rows, **kw)
    assert got == by_hand(rows, **kw) and len(got) > 10


def test_blocks_change_nothing(spark, monkeypatch):
    rows = some(2, 200)
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 18)
    monkeypatch.setattr(hard_negatives, "CELLS", 64)
    assert run(spark, rows) == by_hand(rows)
    monkeypatch.setattr(hard_negatives, "BUFFER", 3)
    assert run(spark, rows) == by_hand(rows)


def test_best_equals_a_full_sort(monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUFFER", 20)
    rng = np.random.default_rng(5)
    best, all_ = hard_negatives.Best(3, 7), []
    for _ in range(60):
        n = int(rng.integers(0, 30))
        part = [rng.integers(0, 7, n), rng.integers(-9, 9, n), rng.integers(0, 2, n), rng.integers(0, 5, n), rng.integers(0, 10**6, n)]
        best.add(*part)
        all_ += list(zip(*(x.tolist() for x in part)))
    want = [r for g in range(7) for r in sorted((r for r in all_ if r[0] == g), key=lambda r: (-r[1], *r[2:]))[:3]]
    assert list(zip(*(x.tolist() for x in best.held))) == want


def test_odd_rows(spark):
    v = [0.5, 0.25, 1.0]
    rows = [(0, v, "a"), (0, v, "a"), (1, v, "a"), (None, v, "a"), (2, v, "b"), (3, v, "b"), (3, v, "b"), (None, v, "b"), (4, [0.5, 0.25, 0.9], "b"), (5, None, "b"), (6, [0.5, None, 1.0], "b"),
            (7, [0.5, float("nan"), 1.0], "a"), (8, [0.5, float("inf"), 1.0], "b"), (9, v, None), (10, [-1.0, 0.0, 0.0], "c"), (11, [1.0, 0.0, 0.0], "c"), (20, v, "d"), (12, [0.5], "b"), (13, [], "a"),
            (30, [0.0, 0.0, 0.0], "e"), (31, v, "e")]
    got = run(spark, rows)
    assert got == by_hand(rows)
    assert {r[0] for r in got} == {0, 30}  # 10's only positive has a negative score, 20 has none
    assert run(spark, []) == [] and run(spark, [(1, v, "a")]) == [] and run(spark, [(10, None, "a")]) == []


def test_large_numbers(spark):
    rows = [(i, [c * 1e5 for c in v], lab) for i, v, lab in some(3, 60)] + [(100, [1e30, 0.0], "a"), (101, [1e30, 0.0], "a"), (102, [1e30, 0.0], "b")]
    assert run(spark, rows) == by_hand(rows)


def test_best_keeps_ties_in_order():
    best = hard_negatives.Best(2, 3)
    one = np.ones(1, np.int64)
    for score, ident, key in ((5, 9, 1), (5, 3, 2), (7, 8, 3), (5, 1, 4), (5, 1, 0)):
        best.add(one, one * score, one * 0, one * ident, one * key)
    assert [h.tolist() for h in best.held] == [[1, 1], [7, 5], [0, 0], [8, 1], [3, 0]]
