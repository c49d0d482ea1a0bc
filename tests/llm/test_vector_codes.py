import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import vector_codes
from vigil.llm._vectors import bound

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, x int, row string, error long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "c", 1, "r", 2) for r in rows], SCHEMA).repartition(parts)


def full_search(rows, parts, n_entries, rounds):
    """By definition: every part against every entry, in plain Python."""
    ok = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v, _ in ok), default=0)
    step = -(-dim // parts)
    most = bound(step * parts, 4)
    whole = sorted(((i is None, i or 0), [min(max(math.floor(256 * float(np.float32(c))), -most), most) for c in v] + [0] * (step * parts - len(v)), i, lab) for i, v, lab in ok)
    cut = [[w[1][p * step:(p + 1) * step] for p in range(parts)] for w in whole]
    books = [[cut[e][p] for e in range(min(n_entries, len(cut)))] for p in range(parts)]

    def assign():
        out = []
        for x in cut:
            best = [min((sum((a - b) ** 2 for a, b in zip(x[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)]
            out.append(([b[1] for b in best], sum(b[0] for b in best)))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                of = [x[p] for x, (c, _) in zip(cut, codes) if c[p] == e]
                if of:
                    books[p][e] = [sum(col) // len(of) for col in zip(*of)]
    codes = assign()
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    total = {}
    for (_, _, _, lab), (_, err) in zip(whole, codes):
        total[lab] = total.get(lab, 0) + err
    return sorted((str(i), "".join(f"{c:02x}" for c in code), err, total[lab], sha) for (_, _, i, lab), (code, err) in zip(whole, codes))


def run(spark, rows, **kw):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.coded_digest(frame(spark, rows), **kw).collect())


def test_equals_full_search(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) if i % 3 else rng.gauss(0, 1) for _ in range(8)], rng.choice([0, 1, None])) for i in range(300)]
    for rounds in (0, 1, 4):
        assert run(spark, rows, parts=4, entries=16, rounds=rounds) == full_search(rows, 4, 16, rounds)


def test_odd_rows(spark):
    rng = random.Random(2)
    v = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(3, v, 1), (3, v, 1), (3, v[::-1], 1), (None, v, None), (4, None, 1), (5, [*v[:7], None], 1), (6, [*v[:7], float("nan")], 1), (7, [*v[:7], float("-inf")], 1),
            (8, v[:5], 2), (9, [], 2), (10, [3e38] * 8, 3), (11, [*v, 1.0], 2), (2, [0.0] * 8, 1)]
    for entries in (2, 64):
        got = run(spark, rows, parts=4, entries=entries, rounds=2)
        assert got == full_search(rows, 4, entries, 2) and len(got) == 9
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == []
    assert [r[1] for r in run(spark, [(1, [0.5], 1), (2, [0.25], 1)])] == ["00" * 16, "01" + "00" * 15]


def test_active_entries_equal_a_full_scan():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, entries = rng.integers(-3, 4, (40, 2)), rng.integers(-3, 4, (7, 2))
        code, far = vector_codes.nearest(x, entries)
        moved = rng.random(7) < rng.choice([0, 0.3, 1])
        new = entries + moved[:, None] * rng.integers(-1, 2, (7, 2))
        got = vector_codes.reassign(x, new, moved, code, far)
        want = vector_codes.nearest(x, new)
        assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_only_moved_entries_are_looked_at(monkeypatch):
    looked = []
    plain = vector_codes.nearest
    x, entries = np.array([[0], [10], [20]]), np.array([[0], [10], [20], [50]])
    code, far = plain(x, entries)
    monkeypatch.setattr(vector_codes, "nearest", lambda a, b: (looked.append((len(a), len(b))), plain(a, b))[1])
    vector_codes.reassign(x, np.array([[0], [10], [21], [50]]), np.array([False, False, True, False]), code, far)
    assert looked == [(2, 1), (1, 4)]


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)], 0) for i in range(200)]
    coded, books = vector_codes.train_codes(frame(spark, rows), parts=8, entries=10)
    got = {r.vec_id: r for r in coded.collect()}
    for i, v, _ in rows:
        whole = np.floor(256 * np.asarray(v, np.float32).astype(float))
        assert ((vector_codes.decode([got[i].codes], books)[0] - whole) ** 2).sum() == got[i].error


def test_hot_label_is_no_task_alone(spark):
    df = frame(spark, [(i, [float(i % 5)] * 4, 1) for i in range(200)]).withColumn("label", F.lit(1))
    out = vector_codes.coded_digest(df, parts=2, entries=4)
    assert out.select("label_error").distinct().count() == 1
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
