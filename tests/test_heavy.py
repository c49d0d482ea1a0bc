"""Heavy hitters equal a full count."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from vigil.operators import heavy


def truth(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]


def run(spark, values, k, counters, parts=5):
    df = spark.createDataFrame([(v, 1) for v in values], "v string, n int").repartition(parts)
    return [(r.v, r.total) for r in heavy.top_values(df, "v", k, counters).orderBy("total", ascending=False).collect()], df


def skewed(seed, n):
    rng = random.Random(seed)
    return [f"w{int(rng.paretovariate(0.9))}" if rng.random() < 0.7 else f"rare{rng.randrange(10**6)}" for _ in range(n)]


@pytest.mark.parametrize("counters", [4, 64, 1000, 10**6])
def test_equals_a_full_count(spark, counters):
    values = skewed(1, 20_000) + [None] * 50
    for k in (1, 7, 20):
        assert sorted(run(spark, values, k, counters)[0]) == sorted(truth(values, k))


def test_ties_at_the_border_and_few_values(spark):
    values = [f"t{i:03d}" for i in range(200) for _ in range(3)] + ["top"] * 10
    assert sorted(run(spark, values, 5, 8)[0]) == sorted(truth(values, 5))
    assert sorted(run(spark, ["a", "b", "b"], 10, 8)[0]) == [("a", 1), ("b", 2)]
    assert run(spark, ["a"], 0, 8)[0] == [] and run(spark, [], 3, 8)[0] == [] and run(spark, [None, None], 3, 8)[0] == []


def test_summary_is_within_its_error():
    values = skewed(2, 5000)
    s = heavy.Summary(50)
    for i in range(0, len(values), 300):
        s.add(pa.array(values[i:i + 300]))
    true = Counter(values)
    held = dict(zip(s.values.to_pylist(), s.counts.tolist()))
    assert len(held) <= 50 and s.error > 0
    assert all(true[v] - s.error <= held.get(v, 0) <= true[v] for v in true)
    assert s.error <= len(values) / 50


def test_shuffled_rows_are_bounded(spark):
    values = skewed(3, 30_000)
    _, df = run(spark, values, 5, 100)
    counts, error = heavy.summed(df.selectExpr("v as value"), 100)
    assert len(set(values)) > 8000 and counts.count() <= 5 * 100 and error > 0
