"""The n-grams of each value: only repeated ones are sorted, single ones where these are too few."""

from collections import Counter

import pytest

from vigil.operators import ngrams

ROWS = [("mon", "red fox jumps red fox jumps red fox"), ("mon", "lazy dog sleeps lazy dog"), ("tue", "alpha beta gamma delta"), ("tue", "beta gamma"),
        (None, "zeta eta zeta eta theta"), (None, None), ("wed", ""), ("thu", "solo word"), ("thu", "x y z")]


def plain(by, n, k):
    groups: dict = {}
    for day, text in ROWS:
        toks = [t for t in (text or "").split() if len(t) > 1]
        groups.setdefault(day if by else "all", Counter()).update(" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1))
    return sorted(((g if by else None, w, c) for g, counts in groups.items() for w, c in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]), key=str)


@pytest.mark.parametrize("by", ["day", None])
@pytest.mark.parametrize("k", [1, 2, 5])
def test_top_of_each_value(spark, monkeypatch, by, k):
    plans = []
    monkeypatch.setattr(ngrams, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df.localCheckpoint())
    df = spark.createDataFrame(ROWS, "day string, text string")
    for n, top in zip((2, 3), ngrams.top_ngrams_of(df, by, "text", (2, 3), k, stopwords=())):
        assert sorted(((r["day"] if by else None, r["words"], r["total"]) for r in top.collect()), key=str) == plain(by, n, k)
    assert ">= 2" in plans[0]  # before: all n-grams were sorted for their ranks
