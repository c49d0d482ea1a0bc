import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_data import families, no_docs, odd_docs, shingles

from vigil.llm import chosen_path


def by_hand(rows, k, num, den):
    """Components over (row number, text): the least non-null id of each."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
            root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = doc if not sets[i] else min(ids) if ids else None
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("k,num,leaf,block", [(3, 85, 32, 256), (5, 80, 3, 4)])
def test_components_equal_all_pairs(spark, monkeypatch, k, num, leaf, block):
    """leaf=3 sends the families through the large-node path, in blocks of some 4 classes."""
    monkeypatch.setattr(chosen_path, "BLOCK_ROWS", block)
    texts = families(1, 12, 25, 90, 0.012)
    rows = [(i, t) for i, t in enumerate(texts)]
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k, num=num, leaf=leaf)
    want = by_hand(rows, k, num, 100)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert 12 <= len({c for _, _, c, _ in want}) < len(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = chosen_path.near_duplicates(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, 5, 80, 100)
    assert chosen_path.near_duplicates(no_docs(spark)).collect() == []


def test_keep_one(spark):
    docs = odd_docs(spark)
    kept = chosen_path.keep_one(docs)
    assert kept.schema == docs.schema
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text is None, (r.text or "")[:9]) for r in kept.collect())
    # rows without words all stay; of the three equal texts the one with id 1, once; 6 and 7 are equal
    assert [(None if n else i) for n, i, _, _ in ids] == [1, 2, 3, 4, 5, 6, 8, 8, None]
    assert chosen_path.keep_one(no_docs(spark)).collect() == []


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**64, 2300, dtype=np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[300:])  # 1700 of 2300
    s = chosen_path.sketches([a, b])
    assert abs((s[0] == s[1]).mean() - 17 / 23) < 0.15
    assert chosen_path.set_key(a) != chosen_path.set_key(b) and chosen_path.set_key(a[:0]) is None


def test_a_linked_pair_with_few_equal_sketch_values(spark):
    """A pair at the threshold whose sketches agree in 4.6 deviations fewer places than expected."""
    r = random.Random(836820476)
    w = [f"w{r.randrange(10**6)}" for _ in range(42)]
    rows = [(1, " ".join(w[:36])), (2, " ".join(w))]
    a, b = (shingles(t, 3) for _, t in rows)
    assert len(a & b) / len(a | b) == 0.85
    sketch = chosen_path._small(chosen_path.sketches(chosen_path.text_sets(pa.array([t for _, t in rows]), 3)))
    assert (sketch[0] == sketch[1]).sum() < 92
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, num=85, den=100)
    assert sorted((x.doc_id, x.component_id) for x in got.collect()) == [(1, 1), (2, 1)]


def test_one_row_of_an_id_with_different_texts_stays(spark):
    """The same row in every run."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = [" ".join([*base[:58], f"end{i}", "x"]) for i in (3, 1, 2)]
    rows = [(7, t, n) for n, t in enumerate(texts)] + [(9, texts[0], 5), (7, texts[1], 4)]
    got = set()
    for parts in (1, 2, 3, 5):
        one, = chosen_path.keep_one(spark.createDataFrame(rows[::-1] if parts % 2 else rows, "doc_id long, text string, n long").repartition(parts)).collect()
        got.add(tuple(one))
    assert len(got) == 1 and got <= set(rows) and all(r[0] == 7 for r in got)
