import random

from llm_data import BASE, no_docs, odd_docs, shingles

from vigil.llm import containment


def by_hand(docs, items, k=5, threshold=0.8):
    out = []
    for d, t in docs:
        s = shingles(t, k)
        for i, u in items:
            q = shingles(u, k)
            if q and len(q & s) >= threshold * len(q) - 1e-9:
                out.append((d, i, len(q), len(q & s), len(q & s) / len(q)))
    return sorted(out, key=str)


def tables(spark):
    rng = random.Random(3)

    def text(n):
        return [rng.choice(BASE) + str(rng.randrange(200)) for _ in range(n)]

    items = [(i, text(rng.randrange(1, 50))) for i in range(30)] + [(30, []), (31, None)]
    docs = []
    for d in range(120):
        w = text(rng.choice([0, 3, 40, 400, 5000]))
        _, item = rng.choice(items[:30])
        part = [x if rng.random() > 0.04 else "changed" for x in item]
        docs.append((d, w[:len(w) // 2] + part + w[len(w) // 2:] if rng.random() < 0.6 else w))
    return ([(d, " ".join(w)) for d, w in docs], [(i, None if w is None else " ".join(w)) for i, w in items])


def test_equal_to_all_pairs(spark, monkeypatch):
    docs, items = tables(spark)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(docs, items)
    assert len(want) > 20
    assert sorted(map(tuple, containment.contained_items(d, i).collect()), key=str) == want
    monkeypatch.setattr(containment, "BLOCK_BYTES", 1000)  # many blocks of items, the same result
    assert sorted(map(tuple, containment.contained_items(d, i).collect()), key=str) == want
    dirty = {r[0] for r in want}
    assert sorted(r.doc_id for r in containment.drop_contaminated(d, i).collect()) == [x for x, _ in docs if x not in dirty]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "three four five SIX seven"), (None, "word"), (2, None), (3, ""), (1, "three four five SIX seven")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in containment.contained_items(docs, items).collect()), key=str)
    assert got == sorted([(1, 1)] * 4 + [(None, 1)] * 2 + [(5, None)], key=str)
    clean = containment.drop_contaminated(docs, items)
    assert clean.schema == docs.schema and clean.count() == docs.count() - 4
    none = spark.createDataFrame([], "item_id long, text string")
    assert containment.contained_items(docs, none).collect() == [] and containment.drop_contaminated(docs, none).count() == docs.count()
    assert containment.contained_items(no_docs(spark), items).collect() == []


def test_more_permutations_for_small_items():
    assert containment.permutations_for(20, 0.8, 1e-6) == 1
    assert containment.permutations_for(1, 0.8, 1e-6) > 4
    assert [containment.size_class(n) for n in (1, 2, 3, 4, 5, 1024, 1025)] == [0, 1, 2, 2, 3, 10, 11]
