import random
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_data import BASE, no_docs, odd_docs, words
from pyspark.sql import functions as F

from vigil.llm import pseudo_lm as lm


def net_of(seed):
    rng = np.random.default_rng(seed)
    return {k: (rng.standard_normal(s) * 0.3).astype(np.float32) for k, s in lm.SHAPES.items()}


def plain_log_prob(net, ids, i):
    """One token, with loops."""
    x = np.concatenate([net["embed"][ids[i + d] if 0 <= i + d < len(ids) else lm.BORDER] for d in lm.PLACES]).astype(np.float64)
    h = np.tanh(x @ net["w"] + net["b"])
    c, m = divmod(int(ids[i]), lm.MEMBERS)
    a, b = h @ net["wc"] + net["bc"], h @ net["wm"][c] + net["bm"][c]
    return a[c] - np.log(np.exp(a).sum()) + b[m] - np.log(np.exp(b).sum())


def test_document_scores_equal_loops():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(BASE) for _ in range(n)) for n in (0, 1, 2, 3, 40)] + [None]
    frequent = np.unique(lm.words_of(pa.array([" ".join(BASE[:9])]))[0])
    lexicon, net = lm.Lexicon(frequent), net_of(2)
    n, total = lm.document_scores(lexicon, net, pa.array(texts))
    for t, k, got in zip(texts, n, total):
        ids = lexicon.ids(lm.words_of(pa.array([t], pa.string()))[0])
        assert k == len(words(t)) == len(ids)
        assert abs(got - sum(plain_log_prob(net, ids, i) for i in range(len(ids)))) < 1e-3
    assert len({int(i) for i in lexicon.ids(frequent)}) == 9 and max(lexicon.ids(frequent)) < lm.FREQUENT


def test_probabilities_sum_to_one():
    net, all_ids = net_of(3), np.arange(lm.BORDER)
    around = np.tile([[1, 700, lm.BORDER, 5]], (lm.BORDER, 1))
    assert abs(np.exp(lm.log_probs(net, all_ids, around).astype(np.float64)).sum() - 1) < 1e-4


def test_gradients():
    net = {k: v.astype(np.float64) for k, v in net_of(4).items()}
    rng = np.random.default_rng(5)
    ids, around = rng.integers(0, lm.BORDER, 30), rng.integers(0, lm.BORDER + 1, (30, 4))
    g = lm.gradients(net, ids, around)
    for k in lm.SHAPES:
        at = tuple(np.argwhere(np.abs(g[k]) == np.abs(g[k]).max())[0])
        up, down = ({j: v.copy() for j, v in net.items()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        slope = -(lm.log_probs(up, ids, around).mean() - lm.log_probs(down, ids, around).mean()) / 2e-4
        assert abs(slope - g[k][at]) < 1e-3 * max(1, abs(slope)), k


def test_training_learns_the_order_of_words(spark):
    rng = random.Random(6)

    def text(ordered):
        at = rng.randrange(len(BASE))
        return " ".join(BASE[(at + i) % len(BASE)] if ordered else rng.choice(BASE) for i in range(150))

    docs = spark.createDataFrame([(i, text(True)) for i in range(200)], "doc_id long, text string").repartition(3)
    lexicon, net = lm.train(docs, passes=4)
    n, total = lm.document_scores(lexicon, net, pa.array([text(True), text(False)]))
    assert n.tolist() == [150, 150]
    assert total[0] / 150 > -1.0 > -2.5 > total[1] / 150
    assert lm.BORDER == 4096 and len(lexicon.sorted) == len(BASE)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = lm.train(docs)
    got = lm.score(docs, *model)
    assert got.columns == [c for c in docs.columns if c != "text"] + ["n_tokens", "log_prob", "mean_log_prob", "perplexity"]
    rows = got.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(words(r.text)) for r in docs.collect())
    for r in rows:
        assert (r.mean_log_prob is None) == (r.perplexity is None) == (r.n_tokens == 0) and (r.log_prob < 0 or r.n_tokens == 0)
    empty = lm.train(no_docs(spark))
    assert lm.score(no_docs(spark), *empty).collect() == [] and lm.score(docs, *empty).count() == docs.count()


def test_words_of_a_bucket_have_their_share(spark, monkeypatch):
    """Some 3,000 words beyond the frequent ones in 512 buckets: rare words score below frequent ones of their bucket, and a bucket's words and
    one unseen word share its probability."""
    rng = random.Random(7)
    pool = [f"w{i}" for i in range(9000)]
    texts = [" ".join(pool[min(int(rng.expovariate(0.0003)), 8999)] for _ in range(rng.randrange(1, 90))) for _ in range(600)] + [None, ""]
    seen = Counter(w for t in texts for w in words(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(lm, "BLOCK_WORDS", 2000)
    lexicon, net = lm.train(docs)
    odd = spark.createDataFrame([(1000, "never seen " + texts[0]), (1000, texts[1])], docs.schema)
    buckets, bucket_of = Counter(), {}
    for w in [*seen, "never", "seen"]:
        i = int(lexicon.ids(lm.words_of(pa.array([w]))[0])[0])
        if i >= lm.FREQUENT:
            buckets[i] += seen[w]
            bucket_of[w] = i
    assert len(seen) - lm.FREQUENT == len(bucket_of) - 2 > 500
    shares = Counter()
    for w, i in bucket_of.items():
        shares[i] += seen[w] / (buckets[i] + 1)
    assert all(abs(s + 1 / (buckets[i] + 1) - 1) < 1e-9 for i, s in shares.items())
    for table in (docs, odd):
        want = []
        for r in table.collect():
            n, total = lm.document_scores(lexicon, net, pa.array([r.text], pa.string()))
            own = sum(np.log(max(seen[w], 1) / (buckets[bucket_of[w]] + 1)) for w in words(r.text) if w in bucket_of)
            want.append((r.doc_id, int(n[0]), total[0] + own))
        got = sorted(tuple(r)[:3] for r in lm.score(table, lexicon, net).collect())
        for a, b in zip(got, sorted(want), strict=True):
            assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-3


def test_every_place_is_trained_on(spark, monkeypatch):
    texts = ["a b c d e", "a b c d e", None, "", "f"] + ["g h " * 40] * 3
    lexicon = lm.Lexicon(np.unique(lm.words_of(pa.array(["a b c"]))[0]))
    got = lm.windows_of(lexicon, pa.array(texts), 1.0)
    ids = [lexicon.ids(lm.words_of(pa.array([t], pa.string()))[0]).tolist() for t in texts]
    want = [(t[i], *(t[i + d] if 0 <= i + d < len(t) else lm.BORDER for d in lm.PLACES)) for t in ids for i in range(len(t))]
    assert Counter(map(tuple, got.tolist())) == Counter(want)
    seen = []
    monkeypatch.setattr(lm, "windows_of", lambda lexicon, column, chance, made=lm.windows_of: seen.append(None) or made(lexicon, column, chance))
    docs = spark.createDataFrame([(t,) for t in texts + [f"text {i} of many words" for i in range(300)]], "text string")
    share = F.pmod(F.xxhash64("text"), F.lit(lm.SHARES))
    sizes = [docs.filter(share == i).count() for i in range(lm.SHARES)]
    assert sum(sizes) == docs.count() and min(sizes) > 40  # each text is in one share; a null text has no place
    rounds = []
    monkeypatch.setattr(lm, "_round_batches", lambda model, chance, rate, made=lm._round_batches: rounds.append(chance) or made(model, chance, rate))
    lm.train(docs)
    assert rounds == [1.0] * lm.SHARES
    assert not seen  # windows are made in the tasks


def test_real_text_scores_above_its_shuffled_words(spark):
    """Trained on four fifths of the documents: held-out texts score above their shuffled words, copies of training texts above
    them, and junk below; the network's ids are predicted better than by their own frequencies."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    lexicon, net = lm.train(docs.filter("doc_id % 5 <> 0"))
    rng = random.Random(8)
    held = [r.text for r in docs.filter("doc_id % 5 = 0 and length(text) > 300").collect()]
    shuffled = [" ".join(rng.sample(words(t), len(words(t)))) for t in held]
    n, total = lm.document_scores(lexicon, net, pa.array(held))
    assert total.sum() / n.sum() > lm.document_scores(lexicon, net, pa.array(shuffled))[1].sum() / n.sum() + 0.1
    ids = np.concatenate([lexicon.ids(lm.words_of(pa.array([t]))[0]) for t in held])
    trained = [r.text for r in docs.filter("doc_id % 5 <> 0").collect()]
    counts = np.bincount(np.concatenate([lexicon.ids(lm.words_of(pa.array([t], pa.string()))[0]) for t in trained]), minlength=lm.BORDER) + 1.0
    assert total.sum() / n.sum() > np.log(counts / counts.sum())[ids].mean() + 0.2
    junk = [" ".join("".join(rng.choice("bcdfghjk") for _ in range(7)) for _ in range(60)) for _ in range(20)]
    got = {r.doc_id: r.mean_log_prob for r in lm.score(spark.createDataFrame([(0, " ".join(held))] + [(i + 1, t) for i, t in enumerate(junk)], "doc_id long, text string"), lexicon, net).collect()}
    assert max(got[i + 1] for i in range(20)) < got[0] - 1
