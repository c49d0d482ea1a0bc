import random
from collections import Counter

import numpy as np
from llm_data import no_docs, odd_docs

from vigil.llm import langid

PARTS = {"aa": ["the", "ing", "tion", "wh", "st"], "bb": ["ei", "sch", "ung", "keit", "ä"], "cc": ["слово", "да", "ни", "ой"], "dd": ["ño", "ción", "rr", "az"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def model(spark, n=60):
    rng = random.Random(1)
    rows = [(text(rng, k, 40), k) for k in PARTS for _ in range(n)] + [(None, "aa"), ("the the", None)]
    return langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(3), per_lang=30)


def best_path(scores, penalty):
    """Viterbi by loops."""
    value, back = list(scores[0]), []
    for s in scores[1:]:
        came = [max(range(len(s)), key=lambda p: (value[p] - penalty * (p != x), p == x)) for x in range(len(s))]
        value = [value[p] - penalty * (p != x) + s[x] for x, p in enumerate(came)]
        back.append(came)
    path = [max(range(len(value)), key=value.__getitem__)]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1], max(value)


def test_viterbi_equals_loops():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 7, 40, 0, 3]
    offs = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(0, 3, (offs[-1], 3)).astype(np.float32)
    label = langid.viterbi(scores, offs, 4.0)
    for a, b in zip(offs[:-1], offs[1:]):
        if a < b:
            path, value = best_path(scores[a:b].tolist(), 4.0)
            got = label[a:b]
            paid = sum(float(s[x]) for s, x in zip(scores[a:b], got)) - 4.0 * int((got[1:] != got[:-1]).sum())
            assert abs(paid - value) < 1e-3


def test_viterbi_with_hundreds_of_languages():
    rng = np.random.default_rng(3)
    for n in (127, 128, 129, 200, 256, 257, 300):
        scores = rng.normal(0, 1, (40, n)).astype(np.float32)
        scores[:20, n - 1] += 9
        scores[20:, n // 2] += 9
        label = langid.viterbi(scores, np.array([0, 40]), 4.0)
        assert label[:20].tolist() == [n - 1] * 20 and label[20:].tolist() == [n // 2] * 20
        assert label.tolist() == best_path(scores.tolist(), 4.0)[0]


def test_word_scores_equal_plain_counts(spark):
    """Log-probabilities of a word's 1-, 2- and 3-grams, from counts in a dictionary (no two grams of these texts share a bucket)."""
    texts = {"aa": ["abba cab", "Bab ab"], "bb": ["dada abd", "add"]}
    m = langid.train(spark.createDataFrame([(t, k) for k, ts in texts.items() for t in ts], "text string, lang string"), per_lang=10**6, smoothing=0.5)

    def grams(word):
        w = [0, *map(ord, word.lower()), 0]
        return [[(w[i],) for i in range(1, len(w))], [(w[i - 1], w[i]) for i in range(1, len(w))],
                [(w[i - 2] if i > 1 else 0, w[i - 1], w[i]) for i in range(1, len(w))]]

    counts = {k: [Counter(), Counter(), Counter()] for k in texts}
    for k, ts in texts.items():
        for word in " ".join(ts).split():
            for n, g in enumerate(grams(word)):
                counts[k][n].update(g)
    words = ["abba", "Dad", "xyz", "b"]
    got = m.scores(langid.words_of([" ".join(words)]))
    assert m.langs == ["aa", "bb"]
    for word, row in zip(words, got):
        for k, x in zip(m.langs, row):
            total = [sum(c.values()) + 0.5 * langid.BUCKETS for c in counts[k]]
            want = sum(np.log((counts[k][n][g] + 0.5) / total[n]) / 3 for n, gs in enumerate(grams(word)) for g in gs)
            assert abs(x - want) < 1e-3, (word, k)


def test_words_and_scripts():
    w = langid.words_of(["Ab c1d", None, "", "漢字 да! ñ"])
    assert list(zip(w.doc, w.start, w.end)) == [(0, 0, 2), (0, 3, 4), (0, 5, 6), (3, 0, 2), (3, 3, 5), (3, 7, 8)]
    names = list(dict.fromkeys(n for n, _, _ in langid.SCRIPTS))
    assert [names[s - 1] for s in w.script] == ["latin"] * 3 + ["han", "cyrillic", "latin"]
    assert w.letters.tolist() == [2, 1, 1, 2, 2, 1]


def test_spans_of_mixed_text(spark):
    rng, m = random.Random(3), model(spark)
    a, b, c = text(rng, "aa", 30), text(rng, "bb", 25), text(rng, "cc", 5)
    docs = spark.createDataFrame([(1, f"{a} {b} {c}"), (2, c), (3, "12 !?"), (4, "漢字")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(docs, m).collect()}
    spans = [(s.lang, s.start, s.end) for s in got[1].spans]
    assert [s[0] for s in spans] == ["aa", "bb", "cc"]
    assert abs(spans[0][2] - len(a)) < 12 and abs(spans[1][2] - len(a) - 1 - len(b)) < 12 and spans[2][2] == len(f"{a} {b} {c}")
    assert (got[1].lang_pred, got[2].lang_pred, got[2].score) == ("aa", "cc", 1.0)
    assert (got[3].lang_pred, got[3].score, got[3].spans) == ("und", 0.0, []) and got[4].lang_pred == "und"


def test_held_out_accuracy(spark):
    rng, m = random.Random(4), model(spark)
    rows = [(i, text(rng, k, 12), k) for i, k in enumerate(list(PARTS) * 40)]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, truth string"), m, spans=False).collect()
    assert np.mean([r.lang_pred == r.truth for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    docs, m = odd_docs(spark), model(spark)
    got = langid.predict(docs, m)
    assert got.columns == [c for c in docs.columns if c not in ("text", "spans")] + ["lang_pred", "score", "n_spans", "spans"]
    rows = got.collect()
    assert len(rows) == docs.count() and sum(r.lang_pred == "und" for r in rows) == 4
    assert langid.predict(no_docs(spark), m).collect() == []
    blank = langid.train(no_docs(spark))
    assert {(r.lang_pred, r.score, r.n_spans) for r in langid.predict(docs, blank).collect()} == {("und", 0.0, 0)}


def test_scripts_of_no_training_language(spark):
    """With any_script only texts without letters are und, and words beside a known script still don't vote."""
    rng, m = random.Random(9), model(spark)
    a = text(rng, "aa", 20)
    texts = ["සිංහල භාෂාව", "ｆｕｌｌ ｗｉｄｔｈ", "漢字", "\u0301 漢字", a, f"{a} සිංහල 漢字", "12 !?", "\u0301", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(docs, m, any_script=True).collect()}
    old = {r.doc_id: r for r in langid.predict(docs, m).collect()}
    for i in range(4):
        assert got[i].lang_pred in PARTS and 0 < got[i].score <= 1 and got[i].n_spans > 0
        assert old[i].lang_pred == "und"
    assert all(got[i] == old[i] for i in range(4, 10)) and got[4].lang_pred == got[5].lang_pred == "aa"
    assert [got[i].lang_pred for i in range(6, 10)] == ["und"] * 4
