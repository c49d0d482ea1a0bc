"""Golden cases of the scorers' rules on neighbouring words."""

import random

import pytest

from vigil.operators.sentiment import IDIOMS, score_polarity, score_sentiment, score_sentiment_rules

N, B = -0.74, 0.293
LEX = {"good": 2.0, "bad": -2.0, "death": -3.0, "bomb": -1.5, "kind": 2.5, "right": 1.0}


def lexicon(spark, lex=LEX):
    return spark.createDataFrame(list(lex.items()), "token string, valence double")


def sums(r):
    """The summed valence behind a compound score."""
    c = abs(r.compound)
    s = (15 * c * c / (1 - c * c)) ** 0.5
    return s if r.compound >= 0 else -s


CASES = {
    # 'never so', 'never this'
    "never so good": (2 + B) * 1.5, "it never so good": (2 + B) * 1.5 * 1.25, "it never this good": 2 * 1.5 * 1.25, "never so very good": (2 + B + B * 0.95) * 1.25,
    "never this day good": 2 * 1.25, "Never so good": (2 + B) * N, "it is so good": (2 + B) * 1.25, "what of this good": 2 * 1.25, "this good": 2.0, "is this good": 2.0,
    # 'least'
    "the least good": 2 * N, "least good": 2 * N, "at least good": 2.0, "very least good": 2 + B * 0.95, "one of the least good": 2 * N,
    # idioms: from the third predecessor on
    "that is the bomb": 3.0, "the bomb": -1.5, "they said oh yeah right": -2.0, "a slow kiss of death": -1.5, "kiss of death good": -3.0 - 1.5, "what about that the bomb again": 3.0,
    # dampening phrases
    "it was kind of good": 2 - B, "that is sort of good": 2 - B, "had just enough food good": 2 - B, "kind of good": 2.0,
    # 'kind' before 'of' scores nothing, else it does
    "one kind of them": 0.0, "one kind man there": 2.5,
    # order of the rules: booster, then negation, distance by distance
    "not very good": (2 + B) * N, "not at all good": 2 * N, "very not good": 2 * N - B * 0.95, "don't think good": 2 * N,
    "bad good": 0.0, "good very bad": 2 - 2 - B,
}


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id long, t string")
    return {r.t: r for r in score_sentiment_rules(df, "id", "t", lexicon(spark), keep=["t"]).collect()}


@pytest.mark.parametrize("text", CASES)
def test_rule(scored, text):
    assert sums(scored[text]) == pytest.approx(CASES[text], abs=2e-3)


def test_own_idioms(spark):
    df = spark.createDataFrame([(1, "we had a blue moon good"), (2, "that is the bomb")], "id long, t string")
    got = {r.id: sums(r) for r in score_sentiment_rules(df, "id", "t", lexicon(spark), idioms={"blue moon good": 1.25}).collect()}
    assert got[1] == pytest.approx(1.25, abs=1e-3) and got[2] == pytest.approx(-1.5, abs=1e-3)
    got = [sums(r) for r in score_sentiment_rules(df.filter("id = 2"), "id", "t", lexicon(spark), idioms={}).collect()]
    assert got == pytest.approx([-1.5], abs=1e-3) and len(IDIOMS) == 7


def by_hand(tokens, lex):
    """The averaging scorer, token by token."""
    out, m, n = [], False, False
    for t in tokens:
        if t in lex:
            p, s, i, mod = lex[t]
            if not m:
                out.append([p, s, i, 1])
            else:
                clip = lambda x: max(-1.0, min(1.0, x))
                out[-1][:3] = [clip(p * out[-1][2]), clip(s * out[-1][2]), i]
            if n:
                out[-1][2] = 1 / out[-1][2]
                out[-1][3] = -1
            m, n = mod, t in ("no", "not", "n't", "never")
        else:
            if t in ("no", "not", "n't", "never"):
                n = True
            elif n and len(t.strip("'")) > 1:
                n = False
            if n and m:
                out[-1][3], n = -1, False
            elif m and len(t) > 2:
                m = False
            if t == "!" and out:
                out[-1][0] = max(-1.0, min(1.0, out[-1][0] * 1.25))
    k = max(1, len(out))
    return sum(p * (-0.5 if g < 0 else 1) for p, _, _, g in out) / k, sum(s for _, s, _, _ in out) / k


POL = {"good": (0.7, 0.6, 1.0, False), "bad": (-0.7, 0.66, 1.0, False), "really": (0.2, 0.2, 1.3, True), "slightly": (-0.16, 0.16, 0.5, True), "no": (-0.25, 0.5, 1.0, False), "big": (0.9, 0.9, 1.0, False)}


def polar(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    lex = spark.createDataFrame([(k, *v) for k, v in POL.items()], "token string, polarity double, subjectivity double, i double, m boolean")
    kw = kw or {"intensity_col": "i", "modifier_col": "m"}
    return {r.id: (r.polarity, r.subjectivity) for r in score_polarity(df, "id", "t", lex, **kw).collect()}


def test_polarity_golden(spark):
    got = polar(spark, ["really good", "not good", "not a good one", "not some good", "really not good", "slightly bad", "really really big", "good!", "good! !! !!", "isn't good", "GOOD, bad.", "", "nothing", "no good"])
    want = [0.91, -0.35, -0.35, 0.7, -0.455, -0.35, 1.0, 0.875, 1.0, -0.35, 0.0, 0.0, 0.0, (-0.25 - 0.35) / 2]
    assert [got[i][0] for i in range(len(want))] == pytest.approx(want, abs=1e-4)
    plain = polar(spark, ["really good", "not good"], intensity_col=None)
    assert plain[0][0] == pytest.approx(0.45) and plain[1][0] == pytest.approx(-0.35)


def test_polarity_equals_token_by_token(spark):
    rng = random.Random(3)
    words = [*POL, "not", "never", "n't", "!", "a", "of", "my", "thing", "other", "'s"]
    texts = [[rng.choice(words) for _ in range(rng.randrange(14))] for _ in range(400)]
    texts = [[t for t in ts if t != "'s"] for ts in texts]
    got = polar(spark, [" ".join(ts) for ts in texts])
    for i, ts in enumerate(texts):
        assert got[i] == pytest.approx(tuple(round(x, 4) for x in by_hand(ts, POL)), abs=1.01e-4), ts


def test_large_lexicon_is_reduced_to_the_texts(spark):
    lex = lexicon(spark, {**LEX, **{f"w{i}": 1.0 for i in range(500)}})
    df = spark.createDataFrame([(1, "Good day"), (2, "w7"), (3, None)], "id long, t string")
    want = {r.id: r.compound for r in score_sentiment(df, "id", "t", lex).collect()}
    assert {r.id: r.compound for r in score_sentiment(df, "id", "t", lex, max_lexicon_bytes=200).collect()} == want and want[1] > 0 and want[2] > 0
    with pytest.raises(ValueError, match="bytes of lexicon"):
        score_sentiment(df, "id", "t", lex, max_lexicon_bytes=20)


def test_rows_in_no_fixed_order_are_scored_once(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2]), rng.choice(["good", "bad day", None, "not good", ""]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, t string, n long").repartition(7)
    for score in (score_sentiment, score_sentiment_rules):
        got = score(df, "id", "t", lexicon(spark), keep=["n", "t"]).collect()
        assert sorted((r.n, r.t or "") for r in got) == sorted((n, t or "") for _, t, n in rows)
