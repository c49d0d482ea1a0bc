"""Golden rows (FIXTURES.md section 3) for the quirks that are kept."""

import datetime as dt

from pyspark.sql import functions as F

from vigil.functions.dates import epoch_seconds, parse_param
from vigil.functions.text import clean_text, sentiment_label, tokens
from vigil.operators.aggregate import group_sum
from vigil.operators.lookup import attach_side_measure, prefix_lookup
from vigil.operators.ngrams import ngram_counts
from vigil.operators.series import day_counter, repair_negatives
from vigil.operators.shape import drop_keys_with_null, indicator_columns, normalise_values
from vigil.plans.posts import PostsRun

D = dt.date


def test_negative_repair(spark):
    rows = [("A", D(2021, 1, 1), 10.0, -1.0), ("A", D(2021, 1, 8), -5.0, 2.0),
            ("A", D(2021, 1, 15), -7.0, None), ("A", D(2021, 1, 20), -3.0, 4.0)]
    df = spark.createDataFrame(rows, "country string, date date, tt_cases double, tt_deaths double")
    for how in ("join", "window"):
        out = repair_negatives(df, ["country"], "date", ["tt_cases", "tt_deaths"], 7, how=how)
        got = {r.date: (r.tt_cases, r.tt_deaths) for r in out.collect()}
        assert got == {D(2021, 1, 1): (10.0, 0.0), D(2021, 1, 8): (10.0, 2.0),
                       D(2021, 1, 15): (0.0, 0.0), D(2021, 1, 20): (0.0, 4.0)}, how


def test_bad_keys_drop_whole_key(spark):
    df = spark.createDataFrame([("x", "A"), ("x", None), ("y", "B")], "id string, continent string")
    assert [r.id for r in drop_keys_with_null(df, "id", "continent").collect()] == ["y"]


def test_first_seen_counter(spark):
    rows = [(1, D(2020, 2, 3)), (2, D(2020, 2, 1)), (3, D(2020, 2, 3)), (4, None), (5, D(2020, 2, 2))]
    df = spark.createDataFrame(rows, "ord int, date date")
    got = {r.ord: r.contador_dia for r in day_counter(df, "date", ["ord"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: None, 5: 3}
    chrono = {r.ord: r.contador_dia for r in day_counter(df, "date", mode="chronological").collect()}
    assert chrono == {1: 3, 2: 1, 3: 3, 4: None, 5: 2}


def test_indicator_sum(spark):
    cases, deaths = "Cumulative number of confirmed Ebola cases", "Cumulative number of confirmed Ebola deaths"
    rows = [(cases, "G", D(2014, 1, 1), 5.0), (deaths, "G", D(2014, 1, 1), 2.0),
            ("other", "H", D(2014, 1, 1), 9.0), (cases, None, D(2014, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "indicator string, country string, date date, value double")
    d = indicator_columns(df, "indicator", "value", {"tt_cases": cases, "tt_deaths": deaths})
    got = {(r.country, r.tt_cases, r.tt_deaths) for r in group_sum(d, ["date", "country"],
                                                                   ["tt_cases", "tt_deaths"]).collect()}
    assert got == {("G", 5.0, 2.0), ("H", 0.0, 0.0)}


def test_value_map_not_summed(spark):
    rows = [("Hong Kong SAR, China", 1.0), ("Taiwan, China", 2.0), ("Macao SAR, China", 3.0), ("Peru", 4.0)]
    df = spark.createDataFrame(rows, "country string, v double")
    out = normalise_values(df, "country", {"Hong Kong SAR, China": "China", "Taiwan, China": "China",
                                           "Macao SAR, China": "China"})
    assert sorted((r.country, r.v) for r in out.collect()) == [("China", 1.0), ("China", 2.0), ("China", 3.0),
                                                               ("Peru", 4.0)]


def test_prefix_lookup(spark):
    dim = spark.createDataFrame([("South Af", "Africa"), ("South Ko", "Asia"), ("Twin Pea", "X"),
                                 ("Twin Pea", "Y"), (None, "Nowhere")], "country string, continent string")
    df = spark.createDataFrame([("South Korea",), ("Atlantis",), ("Twin Peaks",), (None,)], "country string")
    out = prefix_lookup(df, dim, "country")
    got = sorted((r.country or "", r.continent or "") for r in out.collect())
    assert got == [("", "Nowhere"), ("Atlantis", ""), ("South Korea", "Asia"), ("Twin Peaks", "X"),
                   ("Twin Peaks", "Y")]
    first = prefix_lookup(df, dim, "country", on_multi="first")
    assert first.count() == 4


def test_vaccination_join(spark):
    cases = spark.createDataFrame([("a", D(2021, 1, 1)), ("b", D(2021, 1, 1))], "id string, date date")
    side = spark.createDataFrame([("a", D(2021, 1, 1), None)], "iso_code string, date date, pfv double")
    out = attach_side_measure(cases, side, ["date", "id"], ["date", "iso_code"], ["pfv"])
    got = {r.id: (r.iso_code, r.pfv) for r in out.collect()}
    assert got == {"a": ("a", 0.0), "b": (None, None)}


def test_text_cleaning(spark):
    rows = [("RT @user_1: START now #covid https://t.co/x1 ok",), ("@bob12 hi",), ("http://a.b",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r.c for r in df.select(clean_text("t").alias("c")).collect()] == ["_1 STAnow covid  ok", "12 hi", ""]


def test_tokens(spark):
    df = spark.createDataFrame([("café naïve a bb don't",)], "t string")
    assert df.select(tokens("t").alias("k")).first().k == ["café", "naïve", "bb", "don"]


def test_ngrams_after_stopwords(spark):
    df = spark.createDataFrame([("The cat of the mat",), ("cat mat",)], "t string")
    got = {r.words: r.total for r in ngram_counts(df, "t", 2, stopwords=["the", "of"]).collect()}
    assert got == {"cat mat": 2}


def test_ngrams_long_and_short_texts(spark):
    df = spark.createDataFrame([("a1 b2 c3 d4",), ("solo",), ("",)], "t string")
    got = {r.words: r.total for r in ngram_counts(df, "t", 3, stopwords=[]).collect()}
    assert got == {"a1 b2 c3": 1, "b2 c3 d4": 1}


def test_sentiment_label(spark):
    df = spark.createDataFrame([(0.2, 0.1), (0.1, 0.2), (0.1, 0.1)], "neg double, pos double")
    assert [r.s for r in df.select(sentiment_label("neg", "pos").alias("s")).collect()] == \
        ["negative", "positive", "neutral"]


def test_date_text_layouts(spark):
    df = spark.createDataFrame([("2012-1-1 20:30:22",), ("2017-1-1",), ("junk",)], "t string")
    got = [r.e for r in df.select(epoch_seconds("t").alias("e")).collect()]
    assert got == [1325449822, 1483228800, None]
    assert parse_param("2012-1-1 20:30:22").hour == 20 and parse_param("2017-1-1").year == 2017


def test_period_stamps():
    run = PostsRun.daily(D(2021, 5, 10))
    assert (run.since, run.until) == (D(2021, 5, 9), D(2021, 5, 10))


def _rules(spark, text, lexicon):
    from vigil.operators.sentiment import score_sentiment_rules
    df = spark.createDataFrame([(1, text)], "id long, t string")
    lex = spark.createDataFrame(list(lexicon.items()), "token string, valence double")
    return score_sentiment_rules(df, "id", "t", lex).first()


def _expected(vals, n_neutral, amp=0.0):
    s = sum(vals)
    s = s + amp if s > 0 else (s - amp if s < 0 else s)
    ps = sum(v + 1 for v in vals if v > 0)
    ns = sum(v - 1 for v in vals if v < 0)
    if ps > abs(ns):
        ps += amp
    elif ps < abs(ns):
        ns -= amp
    tot = ps + abs(ns) + n_neutral
    return (round(abs(ns / tot), 3), round(n_neutral / tot, 3), round(ps / tot, 3),
            round(s / (s * s + 15) ** 0.5, 4))


def test_sentiment_rules(spark):
    lex = {"good": 2.0, "bad": -2.0}
    cases = {
        "not good": ([2.0 * -0.74], 1),                 # negation one word before
        "very good": ([2.0 + 0.293], 1),                # booster
        "very, very good": ([2.0 + 0.293 + 0.293 * 0.95], 2),
        "GOOD day": ([2.0 + 0.733], 1),                 # capitals in a mixed-case text
        "GOOD": ([2.0], 0),                             # all caps text: no emphasis
        "good but bad": ([2.0 * 0.5, -2.0 * 1.5], 1),  # 'but'
        "just plain good": ([2.0], 2),
    }
    for text, (vals, neu) in cases.items():
        r = _rules(spark, text, lex)
        assert (r.neg, r.neu, r.pos, r.compound) == _expected(vals, neu), text
    r = _rules(spark, "good!!", lex)
    assert (r.neg, r.neu, r.pos, r.compound) == _expected([2.0], 0, amp=2 * 0.292)
    r = _rules(spark, "", lex)
    assert (r.neg, r.neu, r.pos, r.compound, r.sentiment) == (0.0, 0.0, 0.0, 0.0, "neutral")


def test_sentiment_rules_keeps_columns_without_join(spark):
    from vigil.operators.sentiment import score_sentiment_rules
    df = spark.createDataFrame([(1, "good day", "a"), (2, "", "b"), (3, "x", "c"), (4, None, "d")],
                               "id long, t string, tag string")
    lex = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    out = {r.id: r for r in score_sentiment_rules(df, "id", "t", lex, keep=["t", "tag"]).collect()}
    assert {i: (r.t, r.tag) for i, r in out.items()} == {1: ("good day", "a"), 2: ("", "b"), 3: ("x", "c"),
                                                         4: (None, "d")}
    assert out[1].sentiment == "positive" and out[2].compound == 0.0 and out[3].neu == 0.0


def test_sentiment_base_keeps_columns_without_join(spark):
    from vigil.operators.sentiment import score_sentiment
    df = spark.createDataFrame([(1, "good day", "a"), (2, "", "b"), (3, "x", "c"), (4, None, "d")],
                               "id long, t string, tag string")
    lex = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    got = {r.id: r for r in score_sentiment(df, "id", "t", lex, keep=["t", "tag"]).collect()}
    plain = {r.id: r for r in score_sentiment(df, "id", "t", lex).collect()}
    assert {i: (r.t, r.tag) for i, r in got.items()} == {1: ("good day", "a"), 2: ("", "b"), 3: ("x", "c"),
                                                         4: (None, "d")}
    for i in (1, 2, 3, 4):
        assert (got[i].neg, got[i].neu, got[i].pos, got[i].compound) == \
            (plain[i].neg, plain[i].neu, plain[i].pos, plain[i].compound)
