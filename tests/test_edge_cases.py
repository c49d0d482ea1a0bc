"""Rows that the fixtures don't have: repeated and null keys, NaN, odd files, repeated loads."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators.aggregate import joined_values, top_k, top_k_series, unique_values
from vigil.operators.forecast import forecast_changepoint, forecast_linear_weekly
from vigil.operators.joins import broadcast_if_bounded, row_bytes
from vigil.operators.sentiment import score_polarity, score_sentiment, score_sentiment_rules
from vigil.operators.series import repair_negatives
from vigil.plans.fact import EBOLA_INDICATORS, build_fact
from vigil.plans.posts import posts_mart
from vigil.sinks.tables import export, read_exported_csv, write_daily
from vigil.sources.files import read_cases, read_long_outbreak, read_vaccinations, read_wide_outbreak

D = dt.date
NAN = float("nan")


def test_repair_repeated_keys_and_nan(spark):
    rows = [("A", D(2021, 1, 1), 10.0), ("A", D(2021, 1, 1), 4.0), ("A", D(2021, 1, 8), -5.0), ("A", D(2021, 1, 8), 3.0),
            ("A", D(2021, 1, 15), -1.0), ("B", D(2021, 1, 1), NAN), ("B", D(2021, 1, 8), -2.0), (None, D(2021, 1, 1), 6.0),
            (None, D(2021, 1, 8), -2.0), ("C", None, -3.0), ("C", D(2021, 1, 2), None)]
    df = spark.createDataFrame(rows, "country string, date date, v double")
    want = sorted([("A", D(2021, 1, 1), 10.0), ("A", D(2021, 1, 1), 4.0), ("A", D(2021, 1, 8), 10.0), ("A", D(2021, 1, 8), 3.0),
                   ("A", D(2021, 1, 15), 3.0), ("B", D(2021, 1, 1), 0.0), ("B", D(2021, 1, 8), 0.0), (None, D(2021, 1, 1), 6.0),
                   (None, D(2021, 1, 8), 6.0), ("C", None, 0.0), ("C", D(2021, 1, 2), 0.0)], key=str)
    for how in ("join", "window"):
        got = repair_negatives(df, ["country"], "date", ["v"], 7, how=how)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect()), key=str) == want, how


def test_topk_ignores_null_keys(spark):
    df = spark.createDataFrame([(None, 100.0), ("a", 5.0), ("b", 7.0), ("c", 1.0), (None, 3.0)], "country string, v double")
    assert [(r.country, r.contador) for r in top_k(df, "country", "v", 2).collect()] == [("b", 1), ("a", 2)]
    assert {r.country for r in top_k_series(df, "country", "v", 2).collect()} == {"a", "b"}
    assert [r.country for r in unique_values(df, "country").collect()] == ["a", "b", "c"]
    assert joined_values(df, "country").first()[0] == "a,b,c"


def test_broadcast_by_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "t string, n int")
    assert df.agg(F.sum(row_bytes(df))).first()[0] == 1000 + 4 * 16
    assert "broadcast" in broadcast_if_bounded(df, 2000)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_if_bounded(df, 900) is df


LEX = [("good", 2.0), ("good", 1.0), ("bad", -2.0), ("so", 1.5), (None, 3.0)]


def test_every_post_is_scored_once(spark):
    lex = spark.createDataFrame(LEX, "token string, valence double")
    posts = spark.createDataFrame([(1, "good day"), (1, "bad day"), (None, "good"), (None, None), (2, "")], "id long, text string")
    for score in (score_sentiment, score_sentiment_rules):
        got = score(posts, "id", "text", lex, keep=["text"]).collect()
        assert sorted(((r.id, r.text, r.sentiment) for r in got), key=str) == sorted(
            [(1, "good day", "positive"), (1, "bad day", "negative"), (None, "good", "positive"), (None, None, "neutral"), (2, "", "neutral")], key=str)
        # one valence a token (the larger), the neutral word counts once: 3 / (3 + 1)
        assert {r.pos for r in got if r.text == "good day"} == {0.75}
    mart = posts_mart(posts.select(F.col("id").alias("post_id"), F.lit(D(2024, 1, 1)).alias("date"), F.col("text").alias("tweet"), "text"), lex)
    assert mart.count() == 5
    pol = spark.createDataFrame([("good", 0.5, 0.5), ("good", 0.25, 0.75)], "token string, polarity double, subjectivity double")
    assert sorted(((r.id, r.polarity) for r in score_polarity(posts, "id", "text", pol).collect()), key=str) == sorted(
        [(1, 0.5), (1, 0.0), (None, 0.5), (None, 0.0), (2, 0.0)], key=str)


def test_scorer_words(spark):
    lex = spark.createDataFrame(LEX, "token string, valence double")
    posts = spark.createDataFrame([(1, "so good"), (2, "so"), (3, "good!!"), (4, "good!!!!"), (5, "(good)"), (6, '"good'), (7, "I good.")], "id long, text string")
    got = {r.id: (r.neg, r.neu, r.pos) for r in score_sentiment(posts, "id", "text", lex).collect()}
    assert got[1] == (0.0, 0.25, 0.75) and got[2] == (0.0, 1.0, 0.0)  # a booster scores 0 itself
    assert got[3][2] == got[6][2] == 1.0 and got[4][2] == got[5][2] == 0.0  # one listed mark at one end
    assert got[7] == (0.0, 0.0, 1.0)  # one-letter words don't count


def test_daily_load_into_a_catalog_table(spark):
    table = f"daily_{os.getpid()}"
    day = lambda d, v: spark.createDataFrame([(v, D(2024, 1, d), "w")], "total long, date date, words string")
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        write_daily(day(1, 1), table=table)
        write_daily(day(2, 2).select("date", "words", "total"), table=table)  # by name, whatever the order
        write_daily(day(2, 3), table=table)
        assert sorted((r.date.day, r.total) for r in spark.table(table).collect()) == [(1, 1), (2, 3)]
        with pytest.raises(ValueError):
            write_daily(day(3, 1).withColumnRenamed("words", "other"), table=table)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_daily_load_writes_few_files(spark, tmp_dir):
    df = spark.range(0, 4000, 1, 8).select(F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("date"), "id")
    write_daily(df, f"{tmp_dir}/t")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/t") for f in names if f.endswith(".parquet")]
    assert len(files) == 5 and spark.read.parquet(f"{tmp_dir}/t").count() == 4000


def test_text_survives_csv(spark, tmp_dir):
    rows = [(1, 'a "b", c\nd'), (2, None), (3, " padded "), (4, "back\\slash\\"), (5, "\r\nx,y")]
    df = spark.createDataFrame(rows, "id long, text string")
    export(df, f"{tmp_dir}/c", "csv", ["id", "text"])
    assert sorted(map(tuple, read_exported_csv(spark, f"{tmp_dir}/c", "id long, text string").collect())) == rows


def _csv(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding=encoding) as f:
        f.write(text)
    return folder


def test_missing_markers_and_escapes(spark, tmp_dir):
    p = _csv(f"{tmp_dir}/a", "a.csv", "iso,continent,location,date,new_cases,new_deaths\nA,NA,null,2021-01-01,NaN,N/A\nB,Asia,nan x,2021-01-02,1,-1\n")
    a, b = read_cases(spark, p).orderBy("id").collect()
    assert tuple(a)[2:] == (None, None, None, None) and tuple(b) == ("B", D(2021, 1, 2), "nan x", "Asia", 1.0, -1.0)
    p = _csv(f"{tmp_dir}/e", "e.csv", "C,x,y,d\nC\\xf4te d\\u2019or,3,0,2009-07-06\nplain,1,1,2009-07-07\n", "latin-1")
    names = ["country", "tt_cases", "tt_deaths", "date"]
    got = read_wide_outbreak(spark, p, names, encoding="unicode_escape", ordinal=True).orderBy("source_ordinal").collect()
    assert [r.country for r in got] == ["Côte d’or", "plain"]


def test_fact_from_files_with_the_default_rules(spark, tmp_dir):
    """Counters follow the files' order, over several files; default labels and name maps."""
    cases = _csv(f"{tmp_dir}/c", "c.csv", "iso,continent,location,date,new_cases,new_deaths\nPER,America,Peru,2021-01-01,5,1\nPER,America,Peru,2021-01-08,-1,0\n"
                 "VNM,Asia,Vietnam,2021-01-01,2,0\nOWID,,World,2021-01-01,9,9\n")
    vacc = _csv(f"{tmp_dir}/v", "v.csv", "location,iso_code,date,people_fully_vaccinated\nPeru,PER,2021-01-08,\nPeru,PER,2021-01-01,7\n")
    long = _csv(f"{tmp_dir}/l", "l.csv", "i,c,d,v\n" + "".join(f"{label},Liberia 2,2014-09-0{i + 1},{i + 1}\n" for i, label in enumerate(EBOLA_INDICATORS.values())))
    wide = f"{tmp_dir}/w"
    _csv(wide, "part-0.csv", "c,n,d,t\nViet Nam,1,0,2009-07-06\nGrand Total,9,9,2009-07-05\n")
    _csv(wide, "part-1.csv", "c,n,d,t\nPeru,2,0,2009-07-05\nPeru,3,0,2009-07-04\nPeru,4,0,2009-07-06\n")
    sars = _csv(f"{tmp_dir}/s", "s.csv", "d,c,n,x,r\n2003-03-18,\"Taiwan, China\",1,0,0\n2003-03-17,Viet Nam,2,1,0\n")
    fact = build_fact(read_cases(spark, cases), read_vaccinations(spark, vacc), read_long_outbreak(spark, long),
                      read_wide_outbreak(spark, wide, ["country", "tt_cases", "tt_deaths", "date"], ordinal=True),
                      read_wide_outbreak(spark, sars, ["date", "country", "tt_cases", "tt_deaths", "tt_recovery"], ordinal=True)).collect()
    rows = {(r.category, r.country, r.date): r for r in fact}
    assert len(fact) == len(rows) == 3 + 2 + 4 + 2
    assert rows["covid", "Peru", D(2021, 1, 8)].tt_cases == 5.0 and rows["covid", "Peru", D(2021, 1, 8)].people_fully_vaccinated == 0.0
    assert {k[1:]: r.contador_dia for k, r in rows.items() if k[0] == "h1n1"} == {
        ("Vietnam", D(2009, 7, 6)): 1, ("Peru", D(2009, 7, 5)): 2, ("Peru", D(2009, 7, 4)): 3, ("Peru", D(2009, 7, 6)): 1}
    assert {k[1:]: r.contador_dia for k, r in rows.items() if k[0] == "sars"} == {("China", D(2003, 3, 18)): 1, ("Vietnam", D(2003, 3, 17)): 2}
    assert rows["h1n1", "Vietnam", D(2009, 7, 6)].continent == "Asia"
    assert {(r.country, r.tt_cases, r.tt_deaths) for k, r in rows.items() if k[0] == "ebola"} == {("Liberia", 1.0, 0.0), ("Liberia", 0.0, 2.0)}


def _series(spark, n, f):
    first = D(2020, 1, 6)  # a Monday
    rows = [("s", first + dt.timedelta(days=i), float(f(i))) for i in range(n)]
    return spark.createDataFrame(rows, "g string, ds date, y double"), first


@pytest.mark.parametrize("model", [forecast_linear_weekly, forecast_changepoint])
def test_forecast_of_a_line_with_weekends(spark, model):
    """y = 3 + 2 t, 7 more on Sundays and 7 less on Mondays: both models continue it."""
    def y(i):
        return 3 + 2 * i + 7 * (i % 7 == 6) - 7 * (i % 7 == 0)

    df, first = _series(spark, 140, y)
    got = model(df, ["g"], horizon=14).orderBy("ds").collect()
    assert len(got) == 154
    for r in got:
        assert abs(r.yhat - y((r.ds - first).days)) < 1.5 and r.yhat_lower <= r.yhat <= r.yhat_upper


def test_forecast_bends_and_years(spark):
    bend, first = _series(spark, 200, lambda i: 10 + i if i < 80 else 90 - 2 * (i - 80))
    got = forecast_changepoint(bend, ["g"], horizon=10, ridge=1e-3).orderBy("ds").collect()
    assert abs(got[-1].yhat - (90 - 2 * (209 - 80))) < 12
    year, first = _series(spark, 3 * 365, lambda i: 50 + 20 * np.sin(2 * np.pi * (18267 + i) / 365.25))
    got = forecast_changepoint(year, ["g"], horizon=60).orderBy("ds").collect()
    off = [abs(r.yhat - (50 + 20 * np.sin(2 * np.pi * (18267 + (r.ds - first).days) / 365.25))) for r in got[-60:]]
    assert max(off) < 3
