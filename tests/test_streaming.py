"""The incremental daily load equals the batch job and is idempotent on replay."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.plans.catalog.q_text import lexicon_df
from vigil.plans.posts import PostsRun, build_posts
from vigil.sources.tables import Inputs
from vigil.streaming.daily_posts import load_days, start

COLS = ["post_id", "ts", "date", "tweet", "language", "username", "likes"]


def test_stream_matches_batch(spark, tmp_dir):
    inp = Inputs(spark, SF_SMALL)
    first = dt.date(2024, 1, 1)
    posts = inp.view("v_posts").select(*COLS).where(F.col("date") >= first)
    landing, out = f"{tmp_dir}/landing", f"{tmp_dir}/marts"
    day1 = posts.where(F.col("date") <= dt.date(2024, 1, 7))
    day1.write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    lex = lexicon_df(inp)
    q = start(spark, landing, schema, out, lex, checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination(300)
    # a second arrival: the rest of the days
    posts.where(F.col("date") > dt.date(2024, 1, 7)).write.mode("append").parquet(landing)
    q = start(spark, landing, schema, out, lex, checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination(300)

    mart = spark.read.parquet(f"{out}/posts")
    days = sorted(r.date for r in posts.where("language = 'en'").select("date").distinct().collect())
    assert len(days) > 15
    expected = posts.where("language = 'en'").count()
    assert mart.count() == expected
    for d in days[:2]:  # a day's marts are those of the batch run for it
        _, bigrams, trigrams = build_posts(posts, PostsRun.daily(d + dt.timedelta(days=1)), lex)
        for name, batch, stamp in (("bigrams", bigrams, d), ("trigrams", trigrams, d + dt.timedelta(days=1))):
            got = spark.read.parquet(f"{out}/{name}").where(F.col("date") == stamp)
            assert sorted((r.words, r.total) for r in got.collect()) == sorted((r.words, r.total) for r in batch.collect()), name
    assert sorted(r.date for r in mart.select("date").distinct().collect()) == days

    # replaying a day rewrites its partitions instead of appending
    load_days(spark, landing, schema, out, lex, [days[0]])
    assert spark.read.parquet(f"{out}/posts").count() == expected
    big = spark.read.parquet(f"{out}/bigrams")
    assert big.groupBy("date").count().where("count > 20").count() == 0


def test_restart_goes_on_and_empties_days(spark, tmp_dir):
    inp = Inputs(spark, SF_SMALL)
    posts = inp.view("v_posts").select(*COLS)
    days = [r["date"] for r in posts.where("language = 'en'").groupBy("date").count().orderBy("date").limit(2).collect()]
    landing, out, lex = f"{tmp_dir}/landing", f"{tmp_dir}/marts", lexicon_df(inp)
    posts.where(F.col("date") == days[0]).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    start(spark, landing, schema, out, lex).awaitTermination(300)
    kept = spark.read.parquet(f"{out}/posts").count()
    # a mark in the first day's files: a restart without a folder of its own must not touch that day again
    before = {f for f in os.listdir(f"{out}/posts/date={days[0]}")}
    posts.where(F.col("date") == days[1]).write.mode("append").parquet(landing)
    start(spark, landing, schema, out, lex).awaitTermination(300)
    assert spark.read.parquet(f"{out}/posts").count() > kept and {f for f in os.listdir(f"{out}/posts/date={days[0]}")} == before
    # a day that loses its posts is emptied, in all three marts
    load_days(spark, landing, schema, out, lex, [days[0]], lang="no such language")
    assert spark.read.parquet(f"{out}/posts").select("date").distinct().count() == 1
    assert spark.read.parquet(f"{out}/bigrams").where(F.col("date") == days[0]).isEmpty()
    assert spark.read.parquet(f"{out}/trigrams").where(F.col("date") == days[0] + dt.timedelta(days=1)).isEmpty()
