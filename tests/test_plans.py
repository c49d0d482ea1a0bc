"""Physical-plan checks: pushdown, pruning, broadcast only where bounded, no cartesian products."""

import datetime as dt
import io
from contextlib import redirect_stdout

from conftest import SF_SMALL
from vigil.operators.search import PostFilter, search_posts
from vigil.operators.sentiment import score_polarity, score_sentiment, score_sentiment_rules
from vigil.plans.catalog import REGISTRY
from vigil.plans.catalog.q_text import all_posts, lexicon_df, polarity_df
from vigil.sources.tables import Inputs


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_language_filter_reaches_parquet(spark):
    p = plan(REGISTRY["filter_language"].build(Inputs(spark, SF_SMALL)))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)" in p


def test_projection_pruned_at_scan(spark):
    p = plan(REGISTRY["fn_date_format"].build(Inputs(spark, SF_SMALL)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_topk_is_take_ordered_and_broadcast(spark):
    p = plan(REGISTRY["topk_series"].build(Inputs(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in p
    assert "BroadcastExchange" in p


def test_no_cartesian_products(spark):
    inp = Inputs(spark, SF_SMALL)
    for name in ("fact_unified", "forecast_top_countries", "posts_mart", "top_trigrams", "ols_chart_data"):
        p = plan(REGISTRY[name].build(inp))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_ngram_regex_runs_once_per_text(spark):
    p = plan(REGISTRY["top_bigrams"].build(Inputs(spark, SF_SMALL)))
    # no filter inferred below the explode re-runs the tokenizer: it appears in projections only
    lines = p.splitlines()
    assert any("(?=(" in line for line in lines)          # the n-gram regex is in the plan
    conditions = [line for line in lines if line.strip().startswith("Condition")]
    assert not any("regexp_extract_all" in line for line in conditions)


def test_aggregations_are_partial_then_final(spark):
    p = plan(REGISTRY["ngram_counts"].build(Inputs(spark, SF_SMALL)))
    assert "partial_count" in p


def test_posts_scan_prunes_partitions(spark, tmp_dir):
    inp = Inputs(spark, SF_SMALL)
    path = f"{tmp_dir}/posts"
    inp.view("v_posts").select("post_id", "ts", "date", "language", "likes").write.partitionBy("date").parquet(path)
    df = spark.read.parquet(path)
    q = search_posts(df, PostFilter(since="2024-01-02", lang="en"))
    p = plan(q)
    assert "PartitionFilters: [isnotnull(date" in p and "date#" in p.split("PartitionFilters", 1)[1].split("]", 1)[0]
    assert "EqualTo(language,en)" in p
    days = {r.date for r in q.select("date").distinct().collect()}
    assert days and min(days) >= dt.date(2024, 1, 2)


def test_repair_join_spreads_a_hot_country(spark):
    # the self-join is keyed on (country, date): one country with a third of the rows still
    # spreads over its dates
    p = plan(REGISTRY["repair_negatives"].build(Inputs(spark, SF_SMALL)))
    exchanges = [line for line in p.splitlines() if "hashpartitioning(" in line]
    assert any("country" in line and "date" in line for line in exchanges)
    assert not any("hashpartitioning(country" in line and "date" not in line for line in exchanges)


def test_day_counter_is_broadcast_not_shuffled_on_date(spark):
    p = plan(REGISTRY["join_day_counter"].build(Inputs(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p
    assert not any("hashpartitioning(date" in line for line in p.splitlines())


def test_scorers_stay_in_the_row(spark):
    inp = Inputs(spark, SF_SMALL)
    posts, lex, pol = all_posts(inp), lexicon_df(inp), polarity_df(inp)
    frames = [score_sentiment(posts, "post_id", "text", lex, keep=["tweet"]), score_sentiment_rules(posts, "post_id", "text", lex, keep=["tweet"]),
              score_polarity(posts, "post_id", "text", pol, intensity_col="intensity", modifier_col="modifier")]
    for df in frames:
        p = plan(df).split("===== Subqueries =====")[0]
        assert not any(x in p for x in ("Exchange", "Generate", "Join", "Aggregate", "Python", "monotonically"))

