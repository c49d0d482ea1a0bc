"""Invariants over the driver's sf0.001 tables and cross-checks between equivalent plans."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators.series import lag_days, repair_negatives
from vigil.plans.catalog import REGISTRY
from vigil.sources.tables import Inputs


def _inp(spark):
    return Inputs(spark, SF_SMALL)


def test_repair_leaves_no_negative_or_null(spark):
    out = repair_negatives(_inp(spark).view("v_daily"), ["country"], "date", ["tt_cases", "tt_deaths"])
    bad = out.where((F.col("tt_cases") < 0) | (F.col("tt_deaths") < 0) | F.col("tt_cases").isNull()
                    | F.col("tt_deaths").isNull()).count()
    assert bad == 0


def test_lag_join_equals_window(spark):
    d = _inp(spark).view("v_daily")
    a = lag_days(d, ["country"], "date", ["tt_cases"], 7, how="join")
    b = lag_days(d, ["country"], "date", ["tt_cases"], 7, how="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_counter_is_one_to_n(spark):
    t = REGISTRY["day_counter_first_seen"].build(_inp(spark))
    n = t.count()
    agg = t.agg(F.min("contador_dia").alias("lo"), F.max("contador_dia").alias("hi"),
                F.countDistinct("contador_dia").alias("k")).first()
    assert (agg.lo, agg.hi, agg.k) == (1, n, n)


def test_union_row_count(spark):
    inp = _inp(spark)
    n = REGISTRY["union_by_name"].build(inp).count()
    assert n == inp.view("v_cases").count() + inp.view("v_long").count()


def test_prefix_fanout_count(spark):
    # 25 nations; the 8-character prefixes NATION_1 and NATION_2 each map to 5 continents
    assert REGISTRY["join_prefix_fanout"].build(_inp(spark)).count() == 93


def test_sentiment_shares_sum_to_one(spark):
    s = REGISTRY["sentiment_scores"].build(_inp(spark))
    tot = s.select((F.col("neg") + F.col("neu") + F.col("pos")).alias("t")).where(F.col("t") > 0)
    assert tot.where(F.abs(F.col("t") - 1.0) > 0.0021).count() == 0


def test_forecast_band_contains_estimate(spark):
    f = REGISTRY["forecast_top_countries"].build(_inp(spark))
    assert f.where(~((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper")))).count() == 0
    # 60 future days per (country, metric) series
    hist = REGISTRY["series_unpivot"].build(_inp(spark)).count()
    assert f.count() == hist + 15 * 60


def test_changepoint_forecast_shape(spark):
    f = REGISTRY["forecast_changepoint"].build(_inp(spark))
    assert f.count() == REGISTRY["forecast_top_countries"].build(_inp(spark)).count()
    assert f.where(F.col("yhat").isNull()).count() == 0


def test_topk_series_has_k_countries(spark):
    s = REGISTRY["topk_series"].build(_inp(spark))
    assert s.select("country").distinct().count() == 5
    assert sorted(r.contador for r in s.select("contador").distinct().collect()) == [1, 2, 3, 4, 5]


def test_bucketed_window_lag_equals_join_across_bucket_edges(spark):
    import datetime as dt
    start = dt.date(2020, 1, 1)
    rows = [(c, start + dt.timedelta(days=i), float(i * (3 if c == "A" else -2)))
            for c in ("A", "B") for i in range(100) if not (c == "B" and i % 9 == 4)]
    df = spark.createDataFrame(rows, "country string, date date, v double")
    a = lag_days(df, ["country"], "date", ["v"], 7, how="join")
    for bucket in (8, 10, 64):
        b = lag_days(df, ["country"], "date", ["v"], 7, how="window", bucket_days=bucket)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, bucket
