"""Analysis job: daily aggregate -> top-k countries -> forecasts and regressions.

The reference loops over the 5 countries and 3 metrics and fits 15 models one after another; here
the countries become a broadcast semi-join of k rows and the 15 fits become 15 groups of one
grouped aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.aggregate import group_sum, top_k, top_k_series
from vigil.operators.shape import rename, zero_nulls
from vigil.session import materialize

METRICS = ("tt_cases", "tt_deaths", "tt_vaccine")
#: The fact's measures and their names in the series.
MEASURES = {"tt_cases": "tt_cases", "tt_deaths": "tt_deaths", "people_fully_vaccinated": "tt_vaccine"}


def daily_country(fact: DataFrame, category: str = "covid") -> DataFrame:
    """One category's measures summed by day and country (null keys are kept)."""
    of = fact.where(F.col("category") == category)
    return group_sum(of, ["date", "country"], list(MEASURES), drop_null_keys=False, empty_as_zero=False)


def analysis_series(fact: DataFrame, stage: bool = False) -> DataFrame:
    """date, country, tt_cases, tt_deaths, tt_vaccine with nulls as 0. With ``stage`` the series (one row per
    day and country) is checkpointed, for the several results that are drawn from it."""
    daily = zero_nulls(rename(daily_country(fact), MEASURES).select("date", "country", *METRICS), list(METRICS))
    return materialize(daily) if stage else daily


def top_countries(series: DataFrame, k: int = 5, measure: str = "tt_cases") -> DataFrame:
    """country, total, rank 1..k."""
    return top_k(series, "country", measure, k, rank_name="contador", total_name="total")


def top_country_series(series: DataFrame, k: int = 5, measure: str = "tt_cases") -> DataFrame:
    return top_k_series(series, "country", measure, k, rank_name="contador")
