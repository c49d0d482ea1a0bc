"""Outbreak ETL (F-9): five sources -> one fact table.

covid cases: tag -> drop keys with a null continent -> prefix dimension -> day counter ->
             negative repair (7 days earlier) -> vaccinations by (date, id)
long outbreak: indicator columns -> group-sum -> name map -> prefix lookup -> day counter
wide outbreak A: name map -> prefix lookup -> drop 'Grand Total' -> day counter
wide outbreak B: name map -> prefix lookup -> day counter
then a union by column name (missing columns null). Dates are DATE everywhere.

Each source is read once, all four at the same time: its rows are checkpointed (into the shared
``spark.checkpoint.dir``), and the bad keys, the dimension, the day counters (they number distinct dates only, a
calendar-sized window) and the rows come from there; the four counters and the dimension are made at the same time too. The repair runs on
the checkpointed rows before anything is joined to them, as it reads them three times.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.aggregate import group_sum, unify
from vigil.operators.joins import broadcast_if_bounded
from vigil.operators.lookup import attach_side_measure, prefix_dimension, prefix_lookup
from vigil.operators.series import counter_of, repair_negatives
from vigil.operators.shape import (drop_keys_with_null, drop_value, indicator_columns, normalise_values, tag)
from vigil.session import in_parallel, materialize
from vigil.sources.files import ORDINAL

# Fixed values (the reference's rules for its real datasets).
EBOLA_INDICATORS = {
    "tt_cases": "Cumulative number of confirmed Ebola cases",
    "tt_deaths": "Cumulative number of confirmed Ebola deaths",
}
EBOLA_RENAMES = {"Liberia 2": "Liberia", "Guinea 2": "Guinea"}
H1N1_RENAMES = {"Korea, Republic of": "South Korea", "Viet Nam": "Vietnam", "Brunei Darussalam": "Brunei"}
SARS_RENAMES = {
    "Hong Kong SAR, China": "China",
    "Taiwan, China": "China",
    "Macao SAR, China": "China",
    "Viet Nam": "Vietnam",
    "Russian Federation": "Russia",
    "Republic of Ireland": "Ireland",
    "Republic of Korea": "South Korea",
}
TOTAL_ROW_LABEL = "Grand Total"
PREFIX_LENGTH = 8
REPAIR_DAYS = 7

FACT_COLUMNS = ["id", "category", "date", "country", "continent", "tt_cases", "tt_deaths", "contador_dia",
                "iso_code", "people_fully_vaccinated"]


@dataclass
class FactParams:
    long_indicators: Mapping[str, str] = field(default_factory=lambda: dict(EBOLA_INDICATORS))
    long_renames: Mapping[str, str] = field(default_factory=lambda: dict(EBOLA_RENAMES))
    wide_a_renames: Mapping[str, str] = field(default_factory=lambda: dict(H1N1_RENAMES))
    wide_b_renames: Mapping[str, str] = field(default_factory=lambda: dict(SARS_RENAMES))
    total_label: str = TOTAL_ROW_LABEL
    prefix_length: int = PREFIX_LENGTH
    repair_days: int = REPAIR_DAYS
    # columns that order a source's rows, for counters by first appearance; None: by date. The CSV
    # readers give the order of the file as ``source_ordinal``
    cases_order: Sequence[str] | None = ("id", "date")
    wide_a_order: Sequence[str] | None = (ORDINAL,)
    wide_b_order: Sequence[str] | None = (ORDINAL,)
    on_multi: str = "fanout"
    materialize: bool = True


def _staged(df: DataFrame, p: FactParams) -> DataFrame:
    """Checkpointed once, for its counter and its rows."""
    return materialize(df) if p.materialize else df


def cases_rows(cases: DataFrame) -> DataFrame:
    """cases(id, date, location, continent, new_cases, new_deaths) as rows of the fact."""
    return cases.select("id", F.lit("covid").alias("category"), "date", F.col("location").alias("country"),
                        "continent", F.col("new_cases").alias("tt_cases"), F.col("new_deaths").alias("tt_deaths"))


def long_rows(long_df: DataFrame, p: FactParams, category: str = "ebola") -> DataFrame:
    """long(indicator, country, date, value) -> group-summed measures of a day and country."""
    d = tag(long_df, category).withColumn("continent", F.lit("null"))
    d = indicator_columns(d, "indicator", "value", p.long_indicators)
    d = group_sum(d, ["category", "date", "country", "continent"], ["tt_cases", "tt_deaths"])
    return normalise_values(d, "country", p.long_renames).drop("continent")


def wide_a_rows(wide: DataFrame, p: FactParams, category: str = "h1n1") -> DataFrame:
    """wide(country, tt_cases, tt_deaths, date) -> the same rows, total rows dropped."""
    d = normalise_values(tag(wide, category), "country", p.wide_a_renames)
    return drop_value(d.select("category", "date", "country", "tt_cases", "tt_deaths", *(p.wide_a_order or ())), "country", p.total_label)


def wide_b_rows(wide: DataFrame, p: FactParams, category: str = "sars") -> DataFrame:
    """wide(date, country, tt_cases, tt_deaths, tt_recovery) -> the same rows."""
    d = normalise_values(tag(wide, category), "country", p.wide_b_renames)
    return d.select("category", "date", "country", "tt_cases", "tt_deaths", *(p.wide_b_order or ()))


def orders(p: FactParams) -> list[Sequence[str] | None]:
    """What the day counters of the four sources go by."""
    return [p.cases_order, None, p.wide_a_order, p.wide_b_order]


def unified(covid: DataFrame, others: Sequence[DataFrame], vaccinations: DataFrame, dim: DataFrame, counters: Sequence[DataFrame], p: FactParams) -> DataFrame:
    """The fact from clean covid rows and the rows of the other sources, with the dimension and each source's day counter."""
    c = repair_negatives(covid, ["country"], "date", ["tt_cases", "tt_deaths"], days=p.repair_days, stage=False)
    c = attach_side_measure(c.join(counters[0], "date", "left"), vaccinations, ["date", "id"], ["date", "iso_code"], ["people_fully_vaccinated"])
    parts = [c.select(*FACT_COLUMNS)]
    for d, counter in zip(others, counters[1:]):
        d = prefix_lookup(d, dim, "country", "country", "continent", p.prefix_length, p.on_multi).join(counter, "date", "left")
        parts.append(d.select(*[x for x in FACT_COLUMNS if x in d.columns]))
    return unify(*parts).select(*FACT_COLUMNS)


def build_fact(cases: DataFrame, vaccinations: DataFrame, long_df: DataFrame, wide_a: DataFrame,
               wide_b: DataFrame, params: FactParams | None = None) -> DataFrame:
    p = params or FactParams()
    spark = cases.sparkSession
    sources = [cases_rows(cases), long_rows(long_df, p), wide_a_rows(wide_a, p), wide_b_rows(wide_b, p)]
    covid, *others = in_parallel(spark, *[partial(_staged, s, p) for s in sources])
    covid = drop_keys_with_null(covid, "id", "continent")  # a broadcast anti-join with few keys
    # the counter of each source's dates, and the distinct (prefix, continent) pairs: broadcast behind size checks
    dim, *counters = in_parallel(spark, lambda: broadcast_if_bounded(_staged(prefix_dimension(covid, "country", "continent", p.prefix_length), p)),
                                 *[partial(counter_of, d, "date", list(o) if o else None) for d, o in zip([covid, *others], orders(p))])
    return unified(covid, others, vaccinations, dim, counters, p)
