"""Relational base: projections, filters, aggregates, unions, date/prefix functions
(P-1..P-11, L-1..L-3, L-5, L-6, G-1, G-4..G-7, U-1, U-2, X-1..X-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.dates import date_text, days_before, to_date
from vigil.operators.aggregate import (coverage, group_sum, negative_profile, null_profile, union_distinct,
                                       unify)
from vigil.operators.lookup import prefix_dimension
from vigil.operators.series import lag_days
from vigil.operators.shape import (clamp0, cond_replace, drop_columns, drop_keys_with_null, drop_null,
                                   drop_value, indicator_columns, key_column, negative_rows, normalise_values,
                                   project, rename, rename_positional, tag, zero_nulls)
from vigil.plans.catalog.base import oracle, register
from vigil.sources.tables import Inputs

D = "CAST({0} AS DOUBLE) AS {0}".format
CASE_COLS = f"id, category, date, country, continent, {D('tt_cases')}, {D('tt_deaths')}"
DAILY_COLS = f"country, date, {D('tt_cases')}, {D('tt_deaths')}"

# ebola-like long dataset: indicators F and O become the two measures, P gives nothing
INDICATORS = {"tt_cases": "F", "tt_deaths": "O"}
EBOLA = ("ebola", """
SELECT indicator, country, date, value, 'ebola' AS category, 'null' AS continent,
       CASE WHEN indicator = 'F' THEN value END AS tt_cases,
       CASE WHEN indicator = 'O' THEN value END AS tt_deaths
FROM v_long""")
UNIFIED = ("unified", """
SELECT id, category, date, country, continent, tt_cases, tt_deaths FROM v_cases
UNION ALL
SELECT NULL, category, date, country, NULL, value, NULL FROM ebola""")


def ebola_long(inp: Inputs) -> DataFrame:
    lg = tag(inp.view("v_long"), "ebola").withColumn("continent", F.lit("null"))
    return indicator_columns(lg, "indicator", "value", INDICATORS)


def unified(inp: Inputs) -> DataFrame:
    """covid cases plus the long dataset (value as tt_cases); missing columns are null."""
    other = tag(inp.view("v_long"), "ebola").select("category", "date", "country",
                                                    F.col("value").alias("tt_cases"))
    return unify(inp.view("v_cases"), other)


# ---- projections --------------------------------------------------------------------------------

@register("proj_tag", oracle(f"SELECT indicator, country, date, {D('value')}, 'ebola' AS category FROM v_long",
                             ["v_long"]))
def proj_tag(inp: Inputs) -> DataFrame:
    return tag(inp.view("v_long"), "ebola")


@register("proj_key", oracle(f"SELECT iso_code AS id, date, {D('people_fully_vaccinated')} FROM v_side", ["v_side"]))
def proj_key(inp: Inputs) -> DataFrame:
    return key_column(inp.view("v_side"), "iso_code", "id")


@register("proj_select", oracle(f"SELECT id, date, country, {D('tt_cases')} FROM v_cases", ["v_cases"]))
def proj_select(inp: Inputs) -> DataFrame:
    return project(inp.view("v_cases"), ["id", "date", "country", "tt_cases"])


@register("proj_rename", oracle("SELECT id, category, date, country AS location, continent, "
                                "CAST(tt_cases AS DOUBLE) AS new_cases, CAST(tt_deaths AS DOUBLE) AS new_deaths "
                                "FROM v_cases", ["v_cases"]))
def proj_rename(inp: Inputs) -> DataFrame:
    return rename(inp.view("v_cases"), {"country": "location", "tt_cases": "new_cases",
                                        "tt_deaths": "new_deaths"})


@register("proj_positional", oracle("SELECT indicator AS indicator_name, country AS place, date AS day, "
                                    "CAST(value AS DOUBLE) AS amount FROM v_long", ["v_long"]))
def proj_positional(inp: Inputs) -> DataFrame:
    return rename_positional(inp.view("v_long"), ["indicator_name", "place", "day", "amount"])


@register("proj_drop", oracle(f"SELECT id, date, country, {D('tt_cases')}, {D('tt_deaths')} FROM v_cases",
                              ["v_cases"]))
def proj_drop(inp: Inputs) -> DataFrame:
    return drop_columns(inp.view("v_cases"), ["category", "continent"])


@register("proj_indicator", oracle(f"SELECT indicator, country, date, {D('value')}, "
                                   "CAST(CASE WHEN indicator = 'F' THEN value END AS DOUBLE) AS tt_cases, "
                                   "CAST(CASE WHEN indicator = 'O' THEN value END AS DOUBLE) AS tt_deaths "
                                   "FROM v_long", ["v_long"]))
def proj_indicator(inp: Inputs) -> DataFrame:
    return indicator_columns(inp.view("v_long"), "indicator", "value", INDICATORS)


VALUE_MAP = {"NATION_11": "NATION_1", "NATION_12": "NATION_1", "NATION_13": "NATION_1"}


@register("proj_value_map", oracle(f"""
SELECT id, date, CASE WHEN country IN ('NATION_11', 'NATION_12', 'NATION_13') THEN 'NATION_1' ELSE country END
       AS country, {D('tt_cases')}
FROM v_cases""", ["v_cases"]))
def proj_value_map(inp: Inputs) -> DataFrame:
    return normalise_values(inp.view("v_cases"), "country", VALUE_MAP).select("id", "date", "country", "tt_cases")


@register("proj_clamp", oracle("SELECT country, date, CAST(CASE WHEN tt_cases < 0 THEN 0 ELSE tt_cases END AS DOUBLE) "
                               "AS tt_cases, CAST(CASE WHEN tt_deaths < 0 THEN 0 ELSE tt_deaths END AS DOUBLE) "
                               "AS tt_deaths FROM v_daily", ["v_daily"]))
def proj_clamp(inp: Inputs) -> DataFrame:
    d = inp.view("v_daily")
    return d.withColumns({"tt_cases": clamp0("tt_cases"), "tt_deaths": clamp0("tt_deaths")})


@register("proj_cond_replace", oracle("""
SELECT a.country, a.date, CAST(CASE WHEN a.tt_cases < 0 THEN b.tt_cases ELSE a.tt_cases END AS DOUBLE) AS tt_cases
FROM v_daily a LEFT JOIN v_daily b ON a.country IS NOT DISTINCT FROM b.country AND a.date - 7 = b.date""",
                                      ["v_daily"]))
def proj_cond_replace(inp: Inputs) -> DataFrame:
    d = lag_days(inp.view("v_daily"), ["country"], "date", ["tt_cases"], 7)
    return d.select("country", "date", cond_replace("tt_cases", "lag_tt_cases").alias("tt_cases"))


@register("proj_zero_nulls", oracle("SELECT iso_code, date, CAST(COALESCE(people_fully_vaccinated, 0) AS DOUBLE) "
                                    "AS people_fully_vaccinated FROM v_side", ["v_side"]))
def proj_zero_nulls(inp: Inputs) -> DataFrame:
    return zero_nulls(inp.view("v_side"), ["people_fully_vaccinated"])


# ---- filters ------------------------------------------------------------------------------------

@register("filter_bad_keys", oracle(f"SELECT {CASE_COLS} FROM v_cases c WHERE NOT EXISTS "
                                    "(SELECT 1 FROM v_cases b WHERE b.continent IS NULL "
                                    "AND b.id IS NOT DISTINCT FROM c.id)", ["v_cases"]))
def filter_bad_keys(inp: Inputs) -> DataFrame:
    return drop_keys_with_null(inp.view("v_cases"), "id", "continent")


@register("filter_negative", oracle(f"SELECT {DAILY_COLS} FROM v_daily WHERE tt_cases < 0", ["v_daily"]))
def filter_negative(inp: Inputs) -> DataFrame:
    return negative_rows(inp.view("v_daily"), "tt_cases")


@register("filter_drop_value", oracle(f"SELECT {CASE_COLS} FROM v_cases WHERE country IS DISTINCT FROM 'NATION_3'",
                                      ["v_cases"]))
def filter_drop_value(inp: Inputs) -> DataFrame:
    return drop_value(inp.view("v_cases"), "country", "NATION_3")


@register("filter_dropna", oracle(f"SELECT {CASE_COLS} FROM v_cases WHERE continent IS NOT NULL", ["v_cases"]))
def filter_dropna(inp: Inputs) -> DataFrame:
    return drop_null(inp.view("v_cases"), ["continent"])


@register("filter_category", oracle(f"SELECT {CASE_COLS} FROM unified WHERE category = 'covid'",
                                    ["v_cases", "v_long"], [EBOLA, UNIFIED]))
def filter_category(inp: Inputs) -> DataFrame:
    return unified(inp).where(F.col("category") == "covid")


# ---- aggregates ---------------------------------------------------------------------------------

@register("agg_group_sum", oracle("""
SELECT category, date, country, continent, CAST(COALESCE(SUM(tt_cases), 0) AS DOUBLE) AS tt_cases,
       CAST(COALESCE(SUM(tt_deaths), 0) AS DOUBLE) AS tt_deaths
FROM ebola
WHERE category IS NOT NULL AND date IS NOT NULL AND country IS NOT NULL AND continent IS NOT NULL
GROUP BY 1, 2, 3, 4""", ["v_long"], [EBOLA]))
def agg_group_sum(inp: Inputs) -> DataFrame:
    return group_sum(ebola_long(inp), ["category", "date", "country", "continent"], ["tt_cases", "tt_deaths"])


@register("agg_distinct_pairs", oracle("""
SELECT DISTINCT substring(country, 1, 8) AS country, continent FROM v_cases c
WHERE NOT EXISTS (SELECT 1 FROM v_cases b WHERE b.continent IS NULL AND b.id IS NOT DISTINCT FROM c.id)""",
                                       ["v_cases"]))
def agg_distinct_pairs(inp: Inputs) -> DataFrame:
    return prefix_dimension(drop_keys_with_null(inp.view("v_cases"), "id", "continent"), "country", "continent", 8)


_CASE_COLUMNS = ["id", "category", "date", "country", "continent", "tt_cases", "tt_deaths"]


def _profile_sql(m: str) -> str:
    counts = ", ".join(f"COUNT(CASE WHEN {m} < 0 THEN {c} END) AS n_{c}" for c in _CASE_COLUMNS)
    return f"SELECT '{m}' AS measure, {counts} FROM v_cases"


@register("agg_negative_profile", oracle(_profile_sql("tt_cases") + "\nUNION ALL\n" + _profile_sql("tt_deaths"),
                                         ["v_cases"]))
def agg_negative_profile(inp: Inputs) -> DataFrame:
    return negative_profile(inp.view("v_cases"), ["tt_cases", "tt_deaths"])


@register("agg_null_profile", oracle("SELECT bool_or(iso_code IS NULL) AS has_null_iso_code, "
                                     "bool_or(date IS NULL) AS has_null_date, "
                                     "bool_or(people_fully_vaccinated IS NULL) AS has_null_people_fully_vaccinated "
                                     "FROM v_side", ["v_side"]))
def agg_null_profile(inp: Inputs) -> DataFrame:
    return null_profile(inp.view("v_side"))


@register("agg_coverage", oracle("SELECT category, MIN(date) AS first_date, MAX(date) AS last_date FROM unified "
                                 "GROUP BY category", ["v_cases", "v_long"], [EBOLA, UNIFIED]))
def agg_coverage(inp: Inputs) -> DataFrame:
    return coverage(unified(inp), "category", "date")


# ---- set operations -----------------------------------------------------------------------------

@register("union_distinct", oracle(f"""
SELECT {DAILY_COLS} FROM (SELECT * FROM v_daily WHERE tt_cases < 0 UNION SELECT * FROM v_daily WHERE tt_deaths < 0) u""",
                                   ["v_daily"]))
def union_distinct_q(inp: Inputs) -> DataFrame:
    d = inp.view("v_daily")
    return union_distinct(negative_rows(d, "tt_cases"), negative_rows(d, "tt_deaths"))


@register("union_by_name", oracle(f"SELECT {CASE_COLS} FROM unified", ["v_cases", "v_long"], [EBOLA, UNIFIED]))
def union_by_name(inp: Inputs) -> DataFrame:
    return unified(inp)


# ---- scalar functions on the driver's tables ----------------------------------------------------

@register("fn_prefix", oracle("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, "
                              "substring(n_name, 1, 8) AS prefix FROM nation"))
def fn_prefix(inp: Inputs) -> DataFrame:
    n = inp.table("nation")
    return n.select("n_nationkey", "n_name", F.substring("n_name", 1, 8).alias("prefix"))


@register("fn_to_date", oracle("SELECT event_id, strftime(ts, '%d/%m/%Y') AS date_text, "
                               "CAST(strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS date FROM events"))
def fn_to_date(inp: Inputs) -> DataFrame:
    e = inp.table("events").select("event_id", date_text("ts", "dd/MM/yyyy").alias("date_text"))
    return e.withColumn("date", to_date("date_text", "dd/MM/yyyy"))


@register("fn_date_format", oracle("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders"))
def fn_date_format(inp: Inputs) -> DataFrame:
    return inp.table("orders").select("o_orderkey", date_text("o_orderdate").alias("date_text"))


@register("fn_date_sub", oracle("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, "
                                "CAST(o_orderdate AS DATE) - 7 AS date_before FROM orders"))
def fn_date_sub(inp: Inputs) -> DataFrame:
    o = inp.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return o.withColumn("date_before", days_before("date", 7))
