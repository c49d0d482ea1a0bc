"""Series and lookup queries: day counter, 7-day lag (join and window), negative repair, side-measure
join, prefix lookup, and the whole outbreak ETL (J-1..J-5, W-1, W-3, F-1, F-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.lookup import prefix_lookup
from vigil.operators.series import day_counter, day_counter_table, lag_days, repair_negatives
from vigil.plans.catalog.base import oracle, register
from vigil.plans.catalog.q_analysis import COVID_FACT, covid_fact
from vigil.plans.fact import FactParams, build_fact
from vigil.plans.fact_load import FactLoad
from vigil.session import scratch_path
from vigil.sources.tables import Inputs

D = "CAST({0} AS DOUBLE) AS {0}".format

ORDERS_DATES = ("od", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders")


def orders_dates(inp: Inputs) -> DataFrame:
    return inp.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))


# ---- day counter --------------------------------------------------------------------------------

FIRST_SEEN_SQL = ("SELECT date, row_number() OVER (ORDER BY MIN(o_orderkey), date) AS contador_dia "
                  "FROM od WHERE date IS NOT NULL GROUP BY date")


@register("day_counter_first_seen", oracle(FIRST_SEEN_SQL, ctes=[ORDERS_DATES]))
def day_counter_first_seen(inp: Inputs) -> DataFrame:
    return day_counter_table(orders_dates(inp), "date", ["o_orderkey"], mode="first_seen")


@register("day_counter_chrono", oracle("SELECT date, row_number() OVER (ORDER BY date) AS contador_dia "
                                       "FROM (SELECT DISTINCT date FROM od WHERE date IS NOT NULL) d",
                                       ctes=[ORDERS_DATES]))
def day_counter_chrono(inp: Inputs) -> DataFrame:
    return day_counter_table(orders_dates(inp), "date", mode="chronological")


@register("join_day_counter", oracle("SELECT od.o_orderkey, od.date, c.contador_dia FROM od LEFT JOIN c "
                                     "ON od.date = c.date", ctes=[ORDERS_DATES, ("c", FIRST_SEEN_SQL)]))
def join_day_counter(inp: Inputs) -> DataFrame:
    return day_counter(orders_dates(inp), "date", ["o_orderkey"], mode="first_seen")


# ---- 7-day lag and repair -----------------------------------------------------------------------

LAG_SQL = oracle(f"""
SELECT a.country, a.date, CAST(a.tt_cases AS DOUBLE) AS tt_cases, CAST(a.tt_deaths AS DOUBLE) AS tt_deaths,
       CAST(b.tt_cases AS DOUBLE) AS lag_tt_cases, CAST(b.tt_deaths AS DOUBLE) AS lag_tt_deaths
FROM v_daily a LEFT JOIN v_daily b ON a.country IS NOT DISTINCT FROM b.country AND a.date - 7 = b.date""", ["v_daily"])


@register("join_lag7", LAG_SQL)
def join_lag7(inp: Inputs) -> DataFrame:
    return lag_days(inp.view("v_daily"), ["country"], "date", ["tt_cases", "tt_deaths"], 7, how="join")


@register("window_lag7", LAG_SQL)
def window_lag7(inp: Inputs) -> DataFrame:
    return lag_days(inp.view("v_daily"), ["country"], "date", ["tt_cases", "tt_deaths"], 7, how="window")


def _repair_expr(m: str, a: str = "a", b: str = "b") -> str:
    return (f"CASE WHEN {a}.{m} < 0 THEN COALESCE(CASE WHEN {b}.{m} < 0 THEN 0 ELSE {b}.{m} END, 0) "
            f"ELSE COALESCE({a}.{m}, 0) END")


@register("repair_negatives", oracle(f"""
SELECT a.country, a.date, CAST({_repair_expr('tt_cases')} AS DOUBLE) AS tt_cases,
       CAST({_repair_expr('tt_deaths')} AS DOUBLE) AS tt_deaths
FROM v_daily a LEFT JOIN v_daily b ON a.country IS NOT DISTINCT FROM b.country AND a.date - 7 = b.date""",
                                     ["v_daily"]))
def repair_negatives_q(inp: Inputs) -> DataFrame:
    return repair_negatives(inp.view("v_daily"), ["country"], "date", ["tt_cases", "tt_deaths"], 7)


@register("repair_negatives_window", oracle(f"""
SELECT a.country, a.date, CAST({_repair_expr('tt_cases')} AS DOUBLE) AS tt_cases,
       CAST({_repair_expr('tt_deaths')} AS DOUBLE) AS tt_deaths
FROM v_daily a LEFT JOIN v_daily b ON a.country IS NOT DISTINCT FROM b.country AND a.date - 7 = b.date""",
                                            ["v_daily"]))
def repair_negatives_window(inp: Inputs) -> DataFrame:
    return repair_negatives(inp.view("v_daily"), ["country"], "date", ["tt_cases", "tt_deaths"], 7, how="window")


# rows that repeat (country, date), with other values, and rows without a country
REPEATED = ("v_rep", """
SELECT country, date, tt_cases, tt_deaths FROM v_daily
UNION ALL
SELECT CASE WHEN day(date) % 3 = 0 THEN NULL ELSE country END AS country, date, tt_cases - 1000 AS tt_cases, tt_deaths
FROM v_daily WHERE day(date) % 5 = 0""")
REPEATED_SQL = oracle(f"""
SELECT a.country, a.date, CAST({_repair_expr('tt_cases')} AS DOUBLE) AS tt_cases,
       CAST({_repair_expr('tt_deaths')} AS DOUBLE) AS tt_deaths
FROM v_rep a LEFT JOIN (SELECT country, date, MAX(tt_cases) AS tt_cases, MAX(tt_deaths) AS tt_deaths FROM v_rep GROUP BY 1, 2) b
  ON a.country IS NOT DISTINCT FROM b.country AND a.date - 7 = b.date""", ["v_daily"], [REPEATED])


def repeated_rows(inp: Inputs) -> DataFrame:
    daily = inp.view("v_daily").select("country", "date", "tt_cases", "tt_deaths")
    day = F.dayofmonth("date")
    again = daily.where(day % 5 == 0).select(F.when(day % 3 != 0, F.col("country")).alias("country"), "date",
                                             (F.col("tt_cases") - 1000).alias("tt_cases"), "tt_deaths")
    return daily.unionByName(again)


@register("repair_repeated", REPEATED_SQL)
def repair_repeated(inp: Inputs) -> DataFrame:
    return repair_negatives(repeated_rows(inp), ["country"], "date", ["tt_cases", "tt_deaths"], 7)


@register("repair_repeated_window", REPEATED_SQL)
def repair_repeated_window(inp: Inputs) -> DataFrame:
    return repair_negatives(repeated_rows(inp), ["country"], "date", ["tt_cases", "tt_deaths"], 7, how="window")


# ---- lookups ------------------------------------------------------------------------------------

@register("join_vaccinations", oracle(f"""
SELECT id, category, date, country, continent, {D('tt_cases')}, {D('tt_deaths')}, iso_code,
       {D('people_fully_vaccinated')}
FROM covid_fact""", ["v_cases", "v_side"], [COVID_FACT]))
def join_vaccinations(inp: Inputs) -> DataFrame:
    return covid_fact(inp)


@register("join_prefix_fanout", oracle("""
SELECT CAST(n.n_nationkey AS BIGINT) AS n_nationkey, n.n_name, CAST(n.n_regionkey AS BIGINT) AS n_regionkey,
       d.continent
FROM nation n LEFT JOIN v_dim d ON substring(n.n_name, 1, 8) IS NOT DISTINCT FROM d.country""", ["v_dim"]))
def join_prefix_fanout(inp: Inputs) -> DataFrame:
    return prefix_lookup(inp.table("nation"), inp.view("v_dim"), "n_name", "country", "continent", 8, "fanout")


@register("join_prefix_first", oracle("""
SELECT CAST(n.n_nationkey AS BIGINT) AS n_nationkey, n.n_name, CAST(n.n_regionkey AS BIGINT) AS n_regionkey,
       d.continent
FROM nation n LEFT JOIN (SELECT country, MIN(continent) AS continent FROM v_dim GROUP BY country) d
  ON substring(n.n_name, 1, 8) IS NOT DISTINCT FROM d.country""", ["v_dim"]))
def join_prefix_first(inp: Inputs) -> DataFrame:
    return prefix_lookup(inp.table("nation"), inp.view("v_dim"), "n_name", "country", "continent", 8, "first")


# ---- the unified fact ---------------------------------------------------------------------------

# fixture rules: same shapes as the reference's name maps, over the fixture's country names
FIXTURE_PARAMS = dict(
    long_indicators={"tt_cases": "F", "tt_deaths": "O"},
    long_renames={"NATION_23": "NATION_3", "NATION_22": "NATION_2"},
    wide_a_renames={"NATION_15": "NATION_5", "NATION_16": "NATION_6", "NATION_17": "NATION_7"},
    wide_b_renames={"NATION_11": "NATION_1", "NATION_12": "NATION_1", "NATION_13": "NATION_1",
                    "NATION_18": "NATION_8", "NATION_19": "NATION_9", "NATION_20": "NATION_0",
                    "NATION_21": "NATION_2"},
)


def _map_sql(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {col} END"


def _counter_sql(src: str, order: str = "date") -> str:
    """By date, or by the dates' first appearance in ``MIN(column)`` order."""
    return f"SELECT date, row_number() OVER (ORDER BY {order}, date) AS contador_dia FROM {src} WHERE date IS NOT NULL GROUP BY date"


FACT_CTES = [
    ("covid_clean", """SELECT id, 'covid' AS category, date, country, continent, tt_cases, tt_deaths FROM v_cases c
WHERE NOT EXISTS (SELECT 1 FROM v_cases b WHERE b.continent IS NULL AND b.id IS NOT DISTINCT FROM c.id)"""),
    ("dim", "SELECT DISTINCT substring(country, 1, 8) AS pk, continent AS pv FROM covid_clean"),
    ("covid_cnt", "SELECT date, row_number() OVER (ORDER BY MIN(id), date) AS contador_dia FROM covid_clean "
                  "WHERE date IS NOT NULL GROUP BY date"),
    ("covid_rep", f"""SELECT a.id, a.category, a.date, a.country, a.continent,
       {_repair_expr('tt_cases')} AS tt_cases, {_repair_expr('tt_deaths')} AS tt_deaths
FROM covid_clean a LEFT JOIN covid_clean b ON a.country IS NOT DISTINCT FROM b.country AND a.date - 7 = b.date"""),
    ("covid", """SELECT r.*, k.contador_dia, s.iso_code, s.people_fully_vaccinated
FROM covid_rep r LEFT JOIN covid_cnt k ON r.date = k.date
LEFT JOIN (SELECT iso_code, date AS s_date, COALESCE(people_fully_vaccinated, 0) AS people_fully_vaccinated FROM v_side) s
  ON r.date IS NOT DISTINCT FROM s.s_date AND r.id IS NOT DISTINCT FROM s.iso_code"""),
    ("ebola_g", f"""SELECT category, date, {_map_sql('country', FIXTURE_PARAMS['long_renames'])} AS country,
       tt_cases, tt_deaths
FROM (SELECT 'ebola' AS category, date, country, 'null' AS continent,
             COALESCE(SUM(CASE WHEN indicator = 'F' THEN value END), 0) AS tt_cases,
             COALESCE(SUM(CASE WHEN indicator = 'O' THEN value END), 0) AS tt_deaths
      FROM v_long WHERE date IS NOT NULL AND country IS NOT NULL GROUP BY date, country) g"""),
    ("ebola_j", "SELECT e.category, e.date, e.country, d.pv AS continent, e.tt_cases, e.tt_deaths FROM ebola_g e "
                "LEFT JOIN dim d ON substring(e.country, 1, 8) IS NOT DISTINCT FROM d.pk"),
    ("ebola", f"SELECT e.*, c.contador_dia FROM ebola_j e LEFT JOIN ({_counter_sql('ebola_j')}) c ON e.date = c.date"),
    ("h1n1_j", f"""SELECT 'h1n1' AS category, w.date, w.country, d.pv AS continent, w.tt_cases, w.tt_deaths, w.source_ordinal
FROM (SELECT date, {_map_sql('country', FIXTURE_PARAMS['wide_a_renames'])} AS country, tt_cases, tt_deaths, source_ordinal
      FROM v_wide_a) w
LEFT JOIN dim d ON substring(w.country, 1, 8) IS NOT DISTINCT FROM d.pk
WHERE w.country IS DISTINCT FROM 'Grand Total'"""),
    ("h1n1", f"SELECT e.*, c.contador_dia FROM h1n1_j e LEFT JOIN ({_counter_sql('h1n1_j', 'MIN(source_ordinal)')}) c ON e.date = c.date"),
    ("sars_j", f"""SELECT 'sars' AS category, w.date, w.country, d.pv AS continent, w.tt_cases, w.tt_deaths, w.source_ordinal
FROM (SELECT date, {_map_sql('country', FIXTURE_PARAMS['wide_b_renames'])} AS country, tt_cases, tt_deaths, source_ordinal
      FROM v_wide_b) w
LEFT JOIN dim d ON substring(w.country, 1, 8) IS NOT DISTINCT FROM d.pk"""),
    ("sars", f"SELECT e.*, c.contador_dia FROM sars_j e LEFT JOIN ({_counter_sql('sars_j', 'MIN(source_ordinal)')}) c ON e.date = c.date"),
]
FACT_BODY = """
SELECT id, category, date, country, continent, CAST(tt_cases AS DOUBLE) AS tt_cases,
       CAST(tt_deaths AS DOUBLE) AS tt_deaths, CAST(contador_dia AS BIGINT) AS contador_dia, iso_code,
       CAST(people_fully_vaccinated AS DOUBLE) AS people_fully_vaccinated FROM covid
UNION ALL
SELECT NULL, category, date, country, continent, CAST(tt_cases AS DOUBLE), CAST(tt_deaths AS DOUBLE),
       CAST(contador_dia AS BIGINT), NULL, NULL FROM ebola
UNION ALL
SELECT NULL, category, date, country, continent, CAST(tt_cases AS DOUBLE), CAST(tt_deaths AS DOUBLE),
       CAST(contador_dia AS BIGINT), NULL, NULL FROM h1n1
UNION ALL
SELECT NULL, category, date, country, continent, CAST(tt_cases AS DOUBLE), CAST(tt_deaths AS DOUBLE),
       CAST(contador_dia AS BIGINT), NULL, NULL FROM sars"""
FACT_VIEWS = ["v_cases", "v_side", "v_long", "v_wide_a", "v_wide_b"]


def fixture_fact(inp: Inputs) -> DataFrame:
    return build_fact(*_fixture_sources(inp), FactParams(**FIXTURE_PARAMS))


def _fixture_sources(inp: Inputs) -> tuple[DataFrame, ...]:
    cases = inp.view("v_cases").select("id", "date", F.col("country").alias("location"), "continent",
                                       F.col("tt_cases").alias("new_cases"), F.col("tt_deaths").alias("new_deaths"))
    return cases, inp.view("v_side"), inp.view("v_long"), inp.view("v_wide_a"), inp.view("v_wide_b")


@register("fact_incremental", oracle(FACT_BODY, FACT_VIEWS, FACT_CTES))
def fact_incremental(inp: Inputs) -> DataFrame:
    """The fact after two loads: first of sources in which days are missing, wrong or too many and other keys are bad, then of
    the true ones."""
    cases, side, long_df, wide_a, wide_b = _fixture_sources(inp)
    early = F.dayofmonth("date") > 3
    wrong = F.when(F.month("date") == 5, F.col("new_cases") - 7000).otherwise(F.col("new_cases"))
    stale = cases.where(early).withColumn("new_cases", wrong).withColumn("continent", F.when(F.col("id") != "3", F.col("continent")))
    load = FactLoad(inp.spark, scratch_path(inp.spark, "fact-load"), FactParams(**FIXTURE_PARAMS))
    load.load(stale, side.where(F.month("date") != 2), long_df.where("indicator <> 'O' or month(date) <> 6"), wide_a.where(F.year("date") != 1995), wide_b)
    load.load(cases, side, long_df, wide_a, wide_b)
    return load.fact()


@register("fact_unified", oracle(FACT_BODY, FACT_VIEWS, FACT_CTES))
def fact_unified(inp: Inputs) -> DataFrame:
    return fixture_fact(inp)
