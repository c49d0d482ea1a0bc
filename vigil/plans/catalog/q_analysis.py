"""Analysis queries: SQL aggregate, totals, top-k, series of the top countries (G-2, G-3, G-8,
O-1, O-2, W-2, L-7, J-6, F-8, S-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.aggregate import group_sum, joined_values, unique_values
from vigil.operators.forecast import (backtest_linear_weekly, forecast_chart_data, forecast_changepoint, forecast_linear_weekly,
                                      forecast_sparse_changepoint, future_spine, to_series, z_value)
from vigil.operators.lookup import attach_side_measure, semi_join_keys
from vigil.operators.regress import ols, ols_fitted
from vigil.plans.analysis import METRICS, analysis_series, top_countries, top_country_series
from vigil.plans.catalog.base import oracle, register
from vigil.sources.sql import read_sql
from vigil.sources.tables import Inputs

# ---- shared oracle CTEs -------------------------------------------------------------------------
COVID_FACT = ("covid_fact", """
SELECT c.id, c.category, c.date, c.country, c.continent, c.tt_cases, c.tt_deaths, s.iso_code, s.people_fully_vaccinated
FROM v_cases c LEFT JOIN (SELECT iso_code, date AS s_date, COALESCE(people_fully_vaccinated, 0) AS people_fully_vaccinated
                          FROM v_side) s
  ON c.date IS NOT DISTINCT FROM s.s_date AND c.id IS NOT DISTINCT FROM s.iso_code""")
SERIES = ("series", """
SELECT date, country, COALESCE(SUM(tt_cases), 0) AS tt_cases, COALESCE(SUM(tt_deaths), 0) AS tt_deaths,
       COALESCE(SUM(people_fully_vaccinated), 0) AS tt_vaccine
FROM covid_fact WHERE category = 'covid' GROUP BY 1, 2""")
TOP5 = ("top5", """
SELECT country, total, row_number() OVER (ORDER BY total DESC, country) AS contador
FROM (SELECT country, SUM(tt_cases) AS total FROM series GROUP BY 1 ORDER BY total DESC, country LIMIT 5) t""")
TOP5_SERIES = ("top5_series", """
SELECT s.*, t.contador FROM series s JOIN top5 t ON s.country = t.country""")
ANALYSIS_VIEWS = ("v_cases", "v_side")
ANALYSIS_CTES = (COVID_FACT, SERIES)
SERIES_COLS = "date, country, CAST(tt_cases AS DOUBLE) AS tt_cases, CAST(tt_deaths AS DOUBLE) AS tt_deaths, " \
              "CAST(tt_vaccine AS DOUBLE) AS tt_vaccine"


def covid_fact(inp: Inputs) -> DataFrame:
    """Covid part of the fact table: cases with the vaccination side measure (J-4)."""
    return attach_side_measure(inp.view("v_cases"), inp.view("v_side"), ["date", "id"],
                               ["date", "iso_code"], ["people_fully_vaccinated"])


def series(inp: Inputs, stage: bool = True) -> DataFrame:
    """Staged where a query draws on it more than once."""
    return analysis_series(covid_fact(inp), stage)


@register("src_sql_query", oracle("""
SELECT date, country, CAST(SUM(tt_cases) AS DOUBLE) AS tt_cases, CAST(SUM(tt_deaths) AS DOUBLE) AS tt_deaths,
       CAST(SUM(people_fully_vaccinated) AS DOUBLE) AS people_fully_vaccinated
FROM covid_fact WHERE category = 'covid' GROUP BY 1, 2 ORDER BY 1, 2""", ANALYSIS_VIEWS, [COVID_FACT]))
def src_sql_query(inp: Inputs) -> DataFrame:
    """SQL text of a user's own over a fact table."""
    return read_sql(inp.spark, """
        SELECT f.date, f.country, sum(f.tt_cases) AS tt_cases, sum(f.tt_deaths) AS tt_deaths,
               sum(f.people_fully_vaccinated) AS people_fully_vaccinated
        FROM {fact} f WHERE f.category = 'covid' GROUP BY f.date, f.country ORDER BY f.date, f.country""",
                    fact=covid_fact(inp))


@register("agg_daily_country", oracle(f"SELECT {SERIES_COLS} FROM series", ANALYSIS_VIEWS, ANALYSIS_CTES))
def agg_daily_country(inp: Inputs) -> DataFrame:
    return series(inp, stage=False)


@register("sort_daily", oracle(f"SELECT {SERIES_COLS} FROM series ORDER BY date, country",
                               ANALYSIS_VIEWS, ANALYSIS_CTES))
def sort_daily(inp: Inputs) -> DataFrame:
    return series(inp, stage=False).orderBy("date", "country")


@register("agg_country_total", oracle("""
SELECT country, CAST(SUM(tt_cases) AS DOUBLE) AS tt_cases, CAST(SUM(tt_deaths) AS DOUBLE) AS tt_deaths,
       CAST(SUM(tt_vaccine) AS DOUBLE) AS tt_vaccine
FROM series GROUP BY country""", ANALYSIS_VIEWS, ANALYSIS_CTES))
def agg_country_total(inp: Inputs) -> DataFrame:
    return group_sum(series(inp, stage=False), ["country"], list(METRICS))


@register("topk_countries", oracle("SELECT country, CAST(total AS DOUBLE) AS total FROM top5",
                                   ANALYSIS_VIEWS, ANALYSIS_CTES + (TOP5,)))
def topk_countries(inp: Inputs) -> DataFrame:
    return top_countries(series(inp, stage=False), 5).select("country", "total")


@register("topk_rank", oracle("SELECT country, CAST(total AS DOUBLE) AS total, CAST(contador AS BIGINT) AS contador "
                              "FROM top5", ANALYSIS_VIEWS, ANALYSIS_CTES + (TOP5,)))
def topk_rank(inp: Inputs) -> DataFrame:
    return top_countries(series(inp, stage=False), 5)


@register("topk_series", oracle(f"SELECT {SERIES_COLS}, CAST(contador AS BIGINT) AS contador FROM top5_series",
                                ANALYSIS_VIEWS, ANALYSIS_CTES + (TOP5, TOP5_SERIES)))
def topk_series(inp: Inputs) -> DataFrame:
    return top_country_series(series(inp), 5)


@register("topk_null_key", oracle("""
SELECT country, CAST(SUM(tt_cases) AS DOUBLE) AS total, row_number() OVER (ORDER BY SUM(tt_cases) DESC, country) AS contador
FROM (SELECT CASE WHEN country = 'NATION_3' THEN NULL ELSE country END AS country, tt_cases FROM series) s
WHERE country IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 24""", ANALYSIS_VIEWS, ANALYSIS_CTES))
def topk_null_key(inp: Inputs) -> DataFrame:
    """One country's name is missing: its rows take no rank."""
    s = series(inp, stage=False).withColumn("country", F.when(F.col("country") != "NATION_3", F.col("country")))
    return top_countries(s, 24)


@register("filter_rank", oracle(f"SELECT {SERIES_COLS}, CAST(contador AS BIGINT) AS contador FROM top5_series "
                                "WHERE contador = 3", ANALYSIS_VIEWS, ANALYSIS_CTES + (TOP5, TOP5_SERIES)))
def filter_rank(inp: Inputs) -> DataFrame:
    return top_country_series(series(inp), 5).where(F.col("contador") == 3)


@register("join_semi_topk", oracle(f"SELECT {SERIES_COLS} FROM series WHERE country IN (SELECT country FROM top5)",
                                   ANALYSIS_VIEWS, ANALYSIS_CTES + (TOP5,)))
def join_semi_topk(inp: Inputs) -> DataFrame:
    s = series(inp)
    return semi_join_keys(s, top_countries(s, 5).select("country"), "country", bounded=True)


@register("agg_unique_values", oracle("SELECT DISTINCT country FROM series WHERE country IS NOT NULL", ANALYSIS_VIEWS, ANALYSIS_CTES))
def agg_unique_values(inp: Inputs) -> DataFrame:
    return unique_values(series(inp, stage=False), "country")


@register("agg_joined_values", oracle("SELECT string_agg(country, ',' ORDER BY country) AS country_values "
                                      "FROM (SELECT DISTINCT country FROM top5_series) t",
                                      ANALYSIS_VIEWS, ANALYSIS_CTES + (TOP5, TOP5_SERIES)))
def agg_joined_values(inp: Inputs) -> DataFrame:
    return joined_values(top_country_series(series(inp), 5), "country")


# ---- forecasts (F-5, F-5a, F-5b, F-11) -----------------------------------------------------------

Z95 = repr(z_value(0.95))


def forecast_ctes(src: str, keys: list[str], horizon: int = 60, p: str = "f") -> list[tuple[str, str]]:
    """DuckDB spelling of forecast_linear_weekly over a (keys..., ds, y) relation."""
    k = ", ".join(keys)

    def on(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{x} = {b}.{x}" for x in keys)

    def q(a: str) -> str:
        return ", ".join(f"{a}.{x}" for x in keys)

    t = "CAST(date_diff('day', DATE '1970-01-01', {0}) AS DOUBLE)".format
    return [
        (f"{p}_s", f"SELECT {k}, ds, CAST(y AS DOUBLE) AS y, {t('ds')} AS t, isodow(ds) AS wd FROM {src}"),
        (f"{p}_p", f"SELECT {k}, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, max(ds) AS last_ds "
                   f"FROM {p}_s GROUP BY {k}"),
        (f"{p}_r", f"SELECT {q('s')}, s.wd, s.y - (p.a + p.b * s.t) AS r FROM {p}_s s JOIN {p}_p p ON {on('s', 'p')}"),
        (f"{p}_se", f"SELECT {k}, wd, avg(r) AS sv FROM {p}_r GROUP BY {k}, wd"),
        (f"{p}_sg", f"SELECT {q('r')}, stddev_samp(r.r - se.sv) AS sigma FROM {p}_r r JOIN {p}_se se "
                    f"ON {on('r', 'se')} AND r.wd = se.wd GROUP BY {q('r')}"),
        (f"{p}_spine", f"SELECT DISTINCT {k}, ds FROM {p}_s UNION ALL "
                       f"SELECT {q('p')}, CAST(p.last_ds + CAST(i.i AS INTEGER) AS DATE) AS ds "
                       f"FROM {p}_p p, range(1, {horizon + 1}) i(i)"),
        (f"{p}_yh", f"SELECT {q('sp')}, sp.ds, p.a + p.b * {t('sp.ds')} + COALESCE(se.sv, 0.0) AS yh, sg.sigma "
                    f"FROM {p}_spine sp JOIN {p}_p p ON {on('sp', 'p')} "
                    f"LEFT JOIN {p}_se se ON {on('sp', 'se')} AND se.wd = isodow(sp.ds) "
                    f"LEFT JOIN {p}_sg sg ON {on('sp', 'sg')}"),
        (f"{p}_out", f"SELECT {k}, ds, round(yh, 4) AS yhat, round(yh - {Z95} * sigma, 4) AS yhat_lower, "
                     f"round(yh + {Z95} * sigma, 4) AS yhat_upper FROM {p}_yh"),
    ]


def v_series(inp: Inputs) -> DataFrame:
    return inp.view("v_series")


@register("future_spine", oracle("""
SELECT g, ds FROM (SELECT DISTINCT g, ds FROM v_series) h
UNION ALL
SELECT g, CAST(last_ds + CAST(i.i AS INTEGER) AS DATE) AS ds
FROM (SELECT g, max(ds) AS last_ds FROM v_series GROUP BY g) p, range(1, 61) i(i)""", ["v_series"]))
def future_spine_q(inp: Inputs) -> DataFrame:
    return future_spine(v_series(inp), ["g"], "ds", 60)


@register("forecast_linear_weekly", oracle("SELECT g, ds, yhat, yhat_lower, yhat_upper FROM f_out", ["v_series"],
                                           forecast_ctes("v_series", ["g"])))
def forecast_linear_weekly_q(inp: Inputs) -> DataFrame:
    return forecast_linear_weekly(v_series(inp), ["g"], "ds", "y", 60, 0.95)


@register("forecast_chart_data", oracle("""
SELECT o.g, o.ds, o.yhat, o.yhat_lower, o.yhat_upper, CAST(v.y AS DOUBLE) AS y
FROM f_out o LEFT JOIN v_series v ON o.g = v.g AND o.ds = v.ds""", ["v_series"], forecast_ctes("v_series", ["g"])))
def forecast_chart_data_q(inp: Inputs) -> DataFrame:
    s = v_series(inp)
    return forecast_chart_data(s, forecast_linear_weekly(s, ["g"]), ["g"])


UNPIVOTED = ("top5_long", """
SELECT country, metric, date AS ds, CAST(y AS DOUBLE) AS y
FROM (UNPIVOT (SELECT country, date, tt_cases, tt_deaths, tt_vaccine FROM top5_series)
      ON tt_cases, tt_deaths, tt_vaccine INTO NAME metric VALUE y) u""")
TOP5_CTES = ANALYSIS_CTES + (TOP5, TOP5_SERIES, UNPIVOTED)


def top5_long(inp: Inputs) -> DataFrame:
    return to_series(top_country_series(series(inp), 5), ["country"], "date", list(METRICS))


@register("series_unpivot", oracle("SELECT country, metric, ds, y FROM top5_long", ANALYSIS_VIEWS, TOP5_CTES))
def series_unpivot(inp: Inputs) -> DataFrame:
    return top5_long(inp)


@register("forecast_top_countries", oracle("SELECT country, metric, ds, yhat, yhat_lower, yhat_upper FROM f_out",
                                           ANALYSIS_VIEWS,
                                           TOP5_CTES + tuple(forecast_ctes("top5_long", ["country", "metric"]))))
def forecast_top_countries(inp: Inputs) -> DataFrame:
    return forecast_linear_weekly(top5_long(inp), ["country", "metric"], "ds", "y", 60, 0.95, few_series=True)


@register("forecast_changepoint", note="per-series numpy fit in applyInPandas; rows-only check")
def forecast_changepoint_q(inp: Inputs) -> DataFrame:
    return forecast_changepoint(top5_long(inp), ["country", "metric"], "ds", "y", 60, 0.95)


@register("forecast_sparse", note="per-series numpy fit in applyInPandas, seeded simulations; rows-only check")
def forecast_sparse_q(inp: Inputs) -> DataFrame:
    """The chosen change points' trend, season and simulated band of the top countries' series."""
    return forecast_sparse_changepoint(top5_long(inp), ["country", "metric"], "ds", "y", 60, 0.95)


BACKTEST_CTES = [
    ("bt_span", "SELECT g, min(ds) AS first_ds, max(ds) AS last_ds FROM v_series GROUP BY g"),
    ("bt_cuts", "SELECT g, CAST(last_ds - CAST(i.i * 5 AS INTEGER) AS DATE) AS cut FROM bt_span, range(1, 5) i(i) "
                "WHERE date_diff('day', first_ds, CAST(last_ds - CAST(i.i * 5 AS INTEGER) AS DATE)) + 1 >= 14"),
    ("bt_train", "SELECT s.g, c.cut, s.ds, s.y FROM v_series s JOIN bt_cuts c ON s.g = c.g AND s.ds <= c.cut"),
]


@register("forecast_backtest", oracle("""
SELECT s.g, CAST(date_diff('day', c.cut, s.ds) AS BIGINT) AS horizon, count(*) AS n, round(avg(abs(s.y - f.yh)), 4) AS mae, round(sqrt(avg((s.y - f.yh) * (s.y - f.yh))), 4) AS rmse,
       round(avg(CASE WHEN abs(s.y - f.yh) <= """ + Z95 + """ * f.sigma THEN 1.0 ELSE 0.0 END), 4) AS coverage
FROM (SELECT g, ds, CAST(y AS DOUBLE) AS y FROM v_series) s JOIN bt_cuts c ON s.g = c.g JOIN b_yh f ON f.g = c.g AND f.cut = c.cut AND f.ds = s.ds
WHERE s.ds > c.cut GROUP BY 1, 2""", ["v_series"], [*BACKTEST_CTES, *forecast_ctes("bt_train", ["g", "cut"], horizon=10, p="b")]))
def forecast_backtest(inp: Inputs) -> DataFrame:
    """Errors of the linear model by horizon, over four cut-off days of every series."""
    return backtest_linear_weekly(v_series(inp), ["g"], "ds", "y", cutoffs=4, step=5, horizon=10, least_days=14)


# ---- regressions (F-6, F-7, F-11) ----------------------------------------------------------------

def _ols_sql(x: str) -> str:
    return f"""
SELECT country, round(regr_slope(CAST(tt_cases AS DOUBLE), CAST({x} AS DOUBLE)), 4) AS slope,
       round(regr_intercept(CAST(tt_cases AS DOUBLE), CAST({x} AS DOUBLE)), 4) AS intercept,
       round(regr_r2(CAST(tt_cases AS DOUBLE), CAST({x} AS DOUBLE)), 4) AS r2,
       CAST(regr_count(CAST(tt_cases AS DOUBLE), CAST({x} AS DOUBLE)) AS BIGINT) AS n
FROM top5_series GROUP BY country"""


def _fitted_sql(x: str, label: str | None = None) -> str:
    lab = f"'{label}' AS predictor, " if label else ""
    return f"""
SELECT {lab}s.country, s.date, CAST(s.{x} AS DOUBLE) AS x, CAST(s.tt_cases AS DOUBLE) AS y,
       round(c.a + c.b * CAST(s.{x} AS DOUBLE), 4) AS y_hat
FROM top5_series s JOIN (SELECT country, regr_slope(CAST(tt_cases AS DOUBLE), CAST({x} AS DOUBLE)) AS b,
                                regr_intercept(CAST(tt_cases AS DOUBLE), CAST({x} AS DOUBLE)) AS a
                         FROM top5_series GROUP BY country) c ON s.country = c.country"""


REG_CTES = ANALYSIS_CTES + (TOP5, TOP5_SERIES)


@register("ols_cases_deaths", oracle(_ols_sql("tt_deaths"), ANALYSIS_VIEWS, REG_CTES))
def ols_cases_deaths(inp: Inputs) -> DataFrame:
    return ols(top_country_series(series(inp), 5), ["country"], "tt_cases", "tt_deaths")


@register("ols_cases_vaccine", oracle(_ols_sql("tt_vaccine"), ANALYSIS_VIEWS, REG_CTES))
def ols_cases_vaccine(inp: Inputs) -> DataFrame:
    return ols(top_country_series(series(inp), 5), ["country"], "tt_cases", "tt_vaccine")


@register("ols_fitted", oracle(_fitted_sql("tt_deaths"), ANALYSIS_VIEWS, REG_CTES))
def ols_fitted_q(inp: Inputs) -> DataFrame:
    return ols_fitted(top_country_series(series(inp), 5), ["country"], "tt_cases", "tt_deaths", keep=["date"], few_groups=True)


@register("ols_chart_data", oracle(_fitted_sql("tt_deaths", "deaths") + "\nUNION ALL\n"
                                   + _fitted_sql("tt_vaccine", "vaccines"), ANALYSIS_VIEWS, REG_CTES))
def ols_chart_data(inp: Inputs) -> DataFrame:
    top = top_country_series(series(inp), 5)
    deaths = ols_fitted(top, ["country"], "tt_cases", "tt_deaths", keep=["date"], few_groups=True)
    vacc = ols_fitted(top, ["country"], "tt_cases", "tt_vaccine", keep=["date"], few_groups=True)
    return (deaths.select(F.lit("deaths").alias("predictor"), "*")
            .unionByName(vacc.select(F.lit("vaccines").alias("predictor"), "*")))
