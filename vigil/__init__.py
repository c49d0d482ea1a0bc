"""vigil: outbreak-series and short-post analytics expressed as Spark DataFrame / SQL jobs.

Layout
------
sources/    readers (CSV, Parquet, SQL, posts scan, word lists) and the fixture views
functions/  Column -> Column helpers (text cleaning, tokens, n-grams, dates, geo)
operators/  DataFrame -> DataFrame operators (shape, filters, joins, series, aggregates,
            n-grams, sentiment, forecast, regression, post search)
plans/      composed jobs (unified fact, posts mart, analysis) and the query catalog
sinks/      table / file writers
streaming/  incremental form of the daily posts load

Every operator is a pure function usable with ``DataFrame.transform``; none runs an action
except where noted (size checks before a broadcast, and the sinks).
"""

__all__ = ["session"]
