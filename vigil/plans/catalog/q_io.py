"""Sources and sinks as round trips through the shared folder (S-1..S-5, S-8, K-1..K-4, K-6, K-7).

Each query lands data derived from the driver's tables in the format the reader/writer handles,
reads it back with the library and is compared with the SQL of the data it started from.
Every call writes to a new folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.plans.catalog.base import oracle, register
from vigil.plans.catalog.q_posts import MART_SQL, WINDOW_POSTS, posts_outputs
from vigil.plans.catalog.q_text import BIGRAM_COUNTS, FILTERED, TRIGRAM_COUNTS
from vigil.session import materialize, scratch_path
from vigil.sinks.tables import CSV_TEXT, export, read_exported_csv, write_daily, write_fact
from vigil.sources.files import (read_cases, read_long_outbreak, read_vaccinations, read_wide_outbreak,
                                 read_wordlist)
from vigil.sources.tables import Inputs

D = "CAST({0} AS DOUBLE) AS {0}".format


def _write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """Texts with separators, quotes or line breaks in quotes, quotes doubled, as the source's files have them."""
    df.write.mode("overwrite").options(header=True, sep=sep, encoding=encoding, **CSV_TEXT).csv(path)


#: A text with doubled quotes, both separators, a line break and a backslash before the closing quote.
def _hard(column: str) -> Column:
    return F.concat(F.col(column), F.lit(' "the, best"; of\ntwo lines\\'))


_HARD_SQL = "{0} || ' \"the, best\"; of' || chr(10) || 'two lines' || chr(92)"


@register("src_cases_csv", oracle(f"SELECT id, date, {_HARD_SQL.format('country')} AS location, continent, "
                                  "CAST(tt_cases AS DOUBLE) AS new_cases, CAST(tt_deaths AS DOUBLE) AS new_deaths "
                                  "FROM v_cases", ["v_cases"]))
def src_cases_csv(inp: Inputs) -> DataFrame:
    """Source layout: iso code first, then date, location, continent, the measures and a column
    the reader ignores."""
    path = scratch_path(inp.spark, "cases-csv")
    c = inp.view("v_cases")
    _write_csv(c.select(F.col("id").alias("iso_code"), "date", _hard("country").alias("location"), "continent",
                        F.col("tt_cases").alias("new_cases"), F.col("tt_deaths").alias("new_deaths"),
                        F.lit("x").alias("tests_units")), path)
    return read_cases(inp.spark, path)


@register("src_vaccinations_csv", oracle(f"SELECT iso_code, date, {D('people_fully_vaccinated')} FROM v_side",
                                         ["v_side"]))
def src_vaccinations_csv(inp: Inputs) -> DataFrame:
    path = scratch_path(inp.spark, "vacc-csv")
    s = inp.view("v_side")
    _write_csv(s.select(_hard("iso_code").alias("location"), "iso_code", "date",
                        F.lit(1).alias("total_vaccinations"), "people_fully_vaccinated"), path)
    return read_vaccinations(inp.spark, path)


@register("src_long_csv", oracle(f"SELECT indicator, {_HARD_SQL.format('country')} AS country, date, {D('value')} FROM v_long", ["v_long"]))
def src_long_csv(inp: Inputs) -> DataFrame:
    path = scratch_path(inp.spark, "long-csv")
    lg = inp.view("v_long").withColumn("country", _hard("country")).toDF("Indicator", "Country", "Date", "Value")
    _write_csv(lg, path, sep=";")
    return read_long_outbreak(inp.spark, path, sep=";")


@register("src_encoded_csv", oracle("SELECT replace(country, 'NATION', 'NAÇÃO \"漢\"' || chr(10)) AS country, "
                                    f"{D('tt_cases')}, {D('tt_deaths')}, date FROM v_wide_a", ["v_wide_a"]))
def src_encoded_csv(inp: Inputs) -> DataFrame:
    """A Latin-1 file with accented names, other characters and line breaks as backslash escapes, and quotes."""
    path = scratch_path(inp.spark, "latin1-csv")
    w = inp.view("v_wide_a").drop("source_ordinal").withColumn("country", F.replace("country", F.lit("NATION"), F.lit('NAÇ\\xC3O "\\u6f22"\\n')))
    _write_csv(w, path, encoding="ISO-8859-1")
    return read_wide_outbreak(inp.spark, path, ["country", "tt_cases", "tt_deaths", "date"], encoding="unicode_escape")


@register("src_latin_csv", oracle("SELECT replace(country, 'NATION', 'NAÇÃO \"x\"' || chr(10)) AS country, "
                                  f"{D('tt_cases')}, {D('tt_deaths')}, date FROM v_wide_a", ["v_wide_a"]))
def src_latin_csv(inp: Inputs) -> DataFrame:
    """A Latin-1 file whose accented names hold quotes and line breaks, decoded with the file's encoding."""
    path = scratch_path(inp.spark, "latin1-csv")
    w = inp.view("v_wide_a").drop("source_ordinal").withColumn("country", F.replace("country", F.lit("NATION"), F.lit('NAÇÃO "x"\n')))
    _write_csv(w, path, encoding="ISO-8859-1")
    return read_wide_outbreak(inp.spark, path, ["country", "tt_cases", "tt_deaths", "date"], encoding="ISO-8859-1")


@register("src_positional_csv", oracle(f"SELECT date, {_HARD_SQL.format('country')} AS country, {D('tt_cases')}, {D('tt_deaths')}, "
                                       f"{D('tt_recovery')} FROM v_wide_b", ["v_wide_b"]))
def src_positional_csv(inp: Inputs) -> DataFrame:
    """Header names differ from ours; columns are taken by position."""
    path = scratch_path(inp.spark, "positional-csv")
    _write_csv(inp.view("v_wide_b").drop("source_ordinal").withColumn("country", _hard("country")).toDF("Date", "Country/Region", "Cases", "Deaths", "Recovered"), path)
    return read_wide_outbreak(inp.spark, path, ["date", "country", "tt_cases", "tt_deaths", "tt_recovery"])


@register("src_wordlist", oracle("SELECT DISTINCT lower(source) AS token FROM documents"))
def src_wordlist(inp: Inputs) -> DataFrame:
    """One word per line with case variants, padding and blank lines."""
    path = scratch_path(inp.spark, "wordlist")
    d = inp.table("documents")
    lines = d.select(F.concat(F.lit("  "), F.upper("source")).alias("value")).unionByName(
        d.select(F.lit("").alias("value")))
    lines.write.mode("overwrite").text(path)
    return read_wordlist(inp.spark, path)


@register("sink_fact_roundtrip", oracle(f"SELECT id, category, date, country, continent, {D('tt_cases')}, "
                                        f"{D('tt_deaths')} FROM v_cases", ["v_cases"]))
def sink_fact_roundtrip(inp: Inputs) -> DataFrame:
    path = scratch_path(inp.spark, "fact")
    write_fact(inp.view("v_cases"), path)
    write_fact(inp.view("v_cases"), path)  # replace, not append
    return inp.spark.read.parquet(path)


def _daily_loads(inp: Inputs, mart: DataFrame, name: str, stale: Column) -> DataFrame:
    """A catalog table of several days, loaded day by day: all days with wrong rows and one day too many, then each day's own
    rows, by which the others must stay, then a load for the day too many, which has no rows."""
    path = scratch_path(inp.spark, name)
    table = f"vigil_{os.path.basename(path).replace('-', '_')}"
    mart = materialize(mart)
    days = sorted(r[0] for r in mart.select("date").distinct().collect())
    wrong = mart.withColumn(mart.columns[0], stale)
    extra = mart.withColumn("date", F.lit("1999-12-31").cast("date"))
    write_daily(wrong.unionByName(extra), path, table=table)
    half = len(days) // 2
    for some in (days[:half], days[half:]):
        write_daily(mart.where(F.col("date").isin(some)), table=table, days=some)
    write_daily(mart.limit(0), table=table, days=["1999-12-31"])
    return inp.spark.read.parquet(path)


@register("sink_posts_roundtrip", MART_SQL)
def sink_posts_roundtrip(inp: Inputs) -> DataFrame:
    return _daily_loads(inp, posts_outputs(inp, ngrams=False)[0], "posts-mart", -F.col("post_id"))


def _two_days(marts: DataFrame) -> DataFrame:
    """The mart and, as the day before's, its first ten n-grams."""
    return marts.unionByName(marts.orderBy(F.desc("total"), "words").limit(10).withColumn("date", F.date_sub("date", 1)))


def _two_days_sql(counts: str, day: str) -> str:
    return (f"SELECT words, total, DATE '{day}' AS date FROM (SELECT * FROM {counts} ORDER BY total DESC, words LIMIT 20) x UNION ALL "
            f"SELECT words, total, DATE '{day}' - 1 AS date FROM (SELECT * FROM {counts} ORDER BY total DESC, words LIMIT 10) y")


@register("sink_bigrams_roundtrip", oracle(_two_days_sql("bigram_counts", "2024-01-01"), ["v_posts"], [WINDOW_POSTS, FILTERED, BIGRAM_COUNTS]))
def sink_bigrams_roundtrip(inp: Inputs) -> DataFrame:
    return _daily_loads(inp, _two_days(posts_outputs(inp)[1]), "bigrams", F.lit("wrong"))


@register("sink_trigrams_roundtrip", oracle(_two_days_sql("trigram_counts", "2024-01-31"), ["v_posts"], [WINDOW_POSTS, FILTERED, TRIGRAM_COUNTS]))
def sink_trigrams_roundtrip(inp: Inputs) -> DataFrame:
    return _daily_loads(inp, _two_days(posts_outputs(inp)[2]), "trigrams", F.lit("wrong"))


@register("sink_csv_roundtrip", oracle("SELECT post_id, username, tweet FROM v_posts", ["v_posts"]))
def sink_csv_roundtrip(inp: Inputs) -> DataFrame:
    """The exported posts with their texts (line breaks, quotes, separators), read back by the library."""
    path = scratch_path(inp.spark, "export-csv")
    export(inp.view("v_posts"), path, "csv", ["post_id", "username", "tweet"])
    return read_exported_csv(inp.spark, path, "post_id bigint, username string, tweet string")


@register("sink_json_roundtrip", oracle("SELECT post_id, username FROM v_posts", ["v_posts"]))
def sink_json_roundtrip(inp: Inputs) -> DataFrame:
    path = scratch_path(inp.spark, "export-json")
    export(inp.view("v_posts"), path, "json", ["post_id", "username"])
    return inp.spark.read.schema("post_id bigint, username string").json(path)
