"""File sources (S-1..S-5, S-8): outbreak CSVs and word lists.

CSVs are read by records that may span lines and file splits (``sources.records``), without schema inference (every
column as text), and typed by name afterwards, so a bad value becomes null instead of failing the job (``try_cast``
under ANSI mode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.dates import to_date
from vigil.sources.records import read_csv


# Texts that stand for a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
           "n/a", "nan", "null"]
ORDINAL = "source_ordinal"
_ESCAPE = r"(?s)\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\[nrt\\'\"]|."


def decode_escapes(c: Column) -> Column:
    """``\\xHH``, ``\\uHHHH`` and the escapes of line feed, return, tab, backslash and quotes, decoded."""
    def one(p: Column) -> Column:
        code = F.decode(F.unhex(F.lpad(F.substring(p, 3, 4), 4, "0")), "UTF-16BE")
        plain = F.translate(F.substring(p, 2, 1), "nrt", "\n\r\t")
        return F.when(F.length(p) > 2, code).when(F.length(p) == 2, plain).otherwise(p)

    pieces = F.regexp_extract_all(c, F.lit(_ESCAPE), F.lit(0))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(pieces, one), "")).otherwise(c)


def _csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True, names: Sequence[str] | None = None) -> DataFrame:
    """Every column as text (missing values as null), and ``source_ordinal``: a struct that orders rows as
    they stand in the files (file path, number of the record in the file)."""
    escaped = encoding == "unicode_escape"
    raw = read_csv(spark, path, sep, encoding="ISO-8859-1" if escaped else encoding, header=header)
    have = raw.schema["row"].dataType.names
    names = list(names or have)
    if len(names) != len(have):
        raise ValueError(f"expected {len(names)} columns, got {len(have)}")

    def text(c: str) -> Column:
        t = decode_escapes(F.col("row")[c]) if escaped else F.col("row")[c]
        return F.when(~t.isin(*MISSING), t)

    return raw.select(*(text(c).alias(n) for c, n in zip(have, names)), F.struct("file", F.col("number").alias("row")).alias(ORDINAL))


def _num(col: str) -> Column:
    return F.col(col).try_cast("double")


def read_cases(spark: SparkSession, path: str, sep: str = ",", ordinal: bool = False) -> DataFrame:
    """Cases CSV: first column (whatever its name) -> ``id``; date, location, continent,
    new_cases, new_deaths typed; other columns ignored. ``ordinal`` (here and below) adds the rows' order."""
    raw = _csv(spark, path, sep)
    first = raw.columns[0]
    return raw.select(F.col(first).alias("id"), to_date("date").alias("date"), "location", "continent",
                      _num("new_cases").alias("new_cases"), _num("new_deaths").alias("new_deaths"), *([ORDINAL] if ordinal else []))


def read_vaccinations(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Vaccination CSV: iso_code, date, people_fully_vaccinated (the first column is dropped)."""
    raw = _csv(spark, path, sep)
    return raw.select("iso_code", to_date("date").alias("date"),
                      _num("people_fully_vaccinated").alias("people_fully_vaccinated"))


def read_long_outbreak(spark: SparkSession, path: str, sep: str = ",",
                       columns: Sequence[str] = ("indicator", "country", "date", "value"), encoding: str = "UTF-8",
                       ordinal: bool = False) -> DataFrame:
    """Long CSV (indicator, country, date, value), renamed by position."""
    raw = _csv(spark, path, sep, encoding, names=columns)
    return raw.select("indicator", "country", to_date("date").alias("date"), _num("value").alias("value"), *([ORDINAL] if ordinal else []))


def read_wide_outbreak(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",",
                       encoding: str = "UTF-8", measures: Sequence[str] = ("tt_cases", "tt_deaths"),
                       ordinal: bool = False) -> DataFrame:
    """Wide CSV renamed by position (e.g. country, tt_cases, tt_deaths, date); non-UTF-8 files are decoded
    with ``encoding`` (e.g. ISO-8859-1, or unicode_escape for Latin-1 text with backslash escapes)."""
    raw = _csv(spark, path, sep, encoding, names=columns)
    raw = raw if ordinal else raw.drop(ORDINAL)
    typed = {m: _num(m) for m in raw.columns if m.startswith("tt_") or m in measures}
    typed["date"] = to_date("date")
    return raw.withColumns(typed)


def read_wordlist(spark: SparkSession, path: str, column: str = "token", lower: bool = True) -> DataFrame:
    """One word per line (a header line is not expected); blanks dropped, distinct."""
    w = spark.read.text(path).select(F.trim(F.col("value")).alias(column))
    if lower:
        w = w.select(F.lower(F.col(column)).alias(column))
    return w.where(F.length(column) > 0).distinct()
