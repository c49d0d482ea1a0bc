"""The driver's parquet tables and the fixture views built over them.

Each view is one SQL text with ``{table}`` placeholders. Spark runs it with
``spark.sql(text, table=DataFrame)`` (no global temp views, so two scale factors can be open in
one session); the DuckDB oracle gets the same text with the placeholders replaced by the names
of its pre-registered views. Measures are summed as DECIMAL so that both engines agree exactly.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; column pruning and filters reach the scan through Catalyst."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


VIEW_SQL: dict[str, str] = {
    # cases source, nation level; measures can be negative; nation 24 gets null continents
    "v_cases": """
SELECT CAST(n.n_nationkey AS STRING) AS id, 'covid' AS category, CAST(o.o_orderdate AS DATE) AS date,
       n.n_name AS country,
       CASE WHEN n.n_nationkey = 24 AND o.o_orderkey % 2 = 0 THEN NULL ELSE r.r_name END AS continent,
       SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS tt_cases,
       SUM(CAST(CASE WHEN o.o_orderstatus = 'F' THEN -o.o_totalprice ELSE o.o_totalprice END AS DECIMAL(18,2))) AS tt_deaths
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2, 3, 4, 5""",
    # dense daily series, region level
    "v_daily": """
SELECT r.r_name AS country, CAST(o.o_orderdate AS DATE) AS date,
       SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS tt_cases,
       SUM(CAST(CASE WHEN o.o_orderstatus = 'F' THEN -o.o_totalprice ELSE o.o_totalprice END AS DECIMAL(18,2))) AS tt_deaths
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2""",
    # vaccination-like side measure with nulls and gaps
    "v_side": """
SELECT CAST(c.c_nationkey AS STRING) AS iso_code, CAST(l.l_shipdate AS DATE) AS date,
       SUM(CAST(CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.l_quantity END AS DECIMAL(18,2))) AS people_fully_vaccinated
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2""",
    # long-format outbreak: indicator, country, date, value
    "v_long": """
SELECT o.o_orderstatus AS indicator, n.n_name AS country, CAST(o.o_orderdate AS DATE) AS date,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS value
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    # prefix dimension: 8 characters, distinct pairs
    "v_dim": """
SELECT DISTINCT substring(n.n_name, 1, 8) AS country, r.r_name AS continent
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    # short daily series for forecasts (g, ds, y)
    "v_series": """
SELECT event_type AS g, CAST(ts AS DATE) AS ds, SUM(CAST(value AS DECIMAL(18,2))) AS y FROM {events} GROUP BY 1, 2""",
    # posts (one a document, over some ten weeks) with the markers that cleaning removes and the attributes the predicates need
    "v_posts": """
SELECT d.doc_id AS post_id, d.ts AS ts, CAST(d.ts AS DATE) AS date,
       concat('RT @', d.source, ': #', d.text, CASE WHEN d.doc_id % 13 = 0 THEN ' Phone 555' ELSE '' END, CASE WHEN d.doc_id % 2 = 0 THEN concat(' https://t.co/', CAST(d.doc_id AS STRING)) ELSE '' END) AS tweet,
       d.lang AS language, d.source AS username, CASE d.doc_id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE 'purchase' END AS source,
       CASE WHEN d.doc_id % 6 = 0 THEN concat('src', CAST(d.doc_id % 20 AS STRING)) ELSE NULL END AS to_user,
       split(concat(d.source, ',src', CAST(d.doc_id % 9 AS STRING)), ',') AS mentions,
       concat('NATION_', CAST(d.doc_id % 25 AS STRING)) AS place,
       CAST(d.doc_id % 120 - 60 AS DOUBLE) AS lat, CAST(d.doc_id % 300 - 150 AS DOUBLE) AS lon,
       d.doc_id % 3 AS n_images, d.doc_id % 4 AS n_videos, CASE WHEN d.doc_id % 2 = 0 THEN 1 ELSE 0 END AS n_urls,
       d.doc_id % 7 = 0 AS verified, d.doc_id % 5 = 0 AS is_retweet, d.doc_id % 8 = 0 AS is_reply,
       d.n_chars % 100 AS likes, d.doc_id % 37 AS retweets, d.doc_id % 11 AS replies
FROM (SELECT *, CAST('2023-12-15 00:00:00' AS TIMESTAMP) + INTERVAL '1' MINUTE * (doc_id * 9973 % 100000) AS ts FROM {documents}) d""",
    # list membership for the semi-join predicate
    "v_list": """
SELECT DISTINCT source AS username, 'list_a' AS list_id FROM {documents} WHERE source < 'src15'""",
    # wide outbreak A (country, tt_cases, tt_deaths, date) with one 'Grand Total' row per date
    "v_wide_a": """
SELECT n.n_name AS country, SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS tt_cases,
       SUM(CAST(l.l_tax AS DECIMAL(18,2))) AS tt_deaths, CAST(l.l_shipdate AS DATE) AS date, MIN(l.l_orderkey) AS source_ordinal
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name, CAST(l.l_shipdate AS DATE)
UNION ALL
SELECT 'Grand Total' AS country, SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS tt_cases,
       SUM(CAST(l.l_tax AS DECIMAL(18,2))) AS tt_deaths, CAST(l.l_shipdate AS DATE) AS date, MIN(l.l_orderkey) AS source_ordinal
FROM {lineitem} l GROUP BY CAST(l.l_shipdate AS DATE)""",
    # wide outbreak B (date, country, tt_cases, tt_deaths, tt_recovery)
    "v_wide_b": """
SELECT CAST(l.l_shipdate AS DATE) AS date, n.n_name AS country,
       SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS tt_cases,
       SUM(CAST(l.l_discount AS DECIMAL(18,2))) AS tt_deaths,
       SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS tt_recovery, MIN(l.l_orderkey) AS source_ordinal
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def view_tables(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(VIEW_SQL[name])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a lazy DataFrame over the parquet tables."""
    frames = {t: table(spark, sf_dir, t) for t in view_tables(name)}
    return spark.sql(VIEW_SQL[name], **frames)


@lru_cache(maxsize=None)
def view_sql_plain(name: str) -> str:
    """The view text with plain table names (for DuckDB)."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEW_SQL[name]).strip()


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the view definitions it uses, as CTEs."""
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({view_sql_plain(n)})" for n in names)
    return f"WITH {ctes}\n{sql.strip()}"


class Inputs:
    """Lazy access to tables and views of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)
