"""Stored posts as a source (S-6): the crawl re-aimed as a scan with pushed predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.operators.search import PostFilter, search_posts


def scan_posts(spark: SparkSession, path: str, f: PostFilter, lists: DataFrame | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Read a posts table and apply the filter; Catalyst pushes the comparisons into the scan and
    prunes ``date=`` partitions when the table is partitioned by date."""
    return search_posts(spark.read.format(fmt).load(path), f, lists)
