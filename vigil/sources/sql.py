"""SQL text as a source (S-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` placeholders are bound to the given DataFrames.

    Catalyst plans it like the DataFrame API (filters and pruning reach the scans).
    """
    return spark.sql(sql, **frames) if frames else spark.sql(sql)


def jdbc_options(url: str, query: str | None = None, table: str | None = None, user: str | None = None,
                 password: str | None = None, driver: str | None = None, fetchsize: int = 10_000,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``. A partition column splits the read into
    ``num_partitions`` parallel range queries instead of one connection reading everything."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query / table")
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if table is None or None in (lower, upper, num_partitions):
            raise ValueError("a partitioned read needs table, bounds and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
