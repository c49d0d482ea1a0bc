"""Table and file sinks (K-1..K-7).

The daily marts are written partitioned by date with dynamic partition overwrite, so running a
day twice replaces that day's partition instead of appending duplicates.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.session import materialize
from vigil.sources.records import read_csv


def write_fact(df: DataFrame, path: str | None = None, table: str | None = None, fmt: str = "parquet") -> None:
    """Replace the fact table (a path, or a catalog table)."""
    w = df.write.mode("overwrite").format(fmt)
    if table:
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give a path or a table")


def write_daily(df: DataFrame, path: str | None = None, date_col: str = "date", table: str | None = None,
                fmt: str = "parquet", days: Iterable[date | str] | None = None) -> None:
    """Idempotent daily load: only the days present in ``df`` are replaced, in a path or a catalog table
    (made on the first load, at ``path`` if that is given too; later loads match its columns by name).

    A table has to be partitioned by ``date_col`` alone, else replacing a day would replace more, and the load is refused.
    ``days`` are all days that this load answers for: those without rows in ``df`` are emptied, after the others are written.

    Rows are dealt out by date before the write with a rebalance, which splits a large day into files of
    the advisory size and puts small days together, so a load of many days doesn't write a file for
    each task and day.
    """
    spark = df.sparkSession
    if not path and not table:
        raise ValueError("give a path or a table")
    exists = table is not None and spark.catalog.tableExists(table)
    if exists:
        _check_daily(spark, table, date_col, df.columns)
    gone: list[str] = []
    if days is not None:
        df = materialize(df)
        have = {str(r[0]) for r in df.select(date_col).distinct().collect()}  # at most the days of the load
        gone = sorted({str(d) for d in days} - have)
    rows = df.hint("rebalance", F.col(date_col))
    if table is None:
        (rows.write.mode("overwrite").format(fmt).partitionBy(date_col)
         .option("partitionOverwriteMode", "dynamic").save(path))
    elif not exists:
        w = rows.write.format(fmt).partitionBy(date_col)
        (w.option("path", path) if path else w).saveAsTable(table)
    else:
        key = "spark.sql.sources.partitionOverwriteMode"
        was = spark.conf.get(key)
        spark.conf.set(key, "dynamic")  # an insert takes it from the session only
        try:
            rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(key, was)
    for day in gone:
        if exists:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{date_col}` = '{date.fromisoformat(day)}')")
        where = path if table is None else _location(spark, table) if exists else None
        if where:  # an outside table's files stay when its partition goes
            delete_folder(spark, f"{where}/{date_col}={day}")


def _check_daily(spark: SparkSession, table: str, date_col: str, columns: Sequence[str]) -> None:
    held = spark.catalog.listColumns(table)
    parts = [c.name for c in held if c.isPartition]
    if parts != [date_col]:
        raise ValueError(f"{table} is partitioned by {parts}, not by {date_col}: loading a day would replace other rows")
    if {c.name for c in held} != set(columns):
        raise ValueError(f"columns {list(columns)} don't fit the table's {[c.name for c in held]}")


def _location(spark: SparkSession, table: str) -> str:
    found = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"]
    return found[0]


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def jdbc_write_options(url: str, table: str, user: str | None = None, password: str | None = None,
                       driver: str | None = None, batchsize: int = 10_000,
                       num_partitions: int | None = None, truncate: bool = True) -> dict[str, str]:
    """Options for ``df.write.format("jdbc")``; ``num_partitions`` caps concurrent connections."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": str(truncate).lower()}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kw) -> None:
    """Relational database target (needs the driver jar on the classpath)."""
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **kw)).save()


#: A quote within a text is doubled; texts keep their line breaks and outer blanks.
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_exported_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What ``export`` wrote as CSV, read by all its splits in parallel, with the columns of ``schema`` by name."""
    fields = spark.createDataFrame([], schema).schema.fields
    row = read_csv(spark, path).select("row")
    return row.select(*(F.col("row")[f.name].cast(f.dataType).alias(f.name) for f in fields))


def export(df: DataFrame, path: str, fmt: str = "csv", columns: Sequence[str] | None = None,
           mode: str = "overwrite") -> None:
    """Export chosen columns as CSV (with header; texts with line breaks or quotes are quoted, quotes doubled;
    read it with ``read_exported_csv``) or JSON lines."""
    out = df.select(*columns) if columns else df
    w = out.write.mode(mode)
    if fmt == "csv":
        w.options(header=True, **CSV_TEXT).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)
