"""Small helpers of the llm jobs."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import scratch_path, ship_package

#: Rows of an Arrow batch: with texts of up to some 100 KB a batch stays at some tens of MB.
BATCH_ROWS = 512
#: Largest table, in bytes, that is sent to every executor.
BROADCAST_BYTES = 32 << 20


def python_ready(spark: SparkSession) -> None:
    """The package on the workers, and Arrow batches of a bounded size."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage, survives the loss
    of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value).cast("long"), F.lit(0).cast("long")) + F.lit(16)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda n, x: n + _bytes_of(x, kind.elementType)), F.lit(16).cast("long"))
    if isinstance(kind, T.StructType):
        return reduce(add, [_bytes_of(value[f.name], f.dataType) for f in kind.fields], F.lit(16).cast("long"))
    return F.lit(16).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """The rows' bytes: of all texts, and 16 for every value. Reads ``df``, so give it a stored table."""
    total = reduce(add, [_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    return df.agg(F.sum(total)).first()[0] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``broadcast(df)`` if its measured bytes allow it, else ``df``."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): connected components of an undirected edge table, by the least node.

    Every step gives a node the least label among its own and its neighbours', then the label of that
    label, so a chain of n links takes some log n steps. One row per node and partition is shuffled
    (minima are taken before the shuffle); labels are stored at each step, nothing is collected.
    """
    edges = stored(links.select(F.col(a).alias("v"), F.col(b).alias("u"))
                   .unionByName(links.select(F.col(b).alias("v"), F.col(a).alias("u"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("v").alias("node"))
                    .agg(F.least(F.col("node"), F.min("u")).alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("u"), "label")
        near = (edges.join(seen, "u").groupBy(F.col("v").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"),
                                                F.least("label", "near").alias("to"))
        far = labels.select(F.col("node").alias("to"), F.col("label").alias("jump"))
        new = stored(step.join(far, "to").select("node", "was", F.least("to", "jump").alias("label")), "labels")
        if new.filter("was <> label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


__all__ = ["BATCH_ROWS", "BROADCAST_BYTES", "broadcast_if_small", "components", "measured_bytes", "python_ready", "scratch_path", "stored"]
