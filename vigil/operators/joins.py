"""Join helpers: broadcast only behind a size check.

Sides that are small by construction (the k rows of a top-k, a fixed word list) are broadcast
directly. Other side tables (lexicon, membership lists, dimensions) are measured in bytes first; they
must be cheap to read again (a table, or a result that was checkpointed), since measuring reads them.
Beyond the bound they are joined by shuffle, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """A row's approximate size: the length of its texts, 16 bytes for every column."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    total = F.lit(16 * max(1, len(df.columns))).cast("long")
    for t in texts:
        total = total + t
    return total


def broadcast_if_bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its measured rows have at most ``max_bytes`` bytes, else ``df`` unchanged."""
    n = df.agg(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if n <= max_bytes else df


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """For sides whose size is bounded by construction (``limit(k)``, literals)."""
    return F.broadcast(df)
