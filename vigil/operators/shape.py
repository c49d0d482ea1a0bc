"""Projections, renames, conditional columns and row filters (P-*, L-*).

Each is a narrow transformation (no shuffle) except ``drop_keys_with_null``, which needs the set of
bad keys first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.joins import BROADCAST_BYTES, broadcast_if_bounded
from vigil.session import materialize


def tag(df: DataFrame, value: str, name: str = "category") -> DataFrame:
    """Constant column (dataset tag)."""
    return df.withColumn(name, F.lit(value))


def key_column(df: DataFrame, source: str, name: str = "id") -> DataFrame:
    """Promote a source column to the key column, placed first."""
    rest = [c for c in df.columns if c not in (source, name)]
    return df.select(F.col(source).alias(name), *rest)


def project(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.select(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position; the count must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def indicator_columns(df: DataFrame, indicator: str, value: str, targets: Mapping[str, str]) -> DataFrame:
    """For each target column: ``value`` where ``indicator == label``, else null (a 2-way pivot)."""
    return df.withColumns({name: F.when(F.col(indicator) == F.lit(label), F.col(value))
                           for name, label in targets.items()})


def normalise_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values by a map (one pass, rules are not chained)."""
    if not mapping:
        return df
    return df.replace(dict(mapping), subset=[column])


def clamp0(c: Column | str) -> Column:
    """Negative -> 0; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < 0, F.lit(0)).otherwise(c)


def cond_replace(c: Column | str, other: Column | str) -> Column:
    """``other`` where ``c`` is negative, else ``c``."""
    c = F.col(c) if isinstance(c, str) else c
    other = F.col(other) if isinstance(other, str) else other
    return F.when(c < 0, other).otherwise(c)


def zero_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """null (and NaN) -> 0 on the given numeric columns."""
    return df.fillna(0, subset=list(columns))


def drop_keys_with_null(df: DataFrame, key: str, attr: str,
                        max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Remove every row of a key that has at least one null ``attr`` (not only the null rows).

    The bad keys come from a map-side-combined distinct over (key, attr) with ``attr IS NULL``
    pushed to the scan, so a hot key costs one row per task. They are checkpointed (computed once);
    when their measured bytes are within the bound, the null-safe anti-join is a broadcast and the data
    side is never shuffled. Otherwise it is a shuffled anti-join, where AQE splits a dominant key.
    """
    bad = (df.where(F.col(attr).isNull()).select(F.col(key).alias("__bad_key")).distinct())
    bad = broadcast_if_bounded(materialize(bad), max_broadcast_bytes)
    return df.join(bad, F.col(key).eqNullSafe(F.col("__bad_key")), "left_anti")


def keep_rows_with_value(df: DataFrame, attr: str) -> DataFrame:
    """The row-level alternative to ``drop_keys_with_null``."""
    return df.where(F.col(attr).isNotNull())


def negative_rows(df: DataFrame, measure: str) -> DataFrame:
    return df.where(F.col(measure) < 0)


def drop_value(df: DataFrame, column: str, value) -> DataFrame:
    """Drop rows equal to ``value``; null rows stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))
