"""Lookups and membership joins (J-4, J-5, J-6, G-4 dimension)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.joins import broadcast_bounded


def prefix_dimension(df: DataFrame, key: str, value: str, n: int = 8, key_name: str | None = None) -> DataFrame:
    """Distinct (first ``n`` characters of ``key``, ``value``) pairs."""
    return df.select(F.substring(F.col(key), 1, n).alias(key_name or key), F.col(value)).distinct()


def prefix_lookup(df: DataFrame, dim: DataFrame, column: str, dim_key: str = "country",
                  dim_value: str = "continent", n: int = 8, on_multi: str = "fanout",
                  out: str | None = None) -> DataFrame:
    """Left join on the first ``n`` characters of ``column`` (null matches null).

    ``fanout`` keeps every dimension row of a prefix (several continents -> several rows);
    ``first`` keeps the smallest value per prefix. An existing ``out`` column is replaced.
    The dimension is a distinct set of prefixes; Catalyst/AQE broadcast it when it is small.
    """
    out = out or dim_value
    d = dim.select(F.col(dim_key).alias("__pk"), F.col(dim_value).alias("__pv"))
    if on_multi == "first":
        d = d.groupBy("__pk").agg(F.min("__pv").alias("__pv"))
    elif on_multi != "fanout":
        raise ValueError(on_multi)
    base = df.drop(out) if out in df.columns else df
    j = base.join(d, F.substring(F.col(column), 1, n).eqNullSafe(F.col("__pk")), "left")
    return j.drop("__pk").withColumnRenamed("__pv", out)


def attach_side_measure(df: DataFrame, side: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                        columns: Sequence[str], fill_side_nulls: bool = True) -> DataFrame:
    """Left join of side measures on several keys (null-safe).

    Side nulls become 0 before the join; rows without a side match keep null. Right keys whose name
    differs from the left key are kept (like a merge with ``left_on``/``right_on``).
    """
    left_on, right_on, columns = list(left_on), list(right_on), list(columns)
    side_cols = [F.col(r).alias(f"__sk{i}") for i, r in enumerate(right_on)]
    kept = [F.col(r) for l, r in zip(left_on, right_on) if l != r]
    s = side.select(*side_cols, *kept, *[F.col(c) for c in columns])
    if fill_side_nulls:
        s = s.fillna(0, subset=columns)
    cond = [F.col(l).eqNullSafe(F.col(f"__sk{i}")) for i, l in enumerate(left_on)]
    return df.join(s, cond, "left").drop(*[f"__sk{i}" for i in range(len(right_on))])


def semi_join_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str], bounded: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (``isin`` as a left-semi join)."""
    k = broadcast_bounded(keys) if bounded else keys
    return df.join(k, on=on, how="left_semi")
