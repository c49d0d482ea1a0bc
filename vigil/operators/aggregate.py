"""Aggregations, sorts, top-k and set operations (G-*, O-*, U-*, W-2, F-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.joins import broadcast_bounded


def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
              drop_null_keys: bool = True, empty_as_zero: bool = True) -> DataFrame:
    """Group-sum with pandas rules: rows with a null key are dropped, a sum of only nulls is 0.

    Runs as partial (map-side) + final HashAggregate, so a hot key is pre-reduced in every task.
    """
    keys = list(keys)
    d = df.dropna(subset=keys) if drop_null_keys else df
    aggs = [(F.coalesce(F.sum(m), F.lit(0)) if empty_as_zero else F.sum(m)).alias(m) for m in measures]
    return d.groupBy(*keys).agg(*aggs)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def negative_profile(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """For each measure: the non-null count of every column among rows where the measure is < 0.

    One scan computes all counts; the single result row is then unstacked into one row per measure.
    """
    cols = df.columns
    aggs = [F.count(F.when(F.col(m) < 0, F.col(c))).alias(f"{m}__{c}") for m in measures for c in cols]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(m).alias("measure"),
                     *[F.col(f"{m}__{c}").cast("bigint").alias(f"n_{c}") for c in cols])
            for m in measures]
    return wide.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """One row: for each column, whether it has any null."""
    return df.agg(*[F.bool_or(F.col(c).isNull()).alias(f"has_null_{c}") for c in df.columns])


def coverage(df: DataFrame, group: str, date: str) -> DataFrame:
    """First and last date per dataset."""
    return df.groupBy(group).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def unique_values(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Sorted distinct non-null values, one row each."""
    name = name or column
    return df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct().orderBy(name)


def joined_values(df: DataFrame, column: str, name: str | None = None, sep: str = ",") -> DataFrame:
    """Sorted distinct non-null values as one text, for inputs with few of them by construction (a top-k)."""
    return df.agg(F.array_join(F.sort_array(F.collect_set(column)), sep).alias(name or f"{column}_values"))


def top_k(df: DataFrame, key: str, measure: str, k: int, rank_name: str = "contador",
          total_name: str | None = None) -> DataFrame:
    """k keys with the largest total, ranked 1..k (ties broken by key); rows without a key don't count.

    Totals are a partial+final aggregate; the k rows come from TakeOrderedAndProject (per-task
    top-k, then a merge of k rows per task); the ranking window only sees those k rows.
    """
    total_name = total_name or measure
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).alias(total_name))
    order = [F.desc(total_name), F.asc(key)]
    top = totals.orderBy(*order).limit(k)
    return top.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_k_series(df: DataFrame, key: str, measure: str, k: int, rank_name: str = "contador") -> DataFrame:
    """Rows of the k keys with the largest total, with their rank (one semi-join, no loop)."""
    ranks = top_k(df, key, measure, k, rank_name, total_name="__total").select(key, rank_name)
    return df.join(broadcast_bounded(ranks), on=key, how="inner")


def union_distinct(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def unify(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing in an input are null (no shuffle)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
