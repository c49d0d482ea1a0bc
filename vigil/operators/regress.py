"""Simple linear regression per group (F-6, F-7, F-11): built-in regression aggregates, one
partial+final aggregation per call; fitted values by joining the per-group coefficients back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ols(df: DataFrame, group: Sequence[str], y: str, x: str, digits: int = 4) -> DataFrame:
    """group..., slope, intercept, r2, n for y = intercept + slope * x."""
    group = list(group)
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    g = df.groupBy(*group).agg(F.regr_slope(yy, xx).alias("slope"), F.regr_intercept(yy, xx).alias("intercept"),
                               F.regr_r2(yy, xx).alias("r2"), F.regr_count(yy, xx).alias("n"))
    return g.select(*group, F.round("slope", digits).alias("slope"), F.round("intercept", digits).alias("intercept"),
                    F.round("r2", digits).alias("r2"), "n")


def ols_fitted(df: DataFrame, group: Sequence[str], y: str, x: str, keep: Sequence[str] = (),
               digits: int = 4, few_groups: bool = False) -> DataFrame:
    """Rows with x, y and the fitted y_hat of their group's line. ``few_groups`` (a top-k) sends the
    coefficients to the rows instead of shuffling them."""
    group = list(group)
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    coef = df.groupBy(*group).agg(F.regr_slope(yy, xx).alias("__b"), F.regr_intercept(yy, xx).alias("__a"))
    rows = df.select(*group, *keep, xx.alias("x"), yy.alias("y"))
    j = rows.join(F.broadcast(coef) if few_groups else coef, group)
    return j.select(*group, *keep, "x", "y", F.round(F.col("__a") + F.col("__b") * F.col("x"), digits).alias("y_hat"))
