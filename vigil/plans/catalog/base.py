"""Registration helpers for the query catalog."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.sources.tables import Inputs, view_sql_plain


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def oracle(body: str, views: Sequence[str] = (), ctes: Sequence[tuple[str, str]] = ()) -> str:
    """DuckDB text: fixture views and derived CTEs (in dependency order), then the body."""
    parts = [f"{v} AS ({view_sql_plain(v)})" for v in views]
    parts += [f"{name} AS ({sql.strip()})" for name, sql in ctes]
    body = body.strip()
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn: Callable[[Inputs], DataFrame]):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, lambda inp: normalise(fn(inp)), sql, note)
        return fn
    return deco


def normalise(df: DataFrame) -> DataFrame:
    """DECIMAL/FLOAT -> DOUBLE and INT/SHORT/BYTE -> BIGINT on output columns only."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            casts[f.name] = F.col(f.name).cast("bigint")
    return df.withColumns(casts) if casts else df
