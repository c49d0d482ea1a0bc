"""Date Column functions. ANSI mode is on in Spark 4, so dirty text goes through ``try_*``."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted layouts of a date parameter, tried in this order.
DATE_LAYOUTS_PY = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d")
DATE_LAYOUTS_SPARK = ("y-M-d H:m:s", "y-M-d")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date(c: Column | str, fmt: str | None = None) -> Column:
    """Text or timestamp -> DATE; unparsable text gives null."""
    c = _c(c)
    if fmt is None:
        return F.to_date(F.try_to_timestamp(c.cast("string")))
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit(fmt)))


def date_text(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_c(c), fmt)


def days_before(c: Column | str, days: int) -> Column:
    return F.date_sub(_c(c), days)


def parse_timestamp(c: Column | str, layouts=DATE_LAYOUTS_SPARK) -> Column:
    """First layout that parses wins (the second is the fallback)."""
    c = _c(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in layouts])


def epoch_seconds(c: Column | str, layouts=DATE_LAYOUTS_SPARK) -> Column:
    """Date text in either layout -> seconds since the epoch (session time zone, UTC here)."""
    return F.unix_timestamp(parse_timestamp(c, layouts)).cast("bigint")


def parse_param(value: str | date | datetime) -> datetime:
    """Driver-side parameter (not data): a date given as text in either layout -> UTC datetime."""
    if isinstance(value, datetime):
        return value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day, tzinfo=timezone.utc)
    for fmt in DATE_LAYOUTS_PY:
        try:
            return datetime.strptime(value.strip(), fmt).replace(tzinfo=timezone.utc)
        except ValueError:
            continue
    raise ValueError(f"unparsable date: {value!r}")
