"""Daily series operators: value N days earlier, day counter, negative repair (J-2, W-1, W-3, F-1).

The default lag is a self equi-join on (keys, date): it hash-partitions on both keys, so a country
holding a third of all rows still spreads over its dates. The window form (a cross-check) is
partitioned by (keys, date bucket) with look-back copies at bucket edges, for the same reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.joins import BROADCAST_BYTES, broadcast_if_bounded
from vigil.operators.shape import clamp0
from vigil.session import materialize


def lag_days(df: DataFrame, keys: Sequence[str], date: str, columns: Sequence[str], days: int = 7,
             how: str = "join", prefix: str = "lag_", bucket_days: int = 64, take=F.first) -> DataFrame:
    """Add ``prefix + c``: the value of ``c`` for the same keys exactly ``days`` days earlier.

    Keys match null-safely. When (keys, date) repeats on the right, the join form fans out like a
    left join; the window form then takes one value of them (``take``: an aggregate function).

    The window form does not partition by the keys alone (one hot key would be one task): rows are
    bucketed by ``bucket_days``-day periods, and the rows of a bucket's last ``days`` days are also
    emitted (one ``explode``, no second scan) as look-back copies into the next bucket. Each window
    partition is then (keys, bucket), a key's history spreads over its buckets, and the copies are
    dropped after the window.
    """
    keys, columns = list(keys), list(columns)
    if how == "window":
        if bucket_days <= days:
            raise ValueError("bucket_days must exceed days")
        d = F.unix_date(F.col(date))
        copies = F.when(F.pmod(d, F.lit(bucket_days)) >= bucket_days - days, F.array(F.lit(0), F.lit(1))) \
            .otherwise(F.array(F.lit(0)))
        u = df.select("*", F.explode(copies).alias("__copy"))
        u = u.withColumn("__bucket", F.floor(d / F.lit(bucket_days)) + F.col("__copy"))
        w = Window.partitionBy(*keys, "__bucket").orderBy(d).rangeBetween(-days, -days)
        out = u.withColumns({prefix + c: take(F.col(c)).over(w) for c in columns})
        return out.where(F.col("__copy") == 0).drop("__copy", "__bucket")
    if how != "join":
        raise ValueError(how)
    right = df.select(*[F.col(k).alias(f"__lk{i}") for i, k in enumerate(keys)],
                      F.date_add(F.col(date), days).alias("__ld"),
                      *[F.col(c).alias(prefix + c) for c in columns])
    cond = [F.col(k).eqNullSafe(F.col(f"__lk{i}")) for i, k in enumerate(keys)]
    cond.append(F.col(date) == F.col("__ld"))
    out = df.join(right, cond, "left")
    return out.drop(*[f"__lk{i}" for i in range(len(keys))], "__ld")


def _number(df: DataFrame, c: str) -> Column:
    """A measure with NaN as null."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), F.col(c))
    return F.col(c)


def repair_negatives(df: DataFrame, keys: Sequence[str], date: str, measures: Sequence[str],
                     days: int = 7, how: str = "join", stage: bool = True) -> DataFrame:
    """Negative measure -> its original value ``days`` earlier (negative -> 0, missing -> 0);
    every other null or NaN -> 0. Not recursive: the earlier value is the unrepaired one. Each input row
    gives one row: where (keys, date) repeats, the largest of the earlier values counts. Keys and dates
    match null-safely (a null date has no earlier day).

    The join form shuffles only rows with a negative measure and the rows they look back to; all others
    pass through a projection. It reads its input three times, so with ``stage`` an input that isn't a plain scan (its plan
    joins, groups, sorts or generates rows) is checkpointed first and computed once.
    """
    keys, measures = list(keys), list(measures)
    clean = df.withColumns({m: _number(df, m) for m in measures})
    zeroed = {m: F.coalesce(F.col(m), F.lit(0)) for m in measures}

    def fixed(lag: str) -> dict[str, Column]:
        return {m: F.when(F.col(m) < 0, F.coalesce(clamp0(F.col(lag + m)), F.lit(0))).otherwise(zeroed[m]) for m in measures}

    if how == "window":
        bucket = max(64, 4 * days)
        lagged = lag_days(clean, keys, date, measures, days, how="window", prefix="__lag_", bucket_days=bucket, take=F.max)
        return lagged.withColumns(fixed("__lag_")).drop(*["__lag_" + m for m in measures])
    if how != "join":
        raise ValueError(how)
    if stage and is_costly(df):
        clean = materialize(clean)
    negative = F.lit(False)
    for m in measures:
        negative = negative | F.coalesce(F.col(m) < 0, F.lit(False))
    wanted = clean.where(negative).select(*[F.col(k).alias(f"__w{i}") for i, k in enumerate(keys)],
                                          F.date_sub(date, days).alias("__wd")).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__w{i}")) for i, k in enumerate(keys)] + [F.col(date) == F.col("__wd")]
    earlier = (clean.join(wanted, same, "left_semi").groupBy(*[F.col(k).alias(f"__w{i}") for i, k in enumerate(keys)], F.col(date).alias("__wd"))
               .agg(*[F.max(m).alias("__lag_" + m) for m in measures]))
    back = same[:-1] + [F.date_sub(date, days) == F.col("__wd")]
    repaired = clean.where(negative).join(earlier, back, "left").withColumns(fixed("__lag_"))
    return clean.where(~negative).withColumns(zeroed).select(*df.columns).unionByName(repaired.select(*df.columns))


def is_costly(df: DataFrame) -> bool:
    """Whether computing ``df`` takes more than a scan with filters and projections."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(x in plan for x in ("Join", "Aggregate", "Window", "Sort", "Generate", "Distinct", "Repartition", "Union"))


def day_counter_table(df: DataFrame, date: str, order_by: Sequence[str] | None = None,
                      mode: str = "first_seen", name: str = "contador_dia") -> DataFrame:
    """(date, counter): 1..n over the distinct non-null dates.

    ``first_seen`` numbers dates by their first appearance in ``order_by`` order (file order);
    ``chronological`` by the date itself. Dates are reduced to one row each (partial aggregation)
    before the numbering window, which therefore sees only the distinct dates of the calendar.
    """
    dates = df.where(F.col(date).isNotNull())
    if mode == "first_seen":
        if not order_by:
            raise ValueError("first_seen needs an order column")
        first = F.min(F.struct(*[F.col(c) for c in order_by]))
        firsts = dates.groupBy(date).agg(first.alias("__first"))
        w = Window.orderBy(F.col("__first"), F.col(date))
    elif mode == "chronological":
        firsts = dates.select(date).distinct()
        w = Window.orderBy(F.col(date))
    else:
        raise ValueError(mode)
    return firsts.select(F.col(date), F.row_number().over(w).cast("bigint").alias(name))


def day_counter(df: DataFrame, date: str, order_by: Sequence[str] | None = None,
                mode: str = "first_seen", name: str = "contador_dia", stage: bool = True,
                max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Attach the day counter by date (null dates get null).

    With ``stage`` the counter table (one row per distinct date) is checkpointed once and, when
    its bytes are within the bound, broadcast: the data side is then never shuffled on the
    date, so a date holding a large share of the rows cannot skew a join partition.
    """
    counter = counter_of(df, date, order_by, mode, name, max_broadcast_bytes) if stage else day_counter_table(df, date, order_by, mode, name)
    return df.join(counter, on=date, how="left")


def counter_of(df: DataFrame, date: str, order_by: Sequence[str] | None = None, mode: str | None = None, name: str = "contador_dia",
               max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The day counter table (``mode``: by first appearance where there is an order, else by date), checkpointed and, within the bound, broadcast."""
    mode = mode or ("first_seen" if order_by else "chronological")
    return broadcast_if_bounded(materialize(day_counter_table(df, date, order_by, mode, name)), max_broadcast_bytes)
