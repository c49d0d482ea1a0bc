"""The outbreak fact kept up to date: a load recomputes the months whose rows can have changed (K-1, F-9).

Beside the fact (partitioned by category and month) lies the state of the last load: for every source and day a digest of
its rows, the keys with a null continent, the prefix dimension and the day counters. A load reads the sources once,
compares, and works out the touched days:

* a day whose digest differs (new, corrected or withdrawn rows), and for the cases the day ``repair_days`` later, whose
  negative values look back to it;
* all days of a key that became bad or good, of a prefix whose continents changed, of a changed vaccination row;
* all days whose counter changed (a late row of a new day renumbers what follows; a new last day only adds a number).

The months of these days are computed from their rows and the ``repair_days`` before them, and replace the stored ones;
months left without rows are removed. Measures keep the types of the first load. The state is written last, into a new folder named in one small file, so a load that fails is simply
repeated: it sees the old state and does the same again. Without a state everything is computed.
The result equals ``build_fact`` on the same sources.
"""

from __future__ import annotations

import uuid
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.joins import broadcast_if_bounded
from vigil.operators.lookup import prefix_dimension
from vigil.operators.series import counter_of
from vigil.operators.shape import normalise_values
from vigil.plans.fact import FACT_COLUMNS, FactParams, cases_rows, long_rows, orders, unified, wide_a_rows, wide_b_rows
from vigil.session import in_parallel, materialize
from vigil.sinks.tables import delete_folder

SOURCES = ("covid", "ebola", "h1n1", "sars")
STATE = ("digests", "bad", "dim", "counters", "types")  # the last: no rows, the fact's columns
NO_DAY = "none"


def day_of(date: Column) -> Column:
    return F.coalesce(date.cast("string"), F.lit(NO_DAY))


def month_of(day: Column) -> Column:
    return F.substring(day, 1, 7)


def digests(rows: DataFrame, source: str) -> DataFrame:
    """(source, day, n, h): the number of a day's rows and a sum of their hashes, without the rows' places in their files."""
    cols = [F.col(c) for c in rows.columns if c != "source_ordinal"]
    return rows.groupBy(day_of(F.col("date")).alias("day")).agg(F.count("*").alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).cast("string").alias("h")).select(
        F.lit(source).alias("source"), "day", "n", "h")


def _differs(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Rows that only one of two tables of distinct rows has."""
    if old is None:
        return new
    both = new.withColumn("side", F.lit(1)).unionByName(old.withColumn("side", F.lit(-1)))
    return both.groupBy(*new.columns).agg(F.sum("side").alias("s")).filter("s <> 0").drop("s")


class FactLoad:
    """The fact under ``path``."""

    def __init__(self, spark: SparkSession, path: str, params: FactParams | None = None) -> None:
        self.spark, self.path, self.p = spark, path.rstrip("/"), params or FactParams()

    def fact(self) -> DataFrame:
        """The fact of the last load."""
        state = self._state()
        if state is None:
            raise ValueError(f"nothing is loaded in {self.path}")
        return self.spark.read.schema(state["types"].schema).parquet(f"{self.path}/fact").select(*FACT_COLUMNS)

    def _state(self) -> dict[str, DataFrame] | None:
        try:
            names = [r[0] for r in self.spark.read.text(f"{self.path}/state").collect()]
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return {t: self.spark.read.parquet(f"{names[0]}/{t}") for t in STATE} if names else None

    def load(self, cases: DataFrame, vaccinations: DataFrame, long_df: DataFrame, wide_a: DataFrame, wide_b: DataFrame) -> list[tuple[str, str]]:
        """Bring the fact up to the sources; the (category, month) pairs that were computed again."""
        p, spark = self.p, self.spark
        long_raw = long_df.select("indicator", "country", "date", "value")
        made = [cases_rows(cases), long_raw, wide_a_rows(wide_a, p), wide_b_rows(wide_b, p), vaccinations.select("iso_code", "date", "people_fully_vaccinated")]
        raw, long_raw, wide_a, wide_b, vacc = in_parallel(spark, *[partial(materialize, d) for d in made])
        old = self._state() or dict.fromkeys(STATE)
        bad = materialize(raw.where(F.col("continent").isNull()).select("id").distinct())
        few = broadcast_if_bounded(bad.withColumnRenamed("id", "bad_id"))
        covid = raw.join(few, F.col("id").eqNullSafe(F.col("bad_id")), "left_anti")
        grouped = long_raw.where(F.col("date").isNotNull() & F.col("country").isNotNull())
        rows = [covid, grouped, wide_a, wide_b]
        dim, *counters = in_parallel(spark, lambda: materialize(prefix_dimension(covid, "country", "continent", p.prefix_length)),
                                     *[partial(counter_of, d, "date", list(o) if o else None) for d, o in zip(rows, orders(p))])
        numbers = reduce(DataFrame.unionByName, [c.select(F.lit(s).alias("source"), day_of(F.col("date")).alias("day"), "contador_dia") for s, c in zip(SOURCES, counters)])
        seen = reduce(DataFrame.unionByName, [digests(d, s) for d, s in zip([raw, long_raw, wide_a, wide_b, vacc], [*SOURCES, "vaccinations"])])
        seen, numbers = in_parallel(spark, partial(materialize, seen), partial(materialize, numbers))
        new = {"digests": seen, "bad": bad, "dim": dim, "counters": numbers}
        touched = broadcast_if_bounded(materialize(self._touched(new, old, raw, long_raw, wide_a, wide_b)))

        def of(d: DataFrame, source: str, days: int = 0) -> DataFrame:
            """Rows of the touched months, and of the ``days`` before each."""
            months = touched.filter(F.col("category") == source).select("month")
            later = F.array_distinct(F.array(month_of(day_of(F.col("date"))), *([month_of(day_of(F.date_add("date", days)))] if days else [])))
            return d.join(F.broadcast(months), F.array_contains(later, F.col("month")), "left_semi")

        others = [long_rows(of(grouped, "ebola"), p), of(wide_a, "h1n1"), of(wide_b, "sars")]
        fact = unified(of(covid, "covid", p.repair_days), others, vacc, dim, counters, p).withColumn("month", month_of(day_of(F.col("date"))))
        if old["types"] is not None:  # months that stay have the first load's types
            fact = fact.select(*[F.col(f.name).cast(f.dataType) for f in old["types"].schema.fields])
        fact = materialize(fact.join(touched, ["category", "month"], "left_semi"))
        (fact.hint("rebalance", "category", "month").write.mode("overwrite").partitionBy("category", "month")
         .option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/fact"))
        for r in touched.join(fact.select("category", "month").distinct(), ["category", "month"], "left_anti").collect():  # months left without rows
            delete_folder(spark, f"{self.path}/fact/category={r['category']}/month={r['month']}")
        self._keep(new | {"types": fact.limit(0)})
        return sorted((r["category"], r["month"]) for r in touched.collect())  # at most the calendar's months

    def _touched(self, new: dict, old: dict, raw: DataFrame, long_raw: DataFrame, wide_a: DataFrame, wide_b: DataFrame) -> DataFrame:
        """(category, month) of the days that have to be computed."""
        p = self.p
        changed = _differs(new["digests"], old["digests"]).select("source", "day").distinct()
        own = changed.filter(F.col("source") != "vaccinations").select(F.col("source").alias("category"), "day")
        later = changed.filter((F.col("source") == "covid") & (F.col("day") != NO_DAY)).select(
            F.lit("covid").alias("category"), F.date_add(F.to_date("day"), p.repair_days).cast("string").alias("day"))
        side = changed.filter(F.col("source") == "vaccinations").select(F.lit("covid").alias("category"), "day")
        number = _differs(new["counters"], old["counters"]).select(F.col("source").alias("category"), "day")
        parts = [own, later, side, number]
        if old["bad"] is not None:
            keys = broadcast_if_bounded(materialize(_differs(new["bad"], old["bad"]).withColumnRenamed("id", "other")))
            hit = raw.join(keys, F.col("id").eqNullSafe(F.col("other")), "left_semi").select(F.lit("covid").alias("category"), F.col("date").alias("d"))
            both = hit.select("category", F.explode(F.array("d", F.date_add("d", p.repair_days))).alias("d"))
            parts.append(both.select("category", day_of(F.col("d")).alias("day")).distinct())
            prefixes = broadcast_if_bounded(materialize(_differs(new["dim"], old["dim"]).select(F.col("country").alias("prefix")).distinct()))
            for source, d in zip(SOURCES[1:], (long_raw, wide_a, wide_b)):
                names = normalised(d, source, p)
                hit = names.join(prefixes, F.substring("country", 1, p.prefix_length).eqNullSafe(F.col("prefix")), "left_semi")
                parts.append(hit.select(F.lit(source).alias("category"), day_of(F.col("date")).alias("day")).distinct())
        return reduce(DataFrame.unionByName, parts).select("category", month_of(F.col("day")).alias("month")).distinct()

    def _keep(self, new: dict[str, DataFrame]) -> None:
        folder = f"{self.path}/states/{uuid.uuid4().hex}"
        for t in STATE:
            new[t].write.parquet(f"{folder}/{t}")
        self.spark.createDataFrame([(folder,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/state")


def normalised(d: DataFrame, source: str, p: FactParams) -> DataFrame:
    """Rows with the country's name as the fact has it (the wide sources' rows have it already)."""
    if source != "ebola":
        return d
    return normalise_values(d, "country", p.long_renames)
