"""The exact most frequent values of a column without counting all values (G-9, O-3).

A full count shuffles a row for every distinct value and task. Here each task keeps a Misra-Gries summary of at most
``counters`` values: when there are more, the smallest counts are taken off all, and what was taken off is the task's
error. Summed over tasks, a value's summary count is below its true count by at most the summed error E. With L the k-th largest
summary count, a value among the first k has a true count of L or more, so a summary count of L - E or more: if
that is positive, those values are all candidates, a second pass counts them alone, and the result is exact. If it isn't, the
summaries are too small and are made again with eight times the counters (a summary that holds all values has no error).

Shuffled are at most ``counters`` rows a task, then the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.joins import broadcast_if_bounded
from vigil.session import materialize, ship_package

COUNTERS = 1 << 14
WIDER = 8


class Summary:
    """Misra-Gries counts of texts, a batch at a time."""

    def __init__(self, counters: int) -> None:
        self.counters, self.error = counters, 0
        self.values, self.counts = pa.array([], pa.string()), np.zeros(0, np.int64)

    def add(self, values: pa.Array) -> None:
        found = pc.value_counts(values.cast(pa.string()))
        both = pa.table({"v": pa.concat_arrays([self.values, found.field("values")]), "n": np.concatenate([self.counts, found.field("counts").to_numpy()])})
        merged = both.group_by("v").aggregate([("n", "sum")])
        self.values, self.counts = merged["v"].combine_chunks(), merged["n_sum"].to_numpy()
        if len(self.counts) > self.counters:
            off = int(np.partition(self.counts, -self.counters - 1)[-self.counters - 1])
            self.error += off
            keep = self.counts > off
            self.values, self.counts = self.values.filter(pa.array(keep)), self.counts[keep] - off


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Summary(counters)
        for b in batches:
            held.add(b.column(0))
        values, counts = held.values, held.counts
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([values, pa.array([None], pa.string())]), pa.array(np.append(counts, held.error))], ["value", "n"])
    return run


def summed(rows: DataFrame, counters: int) -> tuple[DataFrame, int]:
    """(value, n) of all tasks' summaries, stored, and their summed error. Null values aren't counted."""
    ship_package(rows.sparkSession)
    made = rows.mapInArrow(_summaries(counters), "value string, n long").groupBy("value").agg(F.sum("n").alias("n"))
    made = materialize(made)
    error = made.filter("value IS NULL").first()
    return made.filter("value IS NOT NULL"), int(error["n"]) if error else 0


def top_values(rows: DataFrame, column: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """(column, total): the k most frequent texts of a column, ties by the text; equal to a full count. ``rows`` are read two times or more."""
    values = rows.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL")
    if k < 1:
        return values.limit(0).select(F.col("value").alias(column), F.lit(0).cast("long").alias("total"))
    while True:
        counts, error = summed(values, counters)
        top = counts.select("n").orderBy(F.desc("n")).limit(k).collect()
        least = top[-1]["n"] if len(top) == k else 0
        if error == 0 or least - error > 0:
            break
        counters *= WIDER
    if error == 0:  # the summaries hold every value with its count
        total = counts
    else:
        candidates = broadcast_if_bounded(counts.filter(F.col("n") >= least - error).select("value"))
        total = values.join(candidates, "value", "left_semi").groupBy("value").agg(F.count("*").alias("n"))
    return total.orderBy(F.desc("n"), "value").limit(k).select(F.col("value").alias(column), F.col("n").alias("total"))
