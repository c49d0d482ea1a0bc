"""Hard negatives: for an anchor and each of its positives, the best rows of other labels within a window of the positive's score.

A row's score is its inner product with the anchor, in whole numbers (``_vectors``). An anchor's positives are its best other rows of
the same label. Each positive's window reaches from a share of its score up to another; the windows overlap, so
they aren't searched one by one: the positives' upper limits split all scores into slots that don't overlap (slot j lies above the
next lower limit, up to the j-th), each task keeps its best ``k`` rows of every anchor and slot, and the tasks' rows are merged
to ``k`` a slot. The best ``k`` up to the j-th limit are then those of slot j merged with the best of all lower slots, which
are carried along from the lowest slot upward; a window is that list without what lies below its lower limit.

Anchors are a stated query set against all rows, in blocks: a block (``BLOCK_VALUES`` numbers at most, by a hash of the row)
travels with the tasks of one pass over all rows, and its results are written before the next block is read, so the driver
and a task hold one block whatever the number of anchors. A task holds for its block at most ``k`` rows an anchor and slot.

Rules: rows with a null label, a null vector or a null or non-finite component take no part; equal scores go by the smaller id
(null ids last); repeated rows are rows of their own, and an anchor isn't its own positive; an anchor without another row of
its label, or whose windows are empty, has no row; positives with a negative score have an empty window; an empty table makes no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm._jobs import python_ready, scratch_path, stored
from vigil.llm._vectors import bound, matrix, packed, slices, unpacked, usable, width

#: Numbers of the anchors that travel with the tasks at a time, and scores that a task computes at a time.
BLOCK_VALUES = 1 << 22
CELLS = 1 << 21
#: Candidates that are put aside before they are sorted in.
BUFFER = 1 << 18
_NONE = np.iinfo(np.int64).min


def _prepared(dim: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, dim):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(matrix(b.column(2), dim, most), "<i4")], ["id", "label", "x"])
    return run


def products(x: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles where these hold every sum, else in 64-bit integers."""
    peak = (int(np.abs(x).max(initial=0)) + 1) * (int(np.abs(anchors).max(initial=0)) + 1) * max(x.shape[1], 1)
    if peak < 2**53:
        return (x.astype(np.float64) @ anchors.T.astype(np.float64)).astype(np.int64)
    return x @ anchors.T


class Best:
    """The first ``k`` candidates of every group: higher scores first, then smaller ids (null ids last), then row keys.

    Candidates are put aside until there are as many as are held (``BUFFER`` at least), then sorted in; those below the last place
    of a full group are dropped at once. So a candidate is sorted a few times, however many batches there are.
    """

    def __init__(self, k: int, groups: int) -> None:
        self.k, self.n = k, 0
        self.floor = np.full(groups, _NONE)
        self._held = [np.zeros(0, np.int64) for _ in range(5)]
        self.new: list[tuple[np.ndarray, ...]] = []

    def add(self, group: np.ndarray, score: np.ndarray, no_id: np.ndarray, ident: np.ndarray, key: np.ndarray) -> None:
        good = score >= self.floor[group]
        self.new.append(tuple(x[good] for x in (group, score, no_id, ident, key)))
        self.n += len(self.new[-1][0])
        if self.n > max(BUFFER, len(self._held[0])):
            self._sort()

    def _sort(self) -> None:
        all_ = [np.concatenate(x) for x in zip(self._held, *self.new)]
        order = np.lexsort((all_[4], all_[3], all_[2], -all_[1], all_[0]))
        group = all_[0][order]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        place = np.arange(len(group)) - start
        self._held = [a[order[place < self.k]] for a in all_]
        last = order[place == self.k - 1]
        self.floor[all_[0][last]] = all_[1][last]
        self.new, self.n = [], 0

    @property
    def held(self) -> list[np.ndarray]:
        """Group, score, whether the id is null, id and row key of what is kept, group by group."""
        self._sort()
        return self._held


class Block:
    """Anchors that travel with the tasks. ``limits``: the positives' upper limits, highest first, and ``low`` their least lower limit; None
    where positives are searched."""

    def __init__(self, key: np.ndarray, label: list[str], x: np.ndarray, limits: np.ndarray | None = None, low: np.ndarray | None = None) -> None:
        self.key, self.x, self.limits, self.low = key, x, limits, low
        self.number = {name: i for i, name in enumerate(dict.fromkeys(label))}
        self.label = np.array([self.number[name] for name in label], np.int64)

    def candidates(self, key: np.ndarray, label: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, slot, score) of what may be a positive (slot 0) or a negative of an anchor."""
        score = products(x, self.x)
        same = label[:, None] == self.label
        if self.limits is None:
            row, anchor = np.nonzero(same & (key[:, None] != self.key))
            return row, anchor, np.zeros(len(row), np.int64), score[row, anchor]
        row, anchor = np.nonzero(~same & (score >= self.low) & (score <= self.limits[:, 0]))
        score = score[row, anchor]
        return row, anchor, (self.limits[anchor] >= score[:, None]).sum(axis=1) - 1, score


def _search(block: Block, k: int, dim: int):
    slots = 1 if block.limits is None else block.limits.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, step = Best(k, slots * len(block.key)), max(1, CELLS // len(block.key))
        for b in slices(batches, dim):
            key, no_id = b.column(0).to_numpy(), b.column(1).is_null().to_numpy(zero_copy_only=False)
            ident = b.column(1).fill_null(0).to_numpy()
            label = np.array([block.number.get(x, -1) for x in b.column(2).to_pylist()], np.int64)
            x = unpacked(b.column(3), "<i4", dim).astype(np.int64)
            for i in range(0, len(x), step):
                row, anchor, slot, score = block.candidates(key[i:i + step], label[i:i + step], x[i:i + step])
                if len(row):
                    best.add(anchor * slots + slot, score, no_id[i + row].astype(np.int64), ident[i + row], key[i + row])
        group, score, no_id, ident, key = best.held
        yield pa.RecordBatch.from_arrays([pa.array(block.key[group // slots]), pa.array((group % slots).astype(np.int32)), pa.array(ident, pa.int64(), mask=no_id.astype(bool)),
                                          pa.array(score), pa.array(key)], ["anchor", "slot", "id", "score", "key"])
    return run


_FOUND = "anchor long, slot int, id long, score long, key long"


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of every anchor and slot, over all tasks, numbered from 1 as ``place``."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "key")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _limit(score: str, percent: int, up: bool) -> Column:
    """The largest (``up``) or smallest whole number within ``percent`` of a score, exactly."""
    x = f"{score} * {percent}" if up else f"-({score} * {percent})"
    down = f"(({x}) - pmod({x}, 100)) div 100"
    return F.expr(down if up else f"-({down})")


def suffix_merges(slots: Column, positives: int, k: int) -> Column:
    """For each slot the best ``k`` of it and all lower ones, from an array of (slot, down, no_id, id): ``down`` is the negated score, so the
    natural order is that of the ranking. Lists are carried from the lowest slot upward."""
    none = F.expr("cast(array(array()) as array<array<struct<slot:int,down:long,no_id:boolean,id:bigint>>>)")
    order = lambda a, b: F.when(a["down"] != b["down"], F.when(a["down"] < b["down"], -1).otherwise(1)).when(
        a["no_id"] != b["no_id"], F.when(b["no_id"], -1).otherwise(1)).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)
    lowest_first = F.sequence(F.lit(positives - 1), F.lit(0), F.lit(-1))
    return F.aggregate(lowest_first, none, lambda done, j: F.concat(F.array(F.slice(F.array_sort(F.concat(done[0], F.filter(slots, lambda c: c["slot"] == j)), order), 1, k)), done))


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, k: int = 5, low: int = 80, high: int = 100, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (rows where ``is_anchor``) and each of its first
    ``positives`` rows of the same label the first ``k`` rows of other labels with low % to high % of the positive's score. Ids are integers."""
    spark = rows.sparkSession
    python_ready(spark)
    held = rows.filter(usable(vector_col) & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    dim = width(held, "x")
    ready = held.select(F.struct("id", "anchor").alias("id"), "label", "x").mapInArrow(_prepared(dim, bound(dim, max(100, low, high))), "id struct<id:long,anchor:boolean>, label string, x binary")
    every = stored(ready.select(F.monotonically_increasing_id().alias("key"), F.col("id.id").alias("id"), "label", "x", F.col("id.anchor").alias("anchor")), "vectors")
    anchors = every.filter("anchor")
    blocks = -(-anchors.count() * max(dim, 1) // BLOCK_VALUES)
    of_block = F.pmod(F.xxhash64("key"), F.lit(max(blocks, 1)))
    paths = []
    for i in range(blocks):
        block = anchors.filter(of_block == i).select("key", "id", "label", "x")
        paths.append(_one_block(every.select("key", "id", "label", "x"), block, dim, positives, k, low, high))
    paths = [p for p in paths if p]
    if not paths:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return spark.read.parquet(*paths)


def _one_block(every: DataFrame, anchors: DataFrame, dim: int, positives: int, k: int, low: int, high: int) -> str | None:
    """Mine the negatives of one block of anchors; the path of the written rows (None: no anchor)."""
    path = scratch_path(every.sparkSession, "negatives")
    held = anchors.toArrow().combine_chunks()
    if not held.num_rows:
        return None
    key, x = held["key"].to_numpy(), unpacked(held["x"], "<i4", dim).astype(np.int64)
    label = held["label"].to_pylist()
    near = stored(_first(every.mapInArrow(_search(Block(key, label, x), positives, dim), _FOUND), positives)
                  .select("anchor", (F.col("place") - 1).cast("int").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                          _limit("score", low, False).alias("least"), _limit("score", high, True).alias("most")), "positives")
    windows = near.filter("least <= most").select("anchor", "slot", "least", "most").toArrow()  # ``positives`` rows an anchor of the block at most
    at = np.searchsorted(np.sort(key), windows["anchor"].to_numpy())
    at = np.argsort(key, kind="stable")[at]
    limits, least = np.full((len(key), positives), _NONE), np.full(len(key), np.iinfo(np.int64).max)
    limits[at, windows["slot"].to_numpy()] = windows["most"].to_numpy()
    np.minimum.at(least, at, windows["least"].to_numpy())
    found = _first(every.mapInArrow(_search(Block(key, label, x, limits, least), k, dim), _FOUND), k)
    slots = found.groupBy("anchor").agg(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"), "id")).alias("slots"))
    lists = slots.select("anchor", suffix_merges(F.col("slots"), positives, k).alias("lists"))
    ids = anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id"))
    each = near.join(lists, "anchor").join(ids, "anchor").select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(F.filter(F.col("lists")[F.col("slot")], lambda c: -c["down"] >= F.col("least"))).alias("at", "c"))
    each.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("c.id").alias("negative_id"), "positive_score", (-F.col("c.down")).alias("negative_score")).write.parquet(path)
    return path
