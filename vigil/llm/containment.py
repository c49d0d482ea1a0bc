"""Benchmark decontamination: which documents contain a benchmark item.

A document contains an item if it has at least ``threshold`` of the item's distinct k-word shingles.
Size-partitioned MinHash search: documents fall into classes by the power of two above their set size,
and a class of sizes up to u uses a one-permutation MinHash of 4u bins (the least shingle hash of each
bin). Items are sketched once for each class. A shared shingle is both sketches' minimum of its bin with
a chance p of about 0.88, so an item with q shingles is missed with (1 - p)**(threshold * q) at most;
where the smallest item's chance is above ``miss``, further permutations are probed until it isn't.
Any common minimum makes a candidate; its full sets then decide exactly.

Documents are only scanned, never shuffled. Items are looked up from memory in blocks of some
``BLOCK_BYTES`` of shingles. A block is read, searched in one pass over the documents, and its results written before the next one
is read, so the driver and a task hold one block, however many items there are; more items than one block
cost a pass each. Result: one row (id, item, n_item, n_shared, containment) for each containing document and item.

Rules: A-Z count as a-z. Null or word-less texts and items match nothing. Items or documents with fewer
than k words have their whole word sequence as their only shingle. Repeated rows give repeated results; a
null id is kept. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._jobs import python_ready, scratch_path, stored
from vigil.llm._text import mix, small, text_sets

BLOCK_BYTES = 16 << 20
SPARE = 2  # bits: 2**2 bins for each shingle of the largest set of a class


def size_class(n: int) -> int:
    """The least c with n <= 2**c."""
    return max(0, (n - 1).bit_length())


def bin_minima(s: np.ndarray, c: int) -> np.ndarray:
    """The least hash in each of the 2**(c + SPARE) bins of an ascending set (a bin: equal top bits)."""
    top = s >> np.uint64(64 - c - SPARE)
    first = np.ones(len(s), bool)
    np.not_equal(top[1:], top[:-1], out=first[1:])
    return s[first]


def permuted(s: np.ndarray, i: int) -> np.ndarray:
    """The set in the i-th order; the 0th is the hash order itself."""
    return s if i == 0 else np.sort(mix(s ^ np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)))


def permutations_for(smallest: int, threshold: float, miss: float) -> int:
    load = 2.0 ** -SPARE
    lost = 1 - (1 - math.exp(-load)) / load
    return max(1, math.ceil(math.log(miss) / (math.log(lost) * math.ceil(threshold * smallest))))


class ItemIndex:
    """Sketches of a block of items, by size class and permutation, made when a class first occurs."""

    def __init__(self, sets: list[np.ndarray], threshold: float, miss: float) -> None:
        self.sets = sets
        self.need = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
        self.orders = permutations_for(min(map(len, sets)), threshold, miss)
        self.tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def table(self, c: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        if (c, i) not in self.tables:
            minima = [bin_minima(permuted(s, i), c) for s in self.sets]
            value, item = np.concatenate(minima), np.repeat(np.arange(len(minima)), [len(m) for m in minima])
            order = np.argsort(value, kind="stable")
            self.tables[c, i] = value[order], item[order]
        return self.tables[c, i]

    def candidates(self, s: np.ndarray) -> list[int]:
        c, found = size_class(len(s)), []
        for i in range(self.orders):
            value, item = self.table(c, i)
            mine = bin_minima(permuted(s, i), c)
            low = np.searchsorted(value, mine)
            hit = np.flatnonzero(value[np.minimum(low, len(value) - 1)] == mine)
            if len(hit):
                high = np.searchsorted(value, mine[hit], "right")
                found += [item[a:b] for a, b in zip(low[hit], high)]
        return np.unique(np.concatenate(found)).tolist() if found else []

    def matches(self, s: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the set contains."""
        out = []
        for j in self.candidates(s) if len(s) else ():
            q = self.sets[j]
            shared = int((s[np.minimum(np.searchsorted(s, q), len(s) - 1)] == q).sum())
            if shared >= self.need[j]:
                out.append((j, shared))
        return out


def _item_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):
            sets = text_sets(b.column(1), k)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["item", "members"])
    return run


def _search(ids: list, sets: list[bytes], id_type: pa.DataType, k: int, threshold: float, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex([np.frombuffer(s, np.uint64) for s in sets], threshold, miss)
        for b in small(batches, 1):
            rows = [(i, j, shared) for i, s in enumerate(text_sets(b.column(1), k)) for j, shared in index.matches(s)]
            at, item, shared = zip(*rows) if rows else ((), (), ())
            size = [len(index.sets[j]) for j in item]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array([ids[j] for j in item], id_type), pa.array(size, pa.int64()),
                 pa.array(shared, pa.int64()), pa.array([x / n for x, n in zip(shared, size)], pa.float64())],
                ["id", "item", "n_item", "n_shared", "containment"])
    return run


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", k: int = 5, threshold: float = 0.8, miss: float = 1e-6) -> DataFrame:
    """One row for each document and benchmark item that it contains."""
    spark = docs.sparkSession
    python_ready(spark)
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = T.StructType([T.StructField("item", wanted.schema["item"].dataType), T.StructField("members", T.BinaryType())])
    sets = stored(wanted.mapInArrow(_item_sets(k), kind).filter("length(members) > 0"), "items")
    blocks = sets.agg(F.ceil(F.sum(F.length("members")) / BLOCK_BYTES).alias("n")).first()["n"] or 0
    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("item", kind["item"].dataType),
                           T.StructField("n_item", T.LongType()), T.StructField("n_shared", T.LongType()),
                           T.StructField("containment", T.DoubleType())])
    found = _by_blocks(sets, int(blocks), lambda held: texts.mapInArrow(
        _search(held["item"].to_pylist(), held["members"].to_pylist(), held.schema.field("item").type, k, threshold, miss), schema))
    found = spark.createDataFrame([], schema) if found is None else found
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_item", "n_shared", "containment")


def _by_blocks(sets: DataFrame, blocks: int, search: Callable[[pa.Table], DataFrame]) -> DataFrame | None:
    """What ``search`` finds for all blocks of the stored item sets; with more than one, each block's rows are stored first."""
    paths = []
    for i in range(blocks):
        held = sets.filter(F.pmod(F.xxhash64("members"), F.lit(blocks)) == i).toArrow()  # some BLOCK_BYTES by construction
        if held.num_rows and blocks == 1:
            return search(held)
        if held.num_rows:
            paths.append(scratch_path(sets.sparkSession, "found"))
            search(held).write.parquet(paths[-1])
    return sets.sparkSession.read.parquet(*paths) if paths else None


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_text_col: str = "text",
                      k: int = 5, threshold: float = 0.8, miss: float = 1e-6) -> DataFrame:
    """The rows of ``docs``, all columns, whose text contains no item; the same search, but each row carries
    its own verdict, so null and repeated ids need no join."""
    spark = docs.sparkSession
    python_ready(spark)
    sets = stored(items.select(F.lit(0).alias("item"), F.col(item_text_col).cast("string").alias("text"))
                  .mapInArrow(_item_sets(k), "item int, members binary").filter("length(members) > 0"), "items")
    blocks = sets.agg(F.ceil(F.sum(F.length("members")) / BLOCK_BYTES).alias("n")).first()["n"] or 0
    if blocks <= 1:
        at = docs.columns.index(text_col)
        left = _by_blocks(sets, int(blocks), lambda held: docs.mapInArrow(_clean(held["members"].to_pylist(), at, k, threshold, miss), docs.schema))
        return docs if left is None else left
    rows = stored(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")), "documents")
    texts = rows.select(F.col("key").alias("id"), F.col("row")[text_col].cast("string").alias("text"))
    schema = "id long, item int, n_item long, n_shared long, containment double"
    dirty = _by_blocks(sets, int(blocks), lambda held: texts.mapInArrow(
        _search(held["item"].to_pylist(), held["members"].to_pylist(), pa.int32(), k, threshold, miss), schema))
    left = rows.join(dirty.select(F.col("id").alias("key")).distinct(), "key", "left_anti")
    return left.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def _clean(sets: list[bytes], at: int, k: int, threshold: float, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex([np.frombuffer(s, np.uint64) for s in sets], threshold, miss)
        for b in small(batches, at):
            keep = [not index.matches(s) for s in text_sets(b.column(at).cast(pa.string()), k)]
            yield b.filter(pa.array(keep, pa.bool_()))
    return run
