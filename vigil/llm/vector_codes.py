"""Vectors as short codes: each of a vector's equal parts is the number of the nearest entry of its codebook.

Codebooks are trained by Lloyd's rounds over all vectors, and only entries that moved are looked at again. Every part keeps
its entry and the exact distance to it. In the next round a part whose entry stayed where it was compares that distance with
the moved entries only: all others are as far as before, and lost then. A part whose entry moved looks at all of them.
Ties go to the entry with the lower number, among moved and unmoved alike, so codes equal those of a full search.

Distances and sums are whole numbers (``_vectors``), so results don't depend on the order or number of tasks. A round is one
pass that writes every vector's codes and distances and one that adds up parts by entry (sums are combined a task); the driver gets
the sums of the entries, a table whose size is that of the codebooks.

Rules: vectors that take no part (null, or a null or non-finite component) have no row; a length that doesn't divide into
the parts is filled up with zeros; codebooks start as the vectors of the least ids (null ids last, equal ids by
their components), so they have fewer entries where there are fewer vectors; an entry without parts stays; an empty table makes no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._jobs import broadcast_if_small, python_ready, stored
from vigil.llm._vectors import bound, matrix, packed, slices, unpacked, usable, width


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest entry; of equally near ones the first."""
    gap = x[:, None, :] - entries
    far = np.einsum("ijk,ijk->ij", gap, gap)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(x)), code]


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` from the last round's numbers and distances; ``moved`` tells which entries changed since."""
    code, far = code.astype(np.int64), far.copy()
    lost = moved[code]
    again = np.flatnonzero(lost)
    active = np.flatnonzero(moved)
    stay = np.flatnonzero(~lost)
    if len(stay) and len(active):
        got, away = nearest(x[stay], entries[active])
        got = active[got]
        better = (away < far[stay]) | (away == far[stay]) & (got < code[stay])
        code[stay[better]], far[stay[better]] = got[better], away[better]
    if len(again):
        code[again], far[again] = nearest(x[again], entries)
    return code, far


class Codebooks:
    """``entries[p][e]`` is entry e of part p."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.moved = np.ones(entries.shape[:2], bool)

    def parts(self, x: np.ndarray) -> np.ndarray:
        """The vectors' parts: (part, vector, component)."""
        return np.ascontiguousarray(x.reshape(len(x), len(self.entries), -1).transpose(1, 0, 2))

    def assign(self, x: np.ndarray, code: np.ndarray | None, far: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(codes, distances) of vectors, a column a part; from those of the last round, or None in the first."""
        new_code, new_far = np.empty((len(x), len(self.entries)), np.uint16), np.empty((len(x), len(self.entries)), np.int64)
        for p, part in enumerate(self.parts(x)):
            new_code[:, p], new_far[:, p] = nearest(part, self.entries[p]) if code is None else reassign(part, self.entries[p], self.moved[p], code[:, p], far[:, p])
        return new_code, new_far

    def updated(self, sums: Sequence[tuple[int, int, int, int, int]]) -> Codebooks:
        """Entries replaced by their parts' mean, from (part, entry, component, sum, count)."""
        entries = self.entries.copy()
        for p, e, i, total, n in sums:
            entries[p, e, i] = total // n
        out = Codebooks(entries)
        out.moved = (entries != self.entries).any(axis=2)
        return out

    def sha256(self) -> str:
        """Of all components as decimal numbers joined by commas, in the order part, entry, component."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _first_pass(books: Codebooks, dim: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, dim):
            x = matrix(b.column(1), dim, most)
            code, far = books.assign(x, None, None)
            yield pa.RecordBatch.from_arrays([b.column(0), packed(x, "<i4"), packed(code, "<u2"), packed(far, "<i8")], ["row", "x", "code", "far"])
    return run


def _next_pass(books: Codebooks, dim: int):
    parts = len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, dim):
            code, far = books.assign(unpacked(b.column(1), "<i4", dim).astype(np.int64), unpacked(b.column(2), "<u2", parts), unpacked(b.column(3), "<i8", parts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(code, "<u2"), packed(far, "<i8")], ["row", "x", "code", "far"])
    return run


def _sums(books: Codebooks, dim: int):
    parts, n_entries, step = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, n_entries, step), np.int64), np.zeros((parts, n_entries), np.int64)
        for b in slices(batches, dim):
            part = books.parts(unpacked(b.column(0), "<i4", dim).astype(np.int64))
            code = unpacked(b.column(1), "<u2", parts)
            for p in range(parts):
                np.add.at(total[p], code[:, p], part[p])
                count[p] += np.bincount(code[:, p], minlength=n_entries)
        p, e = np.nonzero(count)
        i = np.tile(np.arange(step), len(p))
        p, e = np.repeat(p, step), np.repeat(e, step)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()), pa.array(total[p, e, i]), pa.array(count[p, e])],
                                         ["part", "entry", "component", "total", "n"])
    return run


def _vectors_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = len(b.column(1)[0].as_py()) // 2 if b.num_rows else 0
        code, far = unpacked(b.column(1), "<u2", n), unpacked(b.column(2), "<i8", n)
        flat = pa.array(code.ravel().astype(np.int32))
        codes = pa.ListArray.from_arrays(pa.array(np.arange(len(code) + 1, dtype=np.int32) * n), flat)
        yield pa.RecordBatch.from_arrays([b.column(0), codes, pa.array(far.sum(axis=1))], ["row", "codes", "error"])


def train_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id", vector_col: str = "embedding",
                keep: Sequence[str] = ()) -> tuple[DataFrame, Codebooks]:
    """((id, kept columns, codes, error) of every vector that takes part, the codebooks).

    ``codes`` has the entry's number for each part, ``error`` is the squared distance to the vector that they stand for.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    kept = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]).alias("row")
    rows = vectors.filter(usable(vector_col)).select(kept, F.col(vector_col).cast("array<double>").alias("x"))
    step = -(-width(rows, "x") // parts)
    dim = step * parts
    most = bound(dim, 4)
    first = rows.orderBy(F.col("row.id").asc_nulls_last(), "x").limit(entries).select("x").toArrow()
    start = matrix(first.column(0), dim, most)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, step).transpose(1, 0, 2)))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *[T.StructField(c, T.BinaryType()) for c in ("x", "code", "far")]])
    state = stored(rows.mapInArrow(_first_pass(books, dim, most), schema), "codes")
    for _ in range(rounds):
        sums = state.select("x", "code").mapInArrow(_sums(books, dim), "part int, entry int, component int, total long, n long")
        total = sums.groupBy("part", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # of the codebooks' size
        books = books.updated([tuple(r) for r in total])
        state = stored(state.mapInArrow(_next_pass(books, dim), schema), "codes")
    kind = T.StructType([schema["row"], T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    out = state.select("row", "code", "far").mapInArrow(_vectors_out, kind)
    return out.select(F.col("row.id").alias(id_col), *[F.col(f"row.k{i}").alias(c) for i, c in enumerate(keep)], "codes", "error"), books


def decode(codes: Sequence[Sequence[int]], books: Codebooks) -> np.ndarray:
    """The vectors that codes stand for, in the units of the components (x * 256)."""
    at = np.asarray(codes, np.int64)
    return books.entries[np.arange(len(books.entries)), at].reshape(len(at), -1)


def coded_digest(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """id, code (two hex digits a part), error, the label's summed error, and the codebooks' digest.

    Labels' errors are summed before the shuffle, and come back by a broadcast of measured size, else by a join, whose hot labels
    Spark splits. Sums beyond 64 bits count as the largest number.
    """
    coded, books = train_codes(vectors, parts, entries, rounds, id_col, vector_col, [label_col])
    rows = stored(coded.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), "")).alias("code"), "error"), "coded")
    of = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = stored(rows.groupBy("label").agg(F.least(of, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long").alias("label_error")), "label_errors")
    same = rows["label"].eqNullSafe(sums["label"])
    return (rows.join(broadcast_if_small(sums), same).select(F.col("id").alias(id_col), "code", "error", "label_error")
            .withColumn("codebooks_sha256", F.lit(books.sha256())))
