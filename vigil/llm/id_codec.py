"""Token ids in Simple-8b words.

A 64-bit word has a 4-bit selector on top and 60 bits of ids; the selector says how many ids of which
width follow from the low end up. An id that 60 bits can't hold is an escape: its word holds a place in the
chunk's table of whole ids. Ids are packed in blocks of ``BLOCK`` (a block begins with a new word), and the
offset of each block's first word is stored, so blocks are decoded independently and, with numpy, all words
of one selector at once.

A chunk is the bytes of: its id count, block count and escape count (little-endian 64-bit), the block
offsets (one more than blocks, 32-bit), the words, the escaped ids (64-bit). On disk, documents in
ascending id order fill shards (one Parquet file each); a row is a chunk with its shard, its first id's
place in the shard, its documents' ids and lengths, and its bytes.

Rules: a null text is empty and has only the end id. The string of an added token of the tokenizer file (such as
``<|endoftext|>``) within a text becomes that token's id, as by the library's default. Null document ids come first; equal ids are ordered
by text. A document is never split between chunks, so a very long text makes a chunk of its own. An empty
table makes no rows.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm._cuts import PieceIds
from vigil.llm._jobs import python_ready, scratch_path
from vigil.llm._text import small

#: How many ids a word of selector 0 to 15 holds, and of how many bits (15: the escape).
COUNTS = [240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1]
WIDTHS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64]
BLOCK = 1024
#: A chunk is closed when it has so many ids.
CHUNK_IDS = 1 << 20
ESCAPE = 15
_LIMITS = np.array([1 << w for w in WIDTHS[:-1]], np.uint64)
_COUNTS = np.array(COUNTS)
_SHORT = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _choices(width: np.ndarray) -> np.ndarray:
    """For each place the least selector whose whole word fits there; ``width`` has, for each id, the least
    selector that can hold it, a row a block, with at least COUNTS[0] zero columns behind."""
    out = np.full(width.shape, ESCAPE, np.uint8)
    widest, n = width, 1
    for s in range(len(COUNTS) - 2, -1, -1):
        while n < COUNTS[s]:  # widest: over the n ids from each place on
            step = min(n, COUNTS[s] - n)
            widest, n = np.concatenate([np.maximum(widest[:, :-step], widest[:, step:]), widest[:, -step:]], axis=1), n + step
        fits = widest <= s
        if not fits[:, :BLOCK].any():
            break
        out[fits] = s
    return out


def pack(ids: np.ndarray) -> bytes:
    """The bytes of a chunk of unsigned ids."""
    ids = np.asarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    values = np.zeros((blocks, BLOCK + COUNTS[0]), np.uint64)
    full = n // BLOCK
    values[:full, :BLOCK] = ids[:full * BLOCK].reshape(full, BLOCK)
    if n > full * BLOCK:
        values[full, :n - full * BLOCK] = ids[full * BLOCK:]
    short = not n or int(ids.max()) < len(_SHORT)
    choice = _choices(_SHORT[values.astype(np.uint16)] if short else np.searchsorted(_LIMITS, values, "right").astype(np.uint8))
    lengths = np.full(blocks, BLOCK)
    if blocks:
        lengths[-1] = n - (blocks - 1) * BLOCK
    at, live, steps = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):  # one word of every block that has ids left
        s = choice[live, at[live]]
        steps.append((live, at[live], s))
        at[live] += _COUNTS[s]
        live = live[at[live] < lengths[live]]
    if steps:
        block, place, selector = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((place, block))
        block, place, selector = block[order], place[order], selector[order]
    else:
        block = place = selector = np.zeros(0, np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        if s == ESCAPE:
            escaped = values[block[rows], place[rows]]
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
        elif WIDTHS[s]:
            k = np.arange(COUNTS[s])
            part = values[block[rows, None], place[rows, None] + k] << (k * WIDTHS[s]).astype(np.uint64)
            words[rows] |= np.bitwise_or.reduce(part, axis=1)
    if not (selector == ESCAPE).any():
        escaped = np.zeros(0, np.uint64)
    offsets = np.searchsorted(block, np.arange(blocks + 1)).astype("<u4")
    head = np.array([n, blocks, len(escaped)], "<u8")
    return head.tobytes() + offsets.tobytes() + words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()


def unpack(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (default: all) of a chunk; only the blocks they lie in are decoded."""
    n, blocks, n_escaped = np.frombuffer(data, "<u8", 3).tolist()
    last = n if last is None else min(last, n)
    if last <= first:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(data, "<u4", blocks + 1, 24).astype(np.int64)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), 24 + 4 * (blocks + 1))
    escaped = np.frombuffer(data, "<u8", n_escaped, len(data) - 8 * n_escaped)
    b0, b1 = first // BLOCK, (last - 1) // BLOCK + 1
    words, starts = words[offsets[b0]:offsets[b1]], offsets[b0:b1] - offsets[b0]
    selector = (words >> np.uint64(60)).astype(np.int64)
    holds = _COUNTS[selector]
    ends = np.append(starts[1:], len(words)) - 1
    size = np.full(b1 - b0, BLOCK)
    if b1 == blocks:
        size[-1] = n - (blocks - 1) * BLOCK
    holds[ends] -= np.add.reduceat(holds, starts) - size  # a block's last word may be filled in part
    place = np.cumsum(holds) - holds
    out = np.zeros(int(holds.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[place[rows]] = escaped[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif WIDTHS[s]:
            k = np.arange(COUNTS[s])
            got = (words[rows, None] >> (k * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << WIDTHS[s]) - 1)
            there = k < holds[rows, None]
            out[(place[rows, None] + k)[there]] = got[there]
    return out[first - b0 * BLOCK:last - b0 * BLOCK]


#: Pieces in each of the two tables of ids that a Python worker remembers.
REMEMBERED = 1 << 19


class LibraryCoder:
    """Ids of whole texts by a tokenizer file. Where the file cuts texts by the usual pattern, pieces of
    texts in code points up to U+024F are cut here and encoded by the library once; other texts are
    encoded whole. With ``added``, the string of an added token within a text has that token's id, as by the
    library's default, and a text with such a string is encoded whole; else it's text like any other."""

    def __init__(self, raw: bytes, added: bool = False) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(raw)
        self.tokenizer.encode_special_tokens = not added
        file = json.loads(raw)
        cutter = file["pre_tokenizer"] or {}
        self.usual = (cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
                      and not file["normalizer"] and all(t["special"] for t in file["added_tokens"]))
        self.pieces = PieceIds(self._ids, self._ids, REMEMBERED, [t["content"] for t in file["added_tokens"]] if added else [])

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, n + 1 offsets of the texts in them)."""
        if self.usual:
            return self.pieces.of(column)
        got = self._ids(column.to_pylist())
        return np.array([i for ids in got for i in ids], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)


_CODERS: dict[tuple[bytes, bool], LibraryCoder] = {}


def library_coder(raw: bytes, added: bool = False) -> LibraryCoder:
    key = hashlib.sha256(raw).digest(), added
    if key not in _CODERS:
        _CODERS[key] = LibraryCoder(raw, added)
    return _CODERS[key]


def with_end(flat: np.ndarray, cuts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id behind every text."""
    n = len(cuts) - 1
    out = np.full(len(flat) + n, end_id, np.uint32)
    out[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(cuts))] = flat
    return out, cuts + np.arange(n + 1)


def _write_batches(raw: bytes, end_id: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = library_coder(raw, added=True), TaskContext.get().partitionId()
        docs, lengths, held, seen = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            nonlocal docs, lengths, held, seen
            n = sum(lengths)
            row = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([seen], pa.int64()), pa.array([n], pa.int64()), pa.array([docs], pa.list_(id_type)),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([pack(np.concatenate(held))], pa.binary())],
                ["shard", "first", "n_ids", "doc_ids", "lengths", "words"])
            docs, lengths, held, seen = [], [], [], seen + n
            return row

        for b in small(batches, 1):
            flat, cuts = with_end(*coder.encode(b.column(1)), end_id)
            ids, at, size = b.column(0).to_pylist(), 0, sum(lengths)
            while at < len(ids):
                to = min(len(ids), max(at + 1, int(np.searchsorted(cuts, cuts[at] + CHUNK_IDS - size))))
                docs += ids[at:to]
                lengths += np.diff(cuts[at:to + 1]).tolist()
                held.append(flat[cuts[at]:cuts[to]])
                at, size = to, sum(lengths)
                if size >= CHUNK_IDS:
                    yield chunk()
                    size = 0
        if docs:
            yield chunk()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the shards under ``path``, ascending by ``id_col``.

    Documents are dealt to shards by ranges of (id, text hash); the tokenizer file is read on the driver
    and travels with the tasks.
    """
    python_ready(docs.sparkSession)
    with open(tokenizer_file, "rb") as f:
        raw = f.read()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
                           T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())),
                           T.StructField("words", T.BinaryType())])
    arrow_kind = to_arrow_type(kind)
    order = ["id", F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions("id", "text")
     .mapInArrow(_write_batches(raw, end_id, arrow_kind), schema).write.parquet(path))


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in range(b.num_rows):
            at = b.column(0)[r].as_py()
            ids = unpack(b.column(3)[r].as_py()).astype("<u4")
            docs, lengths = b.column(1)[r].values, np.array(b.column(2)[r].as_py(), np.int64)
            cuts = np.concatenate([[0], np.cumsum(lengths)])
            crc = [zlib.crc32(ids[x:y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([docs, pa.array(at + cuts[:-1], pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                                             ["id", "start", "n_tokens", "ids_crc32"])


def read_digest(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the shards under ``path``."""
    python_ready(spark)
    chunks = spark.read.parquet(path)
    # one row a shard, so as many as the write had partitions: small enough for one task and for a broadcast
    sums = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    kind = T.StructType([T.StructField("id", chunks.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
                         T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return (chunks.join(F.broadcast(before), "shard").select((F.col("before") + F.col("first")).alias("at"), "doc_ids", "lengths", "words")
            .mapInArrow(_read_batches, kind).withColumnRenamed("id", id_col))


def encoded_digest(docs: DataFrame, tokenizer_file: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of ``docs`` to a new folder under the shared one and read them back."""
    path = scratch_path(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer_file, end_id, id_col, text_col)
    return read_digest(docs.sparkSession, path, id_col)
