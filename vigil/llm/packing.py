"""Documents packed into sequences of bounded length by linear grouping.

Texts are encoded and cut into pieces of at most ``capacity`` tokens. Pieces that fill a sequence have one of
their own. All others get their place by descending length: a range-partitioned sort numbers them, and the
counts of their lengths (at most ``capacity`` numbers) are all that the driver needs for a plan
(``packing_plan``). Large pieces (a quarter of the capacity or more) take the places that the plan's configurations have for their
group; the sequences' free tokens are then measured with the real lengths, sequences are numbered by them,
and small pieces fill them by best fit.

Every step is arithmetic on a row's place, so no task holds more than its rows and the plan; a group in a
shuffle is one sequence, at most ``capacity`` pieces. The numbers are stored before they are used, so a lost executor's
rows come back with the same ones.

Rules: a null text is empty and has only the end id; only documents of more than ``capacity`` tokens are cut,
into pieces of ``capacity`` tokens, the last of which may be shorter; repeated rows are packed as often as they stand; an
empty table makes no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._cuts import FAR, classes
from vigil.llm._jobs import python_ready, stored
from vigil.llm._remember import Remembered
from vigil.llm._text import buffer, small, word_spans
from vigil.llm.packing_plan import LargePlan, SmallPlan

#: Bytes of text that are encoded at a time.
TEXT_BYTES = 1 << 22
#: Words whose ids a Python worker remembers.
REMEMBERED = 1 << 19
#: Words that are encoded as one text.
JOINED = 1024
#: The parts of a tokenizer file by which texts fall apart at white space.
_BLANKS = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
_PER_CHARACTER = ({"type": "NFC"}, _BLANKS, {"type": "Lowercase"})
_LETTERS_ONLY = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
_NO_SPACE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def pieces_of(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end) of pieces that are encoded on their own: words, cut where letters, numbers and other characters meet, with A-Z as a-z.
    Words with an apostrophe (contractions), '<' (added tokens) or characters beyond U+024F or of a longer lower case stay as they are."""
    start, end = word_spans(raw, offs)
    if not len(start):
        return raw, start, end
    kind = classes(raw)
    odd = (kind == FAR) | (raw == ord("'")) | (raw == ord("<"))
    odd[1:] |= (raw[1:] == 0xB0) & (raw[:-1] == 0xC4)  # U+0130
    whole = np.zeros(len(start), bool)
    at = np.flatnonzero(odd)
    word = np.searchsorted(start, at, "right") - 1
    whole[word[(word >= 0) & (at < end[word])]] = True
    folded = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    for a, b in zip(start[whole].tolist(), end[whole].tolist()):
        folded[a:b] = raw[a:b]
    meet = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    word = np.searchsorted(start, meet, "right") - 1
    inner = (word >= 0) & (meet > start[word]) & (meet < end[word])
    meet, word = meet[inner], word[inner]
    meet = meet[~whole[word]]
    start = np.sort(np.concatenate([start, meet]))
    return folded, start, np.sort(np.concatenate([end, meet]))


class WordCoder:
    """Ids of whole texts by a tokenizer file. Where the file drops white space and lets nothing reach across it,
    pieces of words are encoded by the library once and remembered; else texts are encoded whole."""

    def __init__(self, raw: bytes) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(raw)
        file = json.loads(raw)
        first = ((file["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.by_word = ((file["normalizer"] or {}).get("normalizers") is not None and all(x in _PER_CHARACTER for x in file["normalizer"]["normalizers"])
                        and first == {"type": "Split", "pattern": {"Regex": _NO_SPACE}, "behavior": "Removed", "invert": True}
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in file["added_tokens"]))
        suffix = file["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for t, i in file["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.words = Remembered(self._piece_ids, REMEMBERED)

    def _piece_ids(self, texts: list[str]) -> list:
        """Ids of pieces. Those of letters only are encoded many at a time, parted by blanks: each ends with the one token of it that ends a word."""
        plain = [i for i, t in enumerate(texts) if _LETTERS_ONLY.fullmatch(t)] if self.ends.any() else []
        joined = [" ".join(texts[i] for i in plain[k:k + JOINED]) for k in range(0, len(plain), JOINED)]
        got = self._ids(joined)
        flat = np.array([i for ids in got for i in ids], np.uint32)
        cuts = np.flatnonzero(self.ends[flat]) + 1
        if len(cuts) != len(plain):
            return self._ids(texts)
        out: list = [None] * len(texts)
        for i, ids in zip(plain, np.split(flat, cuts[:-1]) if plain else []):
            out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._ids([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, n + 1 offsets of the texts in them)."""
        if not self.by_word:
            got = self._ids(column.to_pylist())
            return np.array([i for ids in got for i in ids], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)
        raw, offs = buffer(column)
        raw, start, end = pieces_of(raw, offs)
        flat, count = self.words.of(raw, start, end)
        return flat, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, offs)].astype(np.int64)


_CODERS: dict[bytes, WordCoder] = {}


def word_coder(raw: bytes) -> WordCoder:
    key = hashlib.sha256(raw).digest()
    if key not in _CODERS:
        _CODERS[key] = WordCoder(raw)
    return _CODERS[key]


def cut(cuts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of the pieces of documents whose ids end at ``cuts``."""
    size = np.diff(cuts)
    n = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    return doc, piece, start, np.minimum(size[doc] - start, capacity)


def _cut_batches(raw: bytes, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(raw)
        for b in small(batches, 1, TEXT_BYTES):
            flat, cuts = coder.encode(b.column(1))
            n = len(cuts) - 1
            ids = np.full(len(flat) + n, end_id, "<u4")
            ids[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(cuts))] = flat
            doc, piece, start, length = cut(cuts + np.arange(n + 1), capacity)
            ends = np.concatenate([[0], np.cumsum(length)])
            held = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                                              held.cast(pa.binary())], ["id", "piece", "start", "length", "ids"])
    return run


def cut_texts(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, piece, start, length, ids) of all pieces, stored; ``ids`` are little-endian unsigned 32-bit numbers."""
    python_ready(docs.sparkSession)
    with open(tokenizer_file, "rb") as f:
        raw = f.read()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    pieces = rows.mapInArrow(_cut_batches(raw, end_id, capacity), schema)
    return stored(pieces.select(F.monotonically_increasing_id().alias("row"), "*"), "pieces")


def numbered(rows: DataFrame, *order, spread: str) -> DataFrame:
    """The rows with ``rank``, their place in the order from 0; ties go by the unique column ``spread``. Stored.

    Rows are dealt out by ranges of (order, hash of ``spread``), so one value that many rows have is no task's alone.
    Broadcast: one number for each partition of the sort.
    """
    keys = [*order, F.xxhash64(spread)]
    at = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys, spread).withColumn("at_", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at_", 33)
    sums = at.groupBy(part.alias("part_")).agg(F.count("*").alias("n_"))
    before = sums.select("part_", (F.sum("n_").over(Window.orderBy("part_")) - F.col("n_")).alias("before_"))
    return (at.withColumn("part_", part).join(F.broadcast(before), "part_")
            .withColumn("rank", F.col("before_") + F.col("at_").bitwiseAND(F.lit((1 << 33) - 1))).drop("at_", "part_", "before_"))


def _counts(rows: DataFrame, column: str, most: int) -> np.ndarray:
    out = np.zeros(most + 1, np.int64)
    for r in rows.groupBy(column).agg(F.count("*").alias("n")).collect():  # at most ``most`` rows
        out[r[0]] = r["n"]
    return out


def _place(plan, by_length: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            at = plan.sequences(length, rank) if by_length else plan.sequences(rank)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64())], ["row", "length", "sequence"])
    return run


def place(rows: DataFrame, capacity: int) -> DataFrame:
    """(row, sequence_id, offset) of stored ``rows`` (row, length): lengths from 1 to ``capacity``, ``row`` unique."""
    python_ready(rows.sparkSession)
    least = max(1, capacity // 4)
    items = rows.filter(F.col("length") < capacity).select("row", "length")
    counts = _counts(items, "length", capacity)
    ranked = numbered(items, F.col("length").desc(), spread="row").select("row", "length", "rank")
    schema = "row long, length long, sequence long"
    large = ranked.filter(F.col("length") >= least).mapInArrow(_place(LargePlan(counts, capacity, least), False), schema)
    # a sequence has at most four large pieces
    shared = large.groupBy("sequence").agg((F.lit(capacity) - F.sum("length")).alias("free"), F.collect_list(F.struct("row", "length")).alias("items"))
    bins = numbered(shared, F.col("free"), spread="sequence")
    room = _counts(bins, "free", capacity)
    plan = SmallPlan(counts, capacity, least, [(free, int(n)) for free, n in enumerate(room.tolist()) if n])
    little = ranked.filter(F.col("length") < least).mapInArrow(_place(plan, True), schema)
    both = bins.select(F.col("rank").alias("sequence"), F.explode("items").alias("i")).select("i.row", "i.length", "sequence").unionByName(little)
    before = Window.partitionBy("sequence").orderBy(F.col("length").desc(), "row")
    packed = both.select("row", F.col("sequence").alias("sequence_id"), (F.sum("length").over(before) - F.col("length")).alias("offset"))
    whole = rows.filter(F.col("length") == capacity)
    return packed.unionByName(whole.select("row", (F.col("row") + plan.n).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document: id, piece, start, length, ids (binary), sequence_id, offset."""
    pieces = cut_texts(docs, tokenizer_file, end_id, capacity, id_col, text_col)
    return pieces.join(place(pieces.select("row", "length"), capacity), "row").drop("row").withColumnRenamed("id", id_col)


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The sequences of ``pack``'s rows: sequence_id, n_tokens, ids (binary), parts (id, piece, start, length, offset), in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", F.col(id_col).alias("id"), "piece", "start", "ids")), lambda a, b: (a["offset"] - b["offset"]).cast("int"))
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("held"))
    return held.select("sequence_id", "n_tokens", F.unhex(F.array_join(F.transform("held", lambda p: F.hex(p["ids"])), "")).alias("ids"),
                       F.transform("held", lambda p: F.struct(p["id"].alias(id_col), p["piece"].alias("piece"), p["start"].alias("start"), p["length"].alias("length"), p["offset"].alias("offset"))).alias("parts"))


def write_sequences(packed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The sequences as Parquet: what a training job reads."""
    sequences(packed, id_col).write.parquet(path)
