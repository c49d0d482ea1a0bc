"""A keyword index beside a stored posts table (PF-1).

The search for posts that contain all terms of a keyword, in any case, reads every text. The index has, for each trigram of
characters, the blocks of posts with a text that holds it. A keyword's trigrams are looked up there; only
the blocks that hold all trigrams of all terms can hold a hit, and only files with such blocks are read. The exact test follows on
what is read, so the result is the plain search's. Terms of fewer than three characters have no trigram and restrict nothing.

Posts are written in order of their day and id and numbered in blocks (``ROWS_A_BLOCK`` rows or so). A file holds one block while they are few, and about
``ROWS_A_FILE`` rows of many, so the files (and the tasks that write and read them) grow with the rows, not with the blocks. A trigram's
postings are at most one row a block, and the trigrams table is written sorted by trigram, so a look-up reads the row groups that
can hold it. A trigram is stored as one number, of 21 bits a character. Terms hold no blanks, so trigrams with blanks are never
looked up and aren't stored. A block's trigrams are gathered where its rows are read (numpy, in ``mapInArrow``), so postings are
shuffled, not the trigrams of every text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.search import PostFilter, search_posts
from vigil.session import materialize, ship_package

ROWS_A_BLOCK = 20_000
ROWS_A_FILE = 20_000
#: Files of one block each, while the blocks are no more.
FEW_FILES = 64
#: Characters whose trigrams a task holds at once, or one longer text.
PIECE_CHARS = 1 << 20
#: Candidate blocks that are named to the scan; of more, it reads their files whole.
NAMED_BLOCKS = 1000
#: The stored posts' column with the block: the number of its first row.
BLOCK = "block__"


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text. Null or shorter text: none."""
    # one regex pass with a look-ahead, so it is linear in the text
    each = F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))."), F.lit(1))
    return F.coalesce(F.array_distinct(each), F.array().cast("array<string>"))


def keyword_trigrams(keyword: str) -> list[str]:
    """The trigrams that every hit's text holds."""
    terms = [t.lower() for t in keyword.split()]
    return sorted({t[i:i + 3] for t in terms for i in range(len(t) - 2)})


def trigram_number(trigram: str) -> int:
    """21 bits for each of the three characters."""
    a, b, c = map(ord, trigram)
    return a << 42 | b << 21 | c


def _numbers(texts: list[str]) -> np.ndarray:
    """The distinct trigrams without blanks of the texts, as ascending numbers."""
    chars = np.frombuffer(" ".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    full = (chars != 0x20) & ((chars < 0x09) | (chars > 0x0D))
    at = np.flatnonzero(full[:-2] & full[1:-1] & full[2:])
    return np.unique(chars[at] << 42 | chars[at + 1] << 21 | chars[at + 2])


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    """The texts in pieces of about ``PIECE_CHARS`` characters; a longer text is a piece of its own."""
    piece, size = [], 0
    for t in texts:
        if piece and size + len(t) > PIECE_CHARS:
            yield piece
            piece, size = [], 0
        piece.append(t)
        size += len(t)
    if piece:
        yield piece


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, lower-cased text), a block's rows side by side -> (block, trigram), each once but where a block is cut between tasks."""
    def out(block: int, found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block, np.int64)), pa.array(found, pa.int64())], ["block", "trigram"])

    at, found = None, np.zeros(0, np.int64)
    for b in batches:
        block = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)] if len(block) else []
        for i, to in zip(cuts[:-1], cuts[1:]):
            if block[i] != at:
                if len(found):
                    yield out(at, found)
                at, found = int(block[i]), np.zeros(0, np.int64)
            for piece in _pieces(b.column(1).slice(i, to - i).drop_null().to_pylist()):
                more = _numbers(piece)
                found = np.union1d(found, more) if len(found) else more
    if len(found):
        yield out(at, found)


class KeywordIndex:
    """Posts and their index under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, posts: DataFrame, text: str = "tweet", order: Sequence[str] = ("date", "post_id"), rows_a_block: int = ROWS_A_BLOCK) -> None:
        """Replace the stored posts and the index."""
        rows = posts.count()
        blocks = max(1, -(-rows // rows_a_block))
        files = min(blocks, max(FEW_FILES, -(-rows // ROWS_A_FILE)))
        row = F.col(BLOCK)
        (posts.repartitionByRange(files, *order, F.xxhash64(text)).sortWithinPartitions(*order)
         .withColumn(BLOCK, F.monotonically_increasing_id())  # the partition's number above 33 bits of the row's within it
         .withColumn(BLOCK, row - row.bitwiseAND(F.lit((1 << 33) - 1)) % rows_a_block)
         .write.mode("overwrite").option("maxRecordsPerFile", 2 * max(rows_a_block, ROWS_A_FILE)).parquet(f"{self.path}/posts"))
        stored = self.spark.read.parquet(f"{self.path}/posts").select(F.col(BLOCK).alias("block"), F.col("_metadata.file_name").alias("file"), F.col(text).alias("text"))
        stored.select("block", "file").distinct().write.mode("overwrite").parquet(f"{self.path}/blocks")
        ship_package(self.spark)
        held = stored.select("block", F.lower("text")).mapInArrow(_postings, "block long, trigram long")
        held.repartitionByRange("trigram").sortWithinPartitions("trigram", "block").write.mode("overwrite").parquet(f"{self.path}/trigrams")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/posts")

    def posts(self) -> DataFrame:
        return self._stored().drop(BLOCK)

    def _blocks(self, wanted: Sequence[str]) -> DataFrame:
        """(block, file) of the blocks that hold all ``wanted`` trigrams; a block that was cut between two files has both."""
        held = self.spark.read.parquet(f"{self.path}/trigrams").filter(F.col("trigram").isin([trigram_number(t) for t in wanted]))
        both = held.groupBy("block").agg(F.count_distinct("trigram").alias("n")).filter(F.col("n") == len(wanted)).select("block")
        return self.spark.read.parquet(f"{self.path}/blocks").join(both, "block")

    def _files(self, found: DataFrame) -> list[str]:
        return sorted(r["file"] for r in found.select("file").distinct().collect())

    def files(self, keyword: str) -> list[str] | None:
        """The names of the files that can hold a hit; None where the keyword restricts nothing. At most the number of files."""
        wanted = keyword_trigrams(keyword)
        return self._files(self._blocks(wanted)) if wanted else None

    def search(self, f: PostFilter, lists: DataFrame | None = None) -> DataFrame:
        """``search_posts`` over the stored posts, reading only files (and of few blocks only these) that can hold the keyword."""
        wanted = keyword_trigrams(f.keyword) if f.keyword and not f.custom_query else []
        posts = self._stored()
        if wanted:
            found, schema = materialize(self._blocks(wanted)), posts.schema
            files = self._files(found)
            posts = (self.spark.read.schema(schema).parquet(*[f"{self.path}/posts/{name}" for name in files]) if files
                     else self.spark.createDataFrame([], schema))
            named = [r["block"] for r in found.select("block").distinct().limit(NAMED_BLOCKS + 1).collect()]
            if len(named) <= NAMED_BLOCKS:
                posts = posts.filter(F.col(BLOCK).isin(named))
        return search_posts(posts.drop(BLOCK), f, lists)
