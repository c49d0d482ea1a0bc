"""Byte-level BPE by a table of last tokens.

For every prefix of a piece there is exactly one token that ends the prefix's encoding. The table of
these tokens is filled left to right: of the vocabulary's tokens that end at a position, the valid one is
the token that encodes, side by side with the last token of the prefix before it, as just these two. The
encoding is read off the table backwards. So bytes can be appended with the encoding staying exact, and an
edit needs new entries only from the edited place to where the table agrees with the old one again.

Texts are first cut by a pattern into pieces; a piece that is itself a token is that token. Encodings of
pieces are remembered per Python worker, a bounded number of them.

Rules: a null text is an empty one, without tokens. Any text round-trips byte by byte. Very long texts and
pieces take time in proportion to their length; rows are independent, so order, ties, repeated rows and
other columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._cuts import USUAL, PieceIds
from vigil.llm._jobs import python_ready
from vigil.llm._text import small

#: Pieces and token pairs that a Python worker remembers.
REMEMBERED, PAIRS = 1 << 18, 200_000
_NONE = 1 << 62


class Vocabulary:
    """Token bytes with their ranks (a token's id is its rank)."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        #: Every ending of a token; True: it is a token itself, one that merges make (found out on first use).
        self.endings: dict[bytes, bool | None] = dict.fromkeys(t[i:] for t in ranks for i in range(1, len(t)))
        self.endings = dict.fromkeys(self.endings, False) | dict.fromkeys(ranks)
        self._parts: dict[bytes, tuple[bytes, ...]] = {}
        self._spines: dict[tuple[bytes, bool], tuple[list[bytes], list[int]] | None] = {}
        self._pairs: dict[tuple[bytes, bytes], bool] = {}

    @classmethod
    def parse(cls, raw: bytes) -> Vocabulary:
        """From the text of a rank file: one base64 token and its rank a line."""
        lines = (line.split() for line in raw.splitlines() if line)
        return cls({base64.b64decode(t): int(i) for t, i in lines})

    def merged(self, data: bytes, below: int = _NONE) -> list[bytes]:
        """Plain merging, least rank first, with merges of a rank under ``below``: defines validity."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], _NONE), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def parts(self, token: bytes) -> tuple[bytes, ...]:
        """The parts of a token before its last merge: two, one for a single byte; more if no merge makes it."""
        if token not in self._parts:
            self._parts[token] = tuple(self.merged(token, self.ranks[token]))
        return self._parts[token]

    def check(self) -> Vocabulary:
        """Refuse ranks under which the table's entries wouldn't be unique: a token that plain merging makes,
        but only through merges of higher ranks than its own."""
        for token in self.ranks:
            if len(self.parts(token)) > 2 and self.merged(token) == [token]:
                raise ValueError(f"the rank of {token!r} is below those of the merges that make it")
        return self

    def _spine(self, token: bytes, right: bool) -> tuple[list[bytes], list[int]] | None:
        """What stands at the token's right (left) end as its merges go on, and the ranks at which that
        changes; None if the ranks don't rise."""
        if (token, right) not in self._spines:
            ends = [token]
            while len(ends[-1]) > 1:
                ends.append(self.parts(ends[-1])[-1 if right else 0])
            ends.reverse()
            at = [self.ranks[e] for e in ends[1:]]
            self._spines[token, right] = (ends, [*at, _NONE]) if at == sorted(at) else None
        return self._spines[token, right]

    def side_by_side(self, a: bytes, b: bytes) -> bool:
        """Whether a + b encodes as the tokens a, b."""
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        left, right = self._spine(a, True), self._spine(b, False)
        known = self.merged(a + b) == [a, b] if left is None or right is None else self._apart(left, right)
        self._pairs[a, b] = known
        return known

    def ending(self, token: bytes) -> bool:
        self.endings[token] = made = len(self.parts(token)) <= 2
        return made

    def _apart(self, left: tuple[list[bytes], list[int]], right: tuple[list[bytes], list[int]]) -> bool:
        """Merges of both sides in the order of their ranks: does one across the border come first?
        At equal ranks the merge further left comes first."""
        (lefts, l_at), (rights, r_at), i, j = left, right, 0, 0
        rank = self.ranks.get
        while True:
            across, x, y = rank(lefts[i] + rights[j], _NONE), l_at[i], r_at[j]
            if across < x and across <= y and across < _NONE:
                return False
            if x == _NONE and y == _NONE:
                return True
            if x <= y:
                i += 1
            else:
                j += 1


class PrefixTable:
    """The last token of every prefix of a byte string, kept exact under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _extend(self, until: int) -> None:
        """Entries up to that many bytes: the longest valid token that ends at each place."""
        v, data, last = self.vocabulary, self.data, self.last
        kind, pair = v.endings.get, v._pairs.get
        for end in range(len(last) + 1, until + 1):
            found, n = [], 1
            while n <= end:
                token = data[end - n:end]
                made = kind(token, _NONE)
                if made == _NONE:
                    break
                if made or made is None and v.ending(token):
                    found.append(token)
                n += 1
            while found:
                token = found.pop()
                n = end - len(token)
                if not n:
                    break
                apart = pair((last[n - 1], token))
                if apart or apart is None and v.side_by_side(last[n - 1], token):
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")
            last.append(token)

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start to end; returns how many entries were computed anew. An entry
        depends on at most ``longest`` bytes and entries before it, so once that many agree, the rest do."""
        old, shift = self.last, start + len(new) - end
        self.data = self.data[:start] + new + self.data[end:]
        self.last, agree, done = old[:start], 0, 0
        while len(self.last) < len(self.data):
            at = len(self.last)
            if agree >= self.vocabulary.longest:
                self.last += old[at - shift:]
                break
            self._extend(at + 1)
            done += 1
            agree = agree + 1 if at >= start + len(new) and old[at - shift] == self.last[-1] else 0
        return done

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.vocabulary.ranks[self.last[end - 1]])
            end -= len(self.last[end - 1])
        return out[::-1]


class TextCoder:
    """Whole texts to ids and back."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        import regex

        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.decimal = {i: str(i) for i in vocabulary.bytes_of}
        self.pieces = PieceIds(lambda new: [self.piece(p) for p in new], self.whole, REMEMBERED) if pattern == USUAL else None

    def piece(self, text: str) -> list[int]:
        data = text.encode()
        whole = self.vocabulary.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()

    def whole(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of texts cut by the pattern as it stands; each different piece of them is encoded once."""
        cut = [self.find(t or "") for t in texts]
        known = {p: self.piece(p) for p in set().union(*cut)}
        return [[i for p in pieces for i in known[p]] for pieces in cut]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, n + 1 offsets of the texts in them)."""
        if self.pieces is not None:
            return self.pieces.of(column)
        got = self.whole(column.to_pylist())
        return np.array([i for ids in got for i in ids], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def joined(self, ids: list[int]) -> str:
        """Ids in decimal, joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))


_CODERS: dict[bytes, TextCoder] = {}


def coder(raw: bytes, pattern: str) -> TextCoder:
    """The worker's coder for a rank file."""
    key = hashlib.sha256(raw + pattern.encode()).digest()
    if key not in _CODERS:
        _CODERS[key] = TextCoder(Vocabulary.parse(raw), pattern)
    return _CODERS[key]


def _batches(raw: bytes, pattern: str, keep: list[int], text_at: int, names: list[str], ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(raw, pattern)
        for b in small(batches, text_at):
            flat, cuts = c.encode(b.column(text_at).cast(pa.string()))
            sha, back = [], []
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own = flat[x:y].tolist()
                sha.append(hashlib.sha256(c.joined(own).encode()).hexdigest())
                back.append(hashlib.sha256(c.decode(own)).hexdigest())
            out = [pa.array(np.diff(cuts), pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            if ids:
                out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.view(np.int32))))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), *out], names)
    return run


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", keep: list[str] | None = None,
                 ids: bool = True) -> DataFrame:
    """The columns ``keep`` (default: all but the text and result names), n_tokens, ids_sha256 (decimal ids
    joined by commas), decoded_sha256 (bytes decoded from the ids) and, if asked for, ids as an array.

    The rank file is read on the driver and travels with the tasks.
    """
    python_ready(docs.sparkSession)
    with open(rank_file, "rb") as f:
        raw = f.read()
    Vocabulary.parse(raw).check()
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()), *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else [])]
    keep = [c for c in docs.columns if c != text_col and c not in {f.name for f in made}] if keep is None else keep
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = T.StructType([*(rows.schema[c] for c in keep), *made])
    return rows.mapInArrow(_batches(raw, pattern, list(range(len(keep))), len(keep), schema.names, ids), schema)
