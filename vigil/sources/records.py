"""Records of CSV files whose quoted texts may hold line breaks, read by all splits of a file in parallel.

The built-in multi-line mode reads a whole file in one task, since a split can't tell whether its first line lies
within quotes. Here physical lines are read split by split, and whether they do is worked out in two passes:

1. For each line, natively: does it end within quotes if it starts outside, and if it starts within? Each line, and by
   composition each split, so is a function of two states. A split gives its function, and how many records begin in
   it either way: one row a split.
2. The splits' functions, composed in the order of their file, give every split's first state and the number of
   its first record. The lines are read again and numbered; a record of one line passes as it is, the lines of others are
   put together by (file, record number), also across a split border.

Where no line has an open or odd quote (pass 1 finds none) every line is a record and no Python runs. A record's number is
its exact place in the file.

Quotes count as the plain reader takes them: a quote opens a text only at the start of a field, a doubled one within it is a
quote, a backslash means nothing. A file that ends within quotes is an error, as its last text has no end. Lines end at
LF or CR LF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.operators.joins import broadcast_if_bounded
from vigil.session import materialize, ship_package

#: ASCII-compatible: line ends and quotes are the same bytes in the file.
ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII", "WINDOWS-1252")


def _patterns(sep: str, quote: str) -> tuple[str, str]:
    """(a line that ends within quotes if it starts outside; a whole quoted field). All loops are possessive, so nothing is tried twice."""
    q, s = re.escape(quote), re.escape(sep)
    text = rf"(?:[^{q}]++|{q}{q})*+"
    field = rf"(?:{q}{text}{q}(?:[^{q}{s}][^{s}]*+)?+|[^{q}{s}][^{s}]*+)?+"
    return rf"(?s)^(?:{field}{s})*+{q}{text}$", rf"(?s)(?<![^{s}]){q}{text}{q}(?=$|{s})"


def physical_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """(file, block, at, value): the lines of the files; ``at`` ascends within a split in the lines' order."""
    if encoding.upper() not in ENCODINGS:
        raise ValueError(f"encoding {encoding} isn't one of {ENCODINGS}")
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), value.alias("value"))


def _runs(file: pa.Array, block: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring lines of the same split."""
    n = len(file)
    if not n:
        return
    code = file.dictionary_encode()
    code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy()
    at = block.to_numpy()
    cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (at[1:] != at[:-1])) + 1).tolist(), n]
    yield from zip(cuts[:-1], cuts[1:])


def _states(from_out: np.ndarray, from_in: np.ndarray, first: bool) -> np.ndarray:
    """Whether each line, and what follows the last one, starts within quotes; the arrays tell how a line ends from either state."""
    const = np.flatnonzero(from_out == from_in)
    turns = np.concatenate([[0], np.cumsum(from_out & ~from_in)])
    last = np.full(len(from_out) + 1, -1)
    last[const + 1] = const
    last = np.maximum.accumulate(last)
    base = np.where(last >= 0, from_out[last] if len(from_out) else False, first)
    return base ^ ((turns - turns[last + 1]) % 2 == 1)


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, for either first state: the last state and the records that begin): a row a split."""
    of, state, begun = None, [False, True], [0, 0]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [of[0]], "block": [of[1]], "out_to": [state[0]], "in_to": [state[1]], "out_n": [begun[0]], "in_n": [begun[1]]})

    for b in batches:
        from_out, from_in = (b.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3))
        for i, j in _runs(b.column(0), b.column(1)):
            key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
            if key != of:
                if of:
                    yield row()
                of, state, begun = key, [False, True], [0, 0]
            for k in (0, 1):
                s = _states(from_out[i:j], from_in[i:j], state[k])
                state[k], begun[k] = bool(s[-1]), begun[k] + int((~s[:-1]).sum())
    if of:
        yield row()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the number of their record and whether they are all of it; a split's first state and number come with its lines."""
    of, state, number = None, False, 0
    for b in batches:
        from_out, from_in = (b.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (4, 5))
        first_state, first_number = b.column(6).to_numpy(zero_copy_only=False), b.column(7).to_numpy(zero_copy_only=False)
        numbers, whole = np.empty(b.num_rows, np.int64), np.empty(b.num_rows, bool)
        for i, j in _runs(b.column(0), b.column(1)):
            key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
            if key != of:
                of, state, number = key, bool(first_state[i]), int(first_number[i])
            s = _states(from_out[i:j], from_in[i:j], state)
            numbers[i:j] = number - 1 + np.cumsum(~s[:-1])
            whole[i:j] = ~s[:-1] & ~s[1:]
            state, number = bool(s[-1]), int(numbers[j - 1]) + 1
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(numbers), pa.array(whole)], ["file", "at", "value", "number", "whole"])


def _compose(splits: pa.Table) -> pa.Table:
    """The first state and record number of a file's splits, in their order."""
    splits = splits.sort_by("block")
    state, number, states, numbers = False, 0, [], []
    for out_to, in_to, out_n, in_n in zip(*(splits[c].to_pylist() for c in ("out_to", "in_to", "out_n", "in_n"))):
        states.append(state)
        numbers.append(number)
        state, number = (in_to, number + in_n) if state else (out_to, number + out_n)
    ends = [False] * len(states)
    ends[-1] = state
    return pa.table({"file": splits["file"], "block": splits["block"], "first_state": states, "first_number": numbers, "unended": ends})


def read_records(spark: SparkSession, path: str | list[str], sep: str = ",", quote: str = '"', encoding: str = "UTF-8") -> DataFrame:
    """(file, number, record): each record's text and its place in its file, from 0 (a header is record 0; empty lines count, and are
    left out)."""
    if len(sep) != 1 or len(quote) != 1:
        raise ValueError("separator and quote are single characters")
    lines = physical_lines(spark, path, encoding)
    opens, whole_field = _patterns(sep, quote)
    quoted = F.contains("value", F.lit(quote))
    odd = quoted & F.contains(F.regexp_replace("value", whole_field, ""), F.lit(quote))
    splits = materialize(lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max(odd).alias("odd")))
    if splits.filter("odd").isEmpty():
        before = Window.partitionBy("file").orderBy("block")
        starts = materialize(splits.select("file", "block", "first", (F.sum("n").over(before) - F.col("n")).alias("before")))
        one = lines.join(broadcast_if_bounded(starts), ["file", "block"])
        out = one.select("file", (F.col("before") + F.col("at") - F.col("first")).alias("number"), "value")
    else:
        ship_package(spark)
        from_out = quoted & F.col("value").rlike(opens)
        from_in = ~quoted | F.concat(F.lit(quote), F.col("value")).rlike(opens)
        functions = lines.select("file", "block", from_out, from_in).mapInArrow(
            _split_functions, "file string, block long, out_to boolean, in_to boolean, out_n long, in_n long")
        starts = materialize(functions.groupBy("file").applyInArrow(_compose, "file string, block long, first_state boolean, first_number long, unended boolean"))
        bad = starts.filter("unended").select("file").limit(3).collect()
        if bad:
            raise ValueError(f"a quoted text has no end in {[r['file'] for r in bad]}")
        placed = lines.join(broadcast_if_bounded(starts.drop("unended")), ["file", "block"]).sortWithinPartitions("file", "block", "at")
        rows = placed.select("file", "block", "at", "value", from_out, from_in, "first_state", "first_number").mapInArrow(
            _numbered, "file string, at long, value string, number long, whole boolean")
        many = rows.filter("not whole").groupBy("file", "number").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), "\n").alias("value"))
        out = rows.filter("whole").select("file", "number", "value").unionByName(many)
    return out.select("file", "number", F.regexp_replace("value", "\r$", "").alias("record")).filter(F.col("record") != "")


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", quote: str = '"', encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """(file, number, row): each record's fields as a struct of texts (an empty field is null, an empty quoted one is empty), named by the first record of the files (or _c0, _c1, ..). Files with different
    first records are an error."""
    records = read_records(spark, path, sep, quote, encoding)
    heads = records.filter("number = 0").select("record").distinct().limit(2).collect()
    if not heads:
        raise ValueError(f"no records in {path}")
    if header and len(heads) > 1:
        raise ValueError(f"the files of {path} have different headers: {[r['record'] for r in heads]}")
    options = {"sep": sep, "quote": quote, "escape": quote, "maxCharsPerColumn": "-1", "mode": "PERMISSIVE", "nullValue": "\0", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    names = _fields(heads[0]["record"], sep, quote)
    if not header:
        names = [f"_c{i}" for i in range(len(names))]
    schema = ", ".join("`{}` string".format(n.replace("`", "``")) for n in _distinct(names))
    rows = records.filter("number > 0") if header else records
    return rows.select("file", "number", F.from_csv("record", schema, options).alias("row"))


def _fields(record: str, sep: str, quote: str) -> list[str]:
    import csv

    return next(csv.reader([record], delimiter=sep, quotechar=quote))


def _distinct(names: list[str]) -> list[str]:
    """Equal names (also but for case) get their place behind them, empty ones are made of it."""
    seen: set[str] = set()
    out = []
    for i, n in enumerate(names):
        n = n or f"_c{i}"
        n = f"{n}{i}" if n.lower() in seen else n
        seen.add(n.lower())
        out.append(n)
    return out
