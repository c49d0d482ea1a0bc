"""Language spans of mixed-language text.

A word is a run of letters (with their marks). Its script, from code point ranges, narrows the candidate
languages to those whose training text uses that script. Each candidate scores the word by character
1-, 2- and 3-grams (with word borders), as log-probabilities averaged over the orders; Viterbi over the words
with a penalty for each switch labels them, and runs of equal labels are the spans. A text's language is the
one with most labelled letters, its score that language's share of them.

Training: n-gram counts of labelled texts, summed in Spark. Labelled rows are sampled by a hash, each
language at a rate that gives ``per_lang`` rows or so (all of them where there are fewer), so the model
has a bounded size: 3 * BUCKETS numbers a language. Prediction reads every text whole.

All of it works on whole batches: texts as code points, words by differences of masks, sums by
``reduceat``, Viterbi over all texts of some batches at a time, one word further at each step.

Rules: a null text or one without letters is ``und`` with score 0 and has no spans. Words in scripts that
no training language uses get no vote; with ``any_script``, where all letters of a text are in such words, all
languages are candidates and the words vote. Ties go to the language that sorts first. Without any labelled text
all are ``und``. Repeated rows are predicted alike; other columns are kept; empty tables give empty results.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._jobs import python_ready, stored
from vigil.llm._text import small

BUCKETS = 1 << 16
#: First and last code point of some blocks, by script.
SCRIPTS = [("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x531, 0x58F), ("hebrew", 0x590, 0x5FF),
           ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF),
           ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("thai", 0xE00, 0xE7F),
           ("lao", 0xE80, 0xEFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F),
           ("khmer", 0x1780, 0x17FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
           ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x323AF)]
#: A language is a candidate for a script that at least this share of its training letters is in.
CANDIDATE_SHARE = 0.005
UNLIKELY = -50.0
_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: letter (1) or mark (2), lower case, script number (0: none of SCRIPTS)."""
    if not _TABLES:
        kind, low, script = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                kind[i] = 1
                if len(c.lower()) == 1:
                    low[i] = ord(c.lower())
            elif i >= 0x300 and unicodedata.category(c)[0] == "M":
                kind[i] = 2
        names = list(dict.fromkeys(n for n, _, _ in SCRIPTS))
        for name, first, last in SCRIPTS:
            script[first:last + 1] = names.index(name) + 1
        _TABLES.extend([kind, low, script])
    return tuple(_TABLES)


N_SCRIPTS = len({n for n, _, _ in SCRIPTS}) + 1


@dataclass
class Words:
    """The words of some texts, one after another."""

    doc: np.ndarray      # text of each word
    start: np.ndarray    # place in its text, in code points
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    feature: np.ndarray  # (3, places) n-gram buckets of all words' places
    first: np.ndarray    # where each word's places begin


def words_of(texts: list[str | None]) -> Words:
    kind, low, scripts = _tables()
    texts = [t or "" for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    what = kind[points]
    inside = what > 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1  # e: the place behind, never a letter
    if not len(s):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none, np.zeros((3, 0), np.int64), none)
    x = np.where(inside, low[points], 0).astype(np.uint64)
    x1 = np.concatenate([[0], x[:-1]]).astype(np.uint64)
    x2 = np.where(x1 > 0, np.concatenate([[0, 0], x[:-2]])[:len(x)], 0).astype(np.uint64)
    held = inside.copy()
    held[e] = True  # a word's places: its letters and the border behind it
    x, x1, x2 = x[held], x1[held], x2[held]

    def bucket(h: np.ndarray) -> np.ndarray:
        h = h * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)

    b = np.uint64(21)
    feature = np.stack([bucket(x + np.uint64(1)), bucket((x1 << b | x) + np.uint64(2)) + BUCKETS,
                        bucket((x2 << (b + b) | x1 << b | x) + np.uint64(3)) + 2 * BUCKETS])
    doc = np.searchsorted(offs, s, "right") - 1
    letters = np.add.reduceat(np.append(what == 1, False).astype(np.int64), np.stack([s, e], 1).ravel())[::2]
    return Words(doc, s - offs[doc], e - offs[doc], scripts[points[s]].astype(np.int64), letters, feature, np.searchsorted(np.flatnonzero(held), s))


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray     # (3 * BUCKETS, languages) log-probabilities / 3
    candidate: np.ndarray  # (N_SCRIPTS, languages)

    def voters(self, w: Words, any_script: bool = False) -> np.ndarray:
        """Whether a word votes: those in scripts of training languages, and with ``any_script`` all words of texts
        without letters in such ones."""
        known = self.candidate[w.script].any(1)
        if not any_script or not len(w.doc):
            return known
        open_ = np.zeros(int(w.doc[-1]) + 1, bool)
        open_[w.doc[w.letters > 0]] = True
        open_[w.doc[known & (w.letters > 0)]] = False
        return known | open_[w.doc]

    def scores(self, w: Words, voters: np.ndarray | None = None) -> np.ndarray:
        """(words, languages): log-probabilities; UNLIKELY for no candidate; equal for words that don't vote."""
        if not len(w.doc):
            return np.zeros((0, len(self.langs)), np.float32)
        each = self.weight[w.feature[0]] + self.weight[w.feature[1]] + self.weight[w.feature[2]]
        out = np.add.reduceat(each, w.first, axis=0)
        can = self.candidate[w.script]
        known = can.any(1)
        out[~can & known[:, None]] = UNLIKELY * 4
        out[~(known if voters is None else voters)] = 0
        return out


def viterbi(scores: np.ndarray, offs: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; words of text i are offs[i] to offs[i + 1]. Staying wins ties."""
    label = np.zeros(len(scores), np.int64)
    size = np.diff(offs)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    if not len(order):
        return label
    at, size = offs[:-1][order], size[order]
    live = np.searchsorted(-size, -np.arange(size[0]), "left")  # texts longer than t
    kind = np.min_scalar_type(max(scores.shape[1] - 1, 0))
    back = np.zeros(scores.shape, kind)
    value = scores[at].copy()
    own = np.arange(scores.shape[1], dtype=kind)
    for t in range(1, int(size[0])):
        k = live[t]
        v, here = value[:k], at[:k] + t
        best = v.argmax(1)
        change = v[np.arange(k), best] - penalty
        moves = change[:, None] > v
        back[here] = np.where(moves, best[:, None], own)
        value[:k] = np.where(moves, change[:, None], v) + scores[here]
    state = value.argmax(1)
    label[at + size - 1] = state
    for t in range(int(size[0]) - 1, 0, -1):
        k = live[t]
        state[:k] = back[at[:k] + t, state[:k]]
        label[at[:k] + t - 1] = state[:k]
    return label


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, feature, n): n-gram counts; features from 3 * BUCKETS on count letters by script."""
    counts: dict[str, np.ndarray] = {}
    for b in small(batches, 1, TEXT_BYTES):
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for lang in set(langs):
            w = words_of([t for k, t in zip(langs, texts) if k == lang])
            c = counts.setdefault(lang, np.zeros(3 * BUCKETS + N_SCRIPTS, np.int64))
            c[:3 * BUCKETS] += np.bincount(w.feature.ravel(), minlength=3 * BUCKETS)
            c[3 * BUCKETS:] += np.bincount(w.script, w.letters, N_SCRIPTS).astype(np.int64)
    for lang, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())],
                                         ["lang", "feature", "n"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 1500, smoothing: float = 0.5) -> Model:
    """A model from the rows with a language and a text; at most some ``per_lang`` rows of each are read."""
    python_ready(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    # one row a language; the hash keeps the same rows whatever the partitions are
    share = stored(rows.groupBy("lang").agg((F.lit(float(per_lang)) / F.count("*")).alias("share")), "languages")
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(share, "lang").filter(part < F.col("share")).select("lang", "text")
    sums = sample.mapInArrow(_count_batches, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # at most 3 * BUCKETS + N_SCRIPTS rows a language
    langs = sorted(set(got["lang"].to_pylist()))
    count = np.zeros((3 * BUCKETS + N_SCRIPTS, len(langs)))
    where = {k: i for i, k in enumerate(langs)}
    count[got["feature"].to_numpy(), [where[k] for k in got["lang"].to_pylist()]] = got["n"].to_numpy()
    grams = count[:3 * BUCKETS].reshape(3, BUCKETS, len(langs)) + smoothing
    weight = np.log(grams / grams.sum(1, keepdims=True)).reshape(3 * BUCKETS, len(langs)) / 3
    letters = count[3 * BUCKETS:]
    candidate = letters >= CANDIDATE_SHARE * np.maximum(letters.sum(0), 1)
    candidate[0] = False
    return Model(langs, weight.astype(np.float32), candidate)


GATHER = 1 << 20  # words from which on texts go through Viterbi together
TEXT_BYTES = 1 << 21  # of texts whose n-grams are held at once


def _predict(model, penalty: float, keep: int, spans: bool, any_script: bool):
    names = model.value.langs

    def solved(held: list[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        offs, base = [np.zeros(1, np.int64)], 0
        for b, w, _, _ in held:
            offs.append(base + np.searchsorted(w.doc, np.arange(1, b.num_rows + 1)))
            base += len(w.doc)
        label = viterbi(np.concatenate([s for _, _, s, _ in held]), np.concatenate(offs), penalty)
        at = 0
        for b, w, _, voters in held:
            own, n = label[at:at + len(w.doc)], b.num_rows
            at += len(w.doc)
            votes = np.bincount(w.doc * len(names) + own, w.letters * voters, n * len(names)).reshape(n, len(names))
            letters = votes.sum(1)
            best = votes.argmax(1)
            share = votes[np.arange(n), best] / np.maximum(letters, 1)
            turn = np.ones(len(own), bool)
            turn[1:] = (own[1:] != own[:-1]) | (w.doc[1:] != w.doc[:-1])
            count = np.bincount(w.doc[turn], minlength=n)
            out = [pa.array([names[k] if x else "und" for k, x in zip(best, letters)], pa.string()), pa.array(share, pa.float64()), pa.array(count, pa.int64())]
            if spans:
                first = np.flatnonzero(turn)
                last = np.append(first[1:], len(own))[:len(first)] - 1
                cuts = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                    [pa.array(w.start[first], pa.int64()), pa.array(w.end[last], pa.int64()), pa.array([names[k] for k in own[first]], pa.string())],
                    ["start", "end", "lang"])))
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], *out], [*b.schema.names[:keep], "lang_pred", "score", "n_spans", *(["spans"] if spans else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]] = []
        n = 0
        for b in small(batches, keep, TEXT_BYTES):
            w = words_of(b.column(keep).to_pylist())
            voters = model.value.voters(w, any_script)
            score = model.value.scores(w, voters)
            w.feature = w.feature[:, :0]
            held.append((b, w, score, voters))
            n += len(w.doc)
            if n >= GATHER:
                yield from solved(held)
                held, n = [], 0
        if held:
            yield from solved(held)
    return run


def _undetermined(keep: int, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [pa.array(["und"] * b.num_rows), pa.array([0.0] * b.num_rows), pa.array([0] * b.num_rows, pa.int64())]
            if spans:
                out.append(pa.array([[]] * b.num_rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], *out], [*b.schema.names[:keep], "lang_pred", "score", "n_spans", *(["spans"] if spans else [])])
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, penalty: float = 6.0, spans: bool = True,
            any_script: bool = False) -> DataFrame:
    """The columns ``keep`` (default: all but the text and result names), lang_pred, score, n_spans and, if
    asked for, spans (start, end in code points, lang). With ``any_script`` only texts without letters are ``und``."""
    python_ready(docs.sparkSession)
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_spans", T.LongType())]
    if spans:
        made.append(T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))))
    keep = [c for c in docs.columns if c != text_col and c not in {f.name for f in made}] if keep is None else keep
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    run = _predict(docs.sparkSession.sparkContext.broadcast(model), penalty, len(keep), spans, any_script) if model.langs else _undetermined(len(keep), spans)
    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), *made]))
