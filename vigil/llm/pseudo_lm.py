"""Masked pseudo-likelihood of documents.

A token is a word (runs outside 0x20 and 0x09-0x0D, A-Z as a-z): the ``FREQUENT`` most frequent words of the
corpus have ids of their own, all others share ``OTHERS`` ids (buckets) by their hash. A network predicts every token
from the ``SIDE`` tokens on both sides of it, which it sees while the token itself is masked: embeddings by
place, one tanh layer, then the token's class and the token within its class (two softmaxes, so a
prediction costs 2 * 64 outputs, not 4096). A word of a bucket then has its share of the bucket: its count over
the bucket's count and one, where the one stands for all words that training didn't see. A document's score is
the sum of the logarithms of these conditional probabilities over all its tokens, so over real words.

Everything is gathered in Spark over all documents: word counts (combined in each task, then summed), and
training windows, one for every token (a ``chance`` below 1 draws places by a hash), made in the training
tasks from the texts. Training is data-parallel: a round takes one of ``SHARES`` shares of the texts (by their hash), every
partition trains a copy of the network on the windows of its texts in numpy (Adagrad, the windows of some megabytes of texts shuffled), and the
copies and their Adagrad sums are averaged in two steps by slices of the parameters, weighted by windows; the next round goes on
from there. After ``SHARES`` rounds every position was trained on once. (How the texts lie in partitions changes the network a little, as it decides what is averaged.)
Only the averages, of a fixed size, come to the driver. Scoring reads each text whole. The
counts of all words stay in Spark: a task keeps the words of some megabytes of texts (a block) that lie in buckets
once, the blocks' words are joined with the counts, and the counts come back to their block.

Rules: null or word-less texts have no tokens, log_prob 0 and null mean and perplexity. Beyond a text's ends
stands a border token. Repeated rows score alike; ties in word counts go to the lower hash; other columns
are kept; an empty table leaves the network at its start and gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._jobs import python_ready, stored
from vigil.llm._text import mix, small, words_of

FREQUENT, OTHERS = 3584, 512
CLASSES = 64
MEMBERS = (FREQUENT + OTHERS) // CLASSES
BORDER = FREQUENT + OTHERS
SIDE, WIDTH, HIDDEN = 2, 8, 16
PLACES = [*range(-SIDE, 0), *range(1, SIDE + 1)]
SHAPES = {"embed": (BORDER + 1, WIDTH), "w": (2 * SIDE * WIDTH, HIDDEN), "b": (HIDDEN,), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
          "wm": (CLASSES, HIDDEN, MEMBERS), "bm": (CLASSES, MEMBERS)}
SLICE = 4096
SHARES = 4       # rounds in which the texts are trained on once
BLOCK_BYTES, BLOCK_WORDS = 1 << 22, 1 << 20  # of texts taken at once; a block is closed when it has so many words
CHUNK = 1 << 13  # tokens that go through the network at once
MINI = 4096      # windows of a training step
LIMIT = 60       # logits count within this, so exponentials need no shift by each row's largest

Net = dict[str, np.ndarray]


def start_net(counts: np.ndarray) -> Net:
    """Small random weights; output biases from the token counts."""
    rng = np.random.Generator(np.random.PCG64(4))
    net = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    share = (counts + 1.0).reshape(CLASSES, MEMBERS)
    net["b"][:] = 0
    net["bc"] = np.log(share.sum(1) / share.sum()).astype(np.float32)
    net["bm"] = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return net


def flat(net: Net) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in SHAPES])


def unflat(v: np.ndarray) -> Net:
    net, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        net[k], at = v[at:at + n].reshape(s).astype(np.float32), at + n
    return net


def contexts(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(tokens, 2 * SIDE): each token's neighbours; BORDER beyond its text."""
    out = np.full((len(ids), len(PLACES)), BORDER, np.int64)
    for j, d in enumerate(PLACES):
        to, of = (slice(None, -d), slice(d, None)) if d > 0 else (slice(-d, None), slice(None, d))
        out[to, j] = np.where(doc[to] == doc[of], ids[of], BORDER)
    return out


def _powers(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials of the logits ``z``, which is changed, their sums)."""
    np.exp(np.clip(z, -LIMIT, LIMIT, out=z), out=z)
    return z, z @ np.ones(z.shape[1], z.dtype)


def _chosen(z: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The log-probability of one outcome a row."""
    p, total = _powers(z)
    return np.log(p[np.arange(len(z)), which] / total)


def _by_class(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cls = ids // MEMBERS
    order = np.argsort(cls.astype(np.uint16), kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if cuts[c] < cuts[c + 1]:
            yield c, order[cuts[c]:cuts[c + 1]]


def log_probs(net: Net, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Log-probability of each token given its neighbours."""
    h = np.tanh(net["embed"][around].reshape(len(ids), -1) @ net["w"] + net["b"])
    out = _chosen(h @ net["wc"] + net["bc"], ids // MEMBERS)
    for c, rows in _by_class(ids):
        out[rows] += _chosen(h[rows] @ net["wm"][c] + net["bm"][c], ids[rows] % MEMBERS)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    """The probabilities of the logits ``z``, in their place."""
    p, total = _powers(z)
    p /= total[:, None]
    return p


def gradients(net: Net, ids: np.ndarray, around: np.ndarray) -> Net:
    """Of the mean negative log-probability."""
    n = len(ids)
    order = np.argsort((ids // MEMBERS).astype(np.uint16), kind="stable")  # so a class is a slice
    ids, around = ids[order], around[order]
    each, cls = np.arange(n), ids // MEMBERS
    first = np.flatnonzero(np.diff(cls, prepend=-1))
    parts = [(c, slice(i, j)) for c, i, j in zip(cls[first].tolist(), first.tolist(), [*first[1:].tolist(), n])]
    x = net["embed"][around].reshape(n, -1)
    h = np.tanh(x @ net["w"] + net["b"])
    g = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    d = _softmax(h @ net["wc"] + net["bc"])
    d[each, cls] -= 1
    d /= n
    g["wc"], g["bc"], dh = h.T @ d, d.sum(0), d @ net["wc"].T
    z = net["bm"][cls]
    for c, rows in parts:
        z[rows] += h[rows] @ net["wm"][c]
    d = _softmax(z)
    d[each, ids % MEMBERS] -= 1
    d /= n
    g["bm"][cls[first]] = np.add.reduceat(d, first)
    for c, rows in parts:
        g["wm"][c] = h[rows].T @ d[rows]
        dh[rows] += d[rows] @ net["wm"][c].T
    dz = dh * (1 - h * h)
    g["w"], g["b"] = x.T @ dz, dz.sum(0)
    at = around.ravel()
    order = np.argsort(at.astype(np.uint16), kind="stable")  # far quicker than np.add.at
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    g["embed"][at[order[first]]] = np.add.reduceat((dz @ net["w"].T).reshape(-1, WIDTH)[order], first)
    return g


def fresh() -> Net:
    """Adagrad's sums at the start."""
    return {k: np.full(s, 1e-6, np.float32) for k, s in SHAPES.items()}


def train_on(net: Net, seen: Net, windows: np.ndarray, rate: float) -> None:
    """One pass of Adagrad over windows (tokens, 2 * SIDE + 1), the masked token first; ``net`` and ``seen`` change."""
    for i in range(0, len(windows), MINI):
        part = windows[i:i + MINI].astype(np.int64)
        for k, g in gradients(net, part[:, 0], part[:, 1:]).items():
            seen[k] += g * g
            net[k] -= rate * g / np.sqrt(seen[k])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes with counts, combined over the task as far as memory is bounded."""
    words, counts, size = [], [], 0

    def combined() -> tuple[np.ndarray, np.ndarray]:
        u, inverse = np.unique(np.concatenate(words), return_inverse=True)
        return u, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words[0].view(np.int64)), pa.array(counts[0])], ["word", "n"])

    for b in small(batches, 0):
        u, n = np.unique(words_of(b.column(0))[0], return_counts=True)
        words.append(u)
        counts.append(n)
        size += len(u)
        if size > 1 << 21:
            u, n = combined()
            words, counts, size = [u], [n], len(u)
            if size > 1 << 20:
                yield batch()
                words, counts, size = [], [], 0
    if words:
        u, n = combined()
        words, counts = [u], [n]
        yield batch()


class Lexicon:
    """Ids of word hashes; the counts of the buckets and, on the driver, the stored table (word, n) of all words."""

    def __init__(self, frequent: np.ndarray, buckets: np.ndarray | None = None, counts: DataFrame | None = None) -> None:
        self.id_of = np.argsort(frequent)
        self.sorted = frequent[self.id_of]
        self.buckets = np.zeros(OTHERS) if buckets is None else buckets
        self.counts = counts

    def __getstate__(self) -> dict:
        return {**self.__dict__, "counts": None}

    def log_shares(self, words: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Log of each bucket word's share of its bucket; ``n``: its count, 0 if training didn't see it."""
        return np.log(np.maximum(n, 1)) - np.log(self.buckets[(words % np.uint64(OTHERS)).astype(np.int64)] + 1)

    def ids(self, words: np.ndarray) -> np.ndarray:
        out = FREQUENT + (words % np.uint64(OTHERS)).astype(np.int64)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
            hit = self.sorted[at] == words
            out[hit] = self.id_of[at[hit]]
        return out

    def tokens(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, text of each, offsets of the texts)."""
        words, offs = words_of(column)
        return self.ids(words), np.repeat(np.arange(len(offs) - 1), np.diff(offs)), offs


def windows_of(lexicon: Lexicon, column, chance: float) -> np.ndarray:
    """The windows of the places of all texts, shuffled; ``chance`` below 1 draws some."""
    words, offs = words_of(column)
    ids, doc = lexicon.ids(words), np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    rows = np.concatenate([ids[:, None], contexts(ids, doc)], axis=1).astype(np.uint16)
    if chance < 1 and len(ids):
        full = np.flatnonzero(np.diff(offs))
        seed = np.zeros(len(offs) - 1, np.uint64)
        seed[full] = np.add.reduceat(mix(words), offs[:-1][full])  # by content, so it's drawn alike in any partition
        place = (np.arange(len(ids)) - offs[doc]).astype(np.uint64)
        rows = rows[mix(seed[doc] + place * np.uint64(0x9E3779B97F4A7C15)) < np.uint64(int(chance * 2**64))]
    return rows[np.random.Generator(np.random.PCG64(len(rows))).permutation(len(rows))]


def _round_batches(model, chance: float, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (lexicon, net, sums), n = model.value, 0
        own, seen = ({k: v.copy() for k, v in x.items()} for x in (net, sums))
        for b in small(batches, 0, BLOCK_BYTES):
            w = windows_of(lexicon, b.column(0), chance)
            train_on(own, seen, w, rate)
            n += len(w)
        if n:
            v = np.concatenate([flat(own), flat(seen)])
            parts = [v[i:i + SLICE].astype(np.float64).tobytes() for i in range(0, len(v), SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()), pa.array([n] * len(parts), pa.int64())],
                                             ["slice", "v", "n"])
    return run


def _averaged(pdf: pd.DataFrame) -> pd.DataFrame:
    total, mean = pdf["n"].sum(), 0.0
    for v, n in sorted(zip(pdf["v"], pdf["n"])):
        mean = mean + np.frombuffer(v, np.float64) * (n / total)
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "v": [mean.tobytes()], "n": [total]})


def train(docs: DataFrame, text_col: str = "text", chance: float = 1.0, passes: int = 1, rate: float = 0.2) -> tuple[Lexicon, Net]:
    """The lexicon and the network of a table of texts, trained ``passes`` times over the places drawn (default: all)."""
    spark = docs.sparkSession
    python_ready(spark)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_count_batches, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word_counts")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    known = np.zeros(FREQUENT + OTHERS)
    known[:top.num_rows] = top["n"].to_numpy()
    rest = counts.join(F.broadcast(spark.createDataFrame(top.select(["word"]).to_pandas(), "word long")), "word", "left_anti")
    for r in rest.groupBy(F.expr(f"int(word & {OTHERS - 1})").alias("k")).agg(F.sum("n").alias("n")).collect():  # at most OTHERS rows
        known[FREQUENT + r["k"]] = r["n"]
    lexicon = Lexicon(top["word"].to_numpy().view(np.uint64), known[FREQUENT:], counts)
    net, sums = start_net(known), fresh()
    kind = "slice int, v binary, n long"
    share = F.pmod(F.xxhash64("text"), F.lit(SHARES))
    for i in range(passes * SHARES):
        model = spark.sparkContext.broadcast((lexicon, net, sums))
        copies = texts.filter(share == i % SHARES).mapInArrow(_round_batches(model, chance, rate), kind)
        some = copies.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("slice", "group").applyInPandas(_averaged, kind)
        got = some.groupBy("slice").applyInPandas(_averaged, kind).orderBy("slice").toArrow()
        if got.num_rows:
            v = np.frombuffer(b"".join(got["v"].to_pylist()), np.float64)
            net, sums = unflat(v[:len(v) // 2]), unflat(v[len(v) // 2:])
    return lexicon, net


def document_scores(lexicon: Lexicon, net: Net, column) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, summed log-probability of their ids) of each text."""
    ids, doc, offs = lexicon.tokens(column)
    return np.diff(offs), _network_scores(net, ids, doc, len(offs) - 1)


def _network_scores(net: Net, ids: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    around, total = contexts(ids, doc), np.zeros(n)
    for i in range(0, len(ids), CHUNK):
        lp = log_probs(net, ids[i:i + CHUNK], around[i:i + CHUNK])
        total += np.bincount(doc[i:i + CHUNK], lp.astype(np.float64), n)
    return total


def _block_batches(model, keep: int):
    """A row a block: its number, its rows as an Arrow stream (kept columns, tokens, bucket tokens, the network's score
    with the buckets' part of the shares), the place in ``words`` of each bucket token, and its bucket words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (lexicon, net), held, words, size, made = model.value, [], [], 0, 0

        def block() -> pa.RecordBatch:
            u, at = np.unique(np.concatenate(words), return_inverse=True)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for b in held:
                    out.write_batch(b)
            number = (TaskContext.get().partitionId() << 32) + made
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                                               pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([u.view(np.int64)], pa.list_(pa.int64()))],
                                              ["block", "rows", "at", "words"])

        for b in small(batches, keep, BLOCK_BYTES):
            hashes, offs = words_of(b.column(keep))
            ids, doc = lexicon.ids(hashes), np.repeat(np.arange(b.num_rows), np.diff(offs))
            rare = ids >= FREQUENT
            n_rare = np.bincount(doc[rare], minlength=b.num_rows)
            total = _network_scores(net, ids, doc, b.num_rows)
            total += np.bincount(doc[rare], lexicon.log_shares(hashes[rare], np.zeros(1)), b.num_rows)
            held.append(pa.RecordBatch.from_arrays([*b.columns[:keep], pa.array(np.diff(offs), pa.int64()), pa.array(n_rare, pa.int64()), pa.array(total)],
                                                   [*(f"c{i}" for i in range(keep)), "n", "rare", "total"]))
            words.append(hashes[rare])
            size += int(offs[-1])
            if size >= BLOCK_WORDS:
                yield block()
                held, words, size, made = [], [], 0, made + 1
        if held:
            yield block()
    return run


def _finished(names: list[str]):
    """(a block, the counts of its words) -> its rows with their scores."""
    def run(block: pa.Table, counts: pa.Table) -> pa.Table:
        parts = []
        logs = np.zeros(counts.num_rows)
        logs[counts["place"].to_numpy()] = np.log(counts["n"].to_numpy().astype(np.float64))
        for rows, at in zip(block["rows"], block["at"]):
            t = pa.ipc.open_stream(rows.as_buffer()).read_all()
            n, total = t["n"].to_numpy(), t["total"].to_numpy()
            doc = np.repeat(np.arange(len(n)), t["rare"].to_numpy())
            total = total + np.bincount(doc, logs[np.frombuffer(at.as_buffer(), np.int32)], len(n))
            mean, empty = np.divide(total, n, out=np.zeros(len(n)), where=n > 0), n == 0
            parts.append(pa.table([*t.columns[:-3], pa.array(n, pa.int64()), pa.array(total), pa.array(mean, mask=empty), pa.array(np.exp(-mean), mask=empty)], names))
        return pa.concat_tables(parts)
    return run


def score(docs: DataFrame, lexicon: Lexicon, net: Net, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the text and result names), n_tokens, log_prob, mean_log_prob, perplexity."""
    spark = docs.sparkSession
    python_ready(spark)
    made = [T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("log_prob", "mean_log_prob", "perplexity"))]
    keep = [c for c in docs.columns if c != text_col and c not in {f.name for f in made}] if keep is None else keep
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    model = spark.sparkContext.broadcast((lexicon, net))
    blocks = stored(rows.mapInArrow(_block_batches(model, len(keep)), "block long, rows binary, at binary, words array<long>"), "blocks")
    found = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("place", "word"))
    counts = spark.createDataFrame([], "word long, n long") if lexicon.counts is None else lexicon.counts.filter("n > 1")  # 1 is what unseen words count
    found = found.join(counts, "word", "left").select("of", "place", F.coalesce("n", F.lit(1)).alias("n"))
    kind = T.StructType([*(rows.schema[c] for c in keep), *made])
    return blocks.select("block", "rows", "at").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_finished(kind.names), kind)
