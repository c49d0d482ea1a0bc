"""Near-duplicate components by a chosen-path set similarity join.

A document's set holds its distinct k-word shingles (see ``_text``); two documents are linked if the
Jaccard similarity of their sets reaches ``num / den``. Equal sets form one class; the join runs over
classes.

1. Sketch: 128 minwise values per class (numpy, in ``mapInArrow``).
2. Trees: in each of ``trees`` independent trees a class follows one path. A node (the path so far)
   picks one sketch coordinate, and the class branches by its minwise token there. A node with one class
   ends; a node of at most ``leaf`` classes is compared exhaustively; a larger one branches again, up to
   ``depth`` levels. A linked pair stays together on one level with a chance of its similarity s, so it
   is missed with (1 - s**depth)**trees at most: 0.2 % at s = 0.8 when every node stays large, under 1e-6
   in the usual case of one or two levels; ``trees`` sets the recall.
3. Nodes still large at the last level (a big family, a passage most of a text consists of): every class
   is compared with the node's ``LEADERS`` leaders; once components are known, the classes outside the
   node's largest component meet all classes of the node, in blocks of ``BLOCK_ROWS`` classes, and only
   links leave a block. So no pair of a node is dropped but by the sketch (4), and pairs inside a component
   aren't looked at.
4. Verification: sketch estimates only rank pairs and discard those six deviations below the threshold (a pair
   at the threshold is lost with 1.4e-8 at s = 0.85, 9.2e-9 at 0.8, whatever ``trees`` is: all use one sketch);
   pairs are confirmed on full sets recomputed from the texts. First a spanning forest of each leaf,
   then, among classes still in different components, all other candidates.

Rules: null or word-less text has the empty set, is linked with nothing and is its own component. Texts
of fewer than k words have their whole word sequence as one shingle. A null id is allowed: the component's
id is the least non-null one. Repeated rows are linked like any equal texts. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm._jobs import components, python_ready, stored
from vigil.llm._text import mix, small, text_sets

SKETCH = 128
BLOCK_ROWS = 256
LEADERS = 6
TEXT_BYTES = 1 << 22  # of texts whose sets a task holds at once
_RNG = np.random.Generator(np.random.PCG64(7))
_MULT = (_RNG.integers(0, 2**32, SKETCH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 2**32, SKETCH, dtype=np.uint64).astype(np.uint32)


def set_key(s: np.ndarray) -> bytes | None:
    """16 bytes that name a set; null for the empty one."""
    if not len(s):
        return None
    a = mix(s).sum(dtype=np.uint64)
    b = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64).tobytes()


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SKETCH minwise values for each (non-empty) set."""
    out = np.empty((len(sets), SKETCH), np.uint32)
    if sets:
        flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        at = np.cumsum([0] + [len(s) for s in sets[:-1]])
        for i in range(SKETCH):
            out[:, i] = np.minimum.reduceat(flat * _MULT[i] + _ADD[i], at)
    return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """A binary column of equally long rows."""
    width = rows.shape[1] * rows.itemsize
    offs = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(rows))])


def _rows(column: pa.Array, kind) -> np.ndarray:
    """A non-null binary column of equally long values as a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), -1)


def _sketch_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1, TEXT_BYTES):
            sets = text_sets(b.column(1), k)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig: list[bytes | None] = [None] * len(sets)
            for i, row in zip(full, sketches([sets[i] for i in full])):
                sig[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.binary()),
                 pa.array(sig, pa.binary())], ["id", "n", "cls", "sig"])
    return run


def _path_batches(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig, n = _rows(b.column(1), np.uint32), b.num_rows
            out = []
            for t in range(trees):
                p = np.full(n, (t + 1) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
                levels = []
                for _ in range(depth):
                    p = mix(p)  # the node's own choice of a coordinate is a function of the path that names it
                    token = sig[np.arange(n), (p % np.uint64(SKETCH)).astype(np.int64)]
                    p = mix(p * np.uint64(0xD1342543DE82EF95) + token)
                    levels.append(pa.array(p.view(np.int64)))
                out.append(pa.RecordBatch.from_arrays([b.column(0), *levels], ["cls", *(f"p{i}" for i in range(depth))]))
            yield from out
    return run


def _small(sig: np.ndarray) -> np.ndarray:
    """8 bits of each minwise value: enough to count agreements."""
    return ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), _fixed(_small(_rows(b.column(1), np.uint32)))], ["cls", "s8"])


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables whose rows hold every group (first ``keys`` columns, sorted) whole."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        last, cut = [c[-1] for c in t.columns[:keys]], t.num_rows - 1
        while cut and all(c[cut - 1] == v for c, v in zip(t.columns, last)):
            cut -= 1
        if cut:
            yield t.slice(0, cut).combine_chunks()
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _pair(a: bytes, b: bytes) -> tuple[bytes, bytes]:
    return (a, b) if a < b else (b, a)


def _leaf_pairs(least: int, leaf: int):
    """All pairs of small nodes with ``least`` agreements; tier 1: a spanning forest of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, 1):
            node = t.column(0).to_numpy()
            cls, sig = t.column(1).to_pylist(), _rows(t.column(2).combine_chunks(), np.uint8)
            found = []
            for gap in range(1, leaf):
                at = np.flatnonzero(node[gap:] == node[:-gap])
                if not len(at):
                    break
                m = (sig[at] == sig[at + gap]).sum(1)
                found += [(int(node[i]), -int(x), *_pair(cls[i], cls[i + gap]), int(i), int(i + gap))
                          for i, x in zip(at[m >= least], m[m >= least])]
            found.sort()
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while root.get(x, x) != x:
                    x = root[x]
                return x

            out = []
            for _, m, a, b, i, j in found:
                x, y = find(i), find(j)
                if x != y:
                    root[x] = y
                out.append((a, b, 1 if x != y else 2))
            yield _pairs_out(out)
    return run


def _pairs_out(rows: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
    a, b, tier = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(tier, pa.int32())],
                                      ["a", "b", "tier"])


def _agreements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, s8, leader, leader's s8) -> (cls, leader, agreements)."""
    for b in batches:
        m = (_rows(b.column(1), np.uint8) == _rows(b.column(3), np.uint8)).sum(1)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(m, pa.int32())], ["cls", "leader", "m"])


def _linked(u: np.ndarray, v: np.ndarray, num: int, den: int) -> bool:
    """Whether two ascending sets reach the threshold."""
    u, v = (u, v) if len(u) <= len(v) else (v, u)
    common = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
    return den * common >= num * (len(u) + len(v) - common)


def _block_links(least: int, num: int, den: int):
    """Sorted (node, block, outside, cls, comp, s8, members), a block's own classes before the outside ones:
    links of each outside class with the block's own, one for each component it meets there. Only the
    block's own classes are held; the outside ones stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cls, comp, sigs, sets, matrix = None, [], [], [], [], None
        for b in batches:
            a_out, b_out, sig = [], [], _rows(b.column(5), np.uint8)
            nodes, blocks, outside = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, here in enumerate(zip(nodes, blocks)):
                if here != at:
                    at, cls, comp, sigs, sets, matrix = here, [], [], [], [], None
                c, k, members = b.column(3)[i].as_py(), b.column(4)[i].as_py(), np.frombuffer(b.column(6)[i].as_py(), np.uint64)
                if not outside[i]:
                    cls.append(c)
                    comp.append(k)
                    sigs.append(sig[i])
                    sets.append(members)
                elif cls:
                    matrix = np.stack(sigs) if matrix is None else matrix
                    m, met = (matrix == sig[i]).sum(1), {k}
                    for j in np.argsort(-m, kind="stable").tolist():
                        if m[j] < least:
                            break
                        if comp[j] not in met and _linked(members, sets[j], num, den):
                            met.add(comp[j])
                            a_out.append(c)
                            b_out.append(cls[j])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.binary()), pa.array(b_out, pa.binary())], ["a", "b"])
    return run


def _set_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 0, TEXT_BYTES):
            sets = text_sets(b.column(0), k)
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "members"])
    return run


def _confirm(num: int, den: int):
    """(a, b, set of a, set of b) -> the linked pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den)
                    for x, y in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


PAIRS = "a binary, b binary, tier int"


class _Join:
    """The join over one table of documents; every table it keeps is stored in the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int,
                 trees: int, depth: int, leaf: int) -> None:
        python_ready(docs.sparkSession)
        self.k, self.num, self.den, self.trees, self.depth, self.leaf = k, num, den, trees, depth, leaf
        s = num / den
        self.least = int(SKETCH * s - 6 * (SKETCH * s * (1 - s)) ** 0.5)
        self.texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        kind = T.StructType([T.StructField("id", self.texts.schema["id"].dataType), T.StructField("n", T.LongType()),
                             T.StructField("cls", T.BinaryType()), T.StructField("sig", T.BinaryType())])
        self.rows = stored(self.texts.mapInArrow(_sketch_batches(k), kind), "sketches")
        self.classes = stored(self.rows.filter("cls is not null").groupBy("cls")
                              .agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "classes")
        self.packed = stored(self.classes.select("cls", "sig").mapInArrow(_pack_batches, "cls binary, s8 binary"), "packed")

    def paths(self) -> DataFrame:
        kind = "cls binary, " + ", ".join(f"p{i} long" for i in range(self.depth))
        return self.classes.select("cls", "sig").mapInArrow(_path_batches(self.trees, self.depth), kind)

    def nodes(self) -> tuple[DataFrame, DataFrame]:
        """(node, cls) of the small nodes, (node, cls, n) of those still large at the last level. Counts are
        stored before they are joined, here and below: so the join deals its rows anew, and Spark can split
        a node that holds many of them."""
        rows, leaves = stored(self.paths(), "paths"), None
        for i in range(self.depth):
            p = f"p{i}"
            many = stored(rows.groupBy(p).agg(F.count("*").alias("n")).filter("n > 1"), "counts")
            rows = stored(rows.drop("n").join(many, p), f"level{i}")
            new = rows.filter(F.col("n") <= self.leaf).select(F.col(p).alias("node"), "cls")
            leaves = new if leaves is None else leaves.unionByName(new)
            rows = rows.filter(F.col("n") > self.leaf)
        return leaves, rows.select(F.col(f"p{self.depth - 1}").alias("node"), "cls", "n")

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """(a, b, tier) and the rows of the large nodes."""
        leaves, large = self.nodes()
        small = (leaves.join(self.packed, "cls").select("node", "cls", "s8")
                 .repartition("node").sortWithinPartitions("node", "cls")
                 .mapInArrow(_leaf_pairs(self.least, self.leaf), PAIRS))
        order = [F.min(F.struct(F.xxhash64("cls", F.lit(i)), "cls")).alias(f"l{i}") for i in range(LEADERS)]
        heads = large.groupBy("node").agg(*order).select("node", F.explode(F.array(*(F.col(f"l{i}.cls") for i in range(LEADERS)))).alias("leader"))
        led = (large.select("node", "cls").join(stored(heads, "heads"), "node").filter("cls <> leader").select("cls", "leader").distinct()
               .join(self.packed, "cls").withColumnRenamed("s8", "own")
               .join(self.packed.select(F.col("cls").alias("leader"), "s8"), "leader")
               .select("cls", "own", "leader", "s8").mapInArrow(_agreements, "cls binary, leader binary, m int")
               .filter(F.col("m") >= self.least))
        best = led.groupBy("cls").agg(F.max(F.struct("m", "leader")).alias("best")).select("cls", F.col("best.leader"), F.lit(1).alias("tier"))
        star = best.select(F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b"), "tier")
        pairs = small.unionByName(star).groupBy("a", "b").agg(F.min("tier").alias("tier"))
        return stored(pairs, "candidates"), large

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(cls, members): full sets of the classes (cls, rep), recomputed from the texts."""
        found = (self.texts.join(wanted.select("rep").distinct(), F.col("id").eqNullSafe(F.col("rep")), "left_semi")
                 .select("text").mapInArrow(_set_batches(self.k), "cls binary, members binary")
                 .join(wanted.select("cls"), "cls", "left_semi"))
        return stored(found.groupBy("cls").agg(F.first("members").alias("members")), "sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold."""
        used = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(self.classes.select("cls", "rep"), "cls")
        sets = self.sets(stored(used, "used"))
        both = (pairs.select("a", "b").join(sets.select(F.col("cls").alias("a"), F.col("members").alias("x")), "a")
                .join(sets.select(F.col("cls").alias("b"), F.col("members").alias("y")), "b").select("a", "b", "x", "y"))
        return stored(both.mapInArrow(_confirm(self.num, self.den), "a binary, b binary"), "links")

    def rest(self, pairs: DataFrame, large: DataFrame, links: DataFrame) -> DataFrame:
        """Links between classes that ``links`` leave in different components."""
        label = components(links)

        def labelled(df: DataFrame, col: str, to: str) -> DataFrame:
            near = label.select(F.col("node").alias(col), F.col("label").alias("found"))
            return df.join(near, col, "left").withColumn(to, F.coalesce("found", col)).drop("found")

        more = self.confirmed(stored(labelled(labelled(pairs.filter("tier = 2"), "a", "ca"), "b", "cb").filter("ca <> cb").select("a", "b"), "open"))
        if large.isEmpty():
            return more
        known = stored(labelled(large, "cls", "comp"), "large")
        main = (known.groupBy("node", "comp").agg(F.count("*").alias("c")).groupBy("node")
                .agg(F.max(F.struct("c", "comp")).alias("m")).select("node", F.col("m.comp").alias("main")))
        mixed = known.join(stored(main, "main"), "node").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
        outer = mixed.filter("comp <> main")
        held = mixed.join(stored(outer.select("node").distinct(), "mixed"), "node", "left_semi")
        used = held.select("cls").distinct().join(self.classes.select("cls", "rep"), "cls")
        full = self.sets(stored(used, "used")).join(self.packed, "cls")
        cols = ["node", "block", "outside", "cls", "comp"]
        blocks = (held.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("outside", F.lit(False)).select(cols)
                  .unionByName(outer.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                               .withColumn("outside", F.lit(True)).select(cols)))
        crossed = (blocks.join(full, "cls").select(*cols, "s8", "members").repartition("node", "block")
                   .sortWithinPartitions("node", "block", "outside").mapInArrow(_block_links(self.least, self.num, self.den), "a binary, b binary"))
        return more.unionByName(stored(crossed, "crossed"))

    def labels(self) -> DataFrame:
        """(cls, component_id) of every class."""
        pairs, large = self.candidates()
        links = self.confirmed(pairs.filter("tier = 1"))
        links = links.unionByName(self.rest(pairs, large, links))
        label = components(links).select(F.col("node").alias("cls"), "label")
        named = stored(self.classes.select("cls", "rep").join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "named")
        least = stored(named.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
        return stored(named.join(least, "label").select("cls", "component_id", "label"), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100,
                    trees: int = 12, depth: int = 4, leaf: int = 32) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``; kept: it has its component's id."""
    job = _Join(docs, id_col, text_col, k, num, den, trees, depth, leaf)
    return (job.rows.select("id", "n", "cls").join(job.labels().select("cls", "component_id"), "cls", "left")
            .withColumn("component_id", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")))
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def _keyed_batches(k: int):
    """(row, text) -> (row, cls)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1, TEXT_BYTES):
            keys = pa.array([set_key(s) for s in text_sets(b.column(1), k)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), keys], ["row", "cls"])
    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that of the least id (of
    repeated rows with that id the one whose text, then whose columns have the least hash, so the same in every run). Rows without words all stay."""
    job = _Join(docs, id_col, text_col, **{"k": 5, "num": 80, "den": 100, "trees": 12, "depth": 4, "leaf": 32, **options})
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).cast("string").alias("text"))
    keyed = packed.mapInArrow(_keyed_batches(job.k), T.StructType([packed.schema["row"], T.StructField("cls", T.BinaryType())]))
    ids = job.rows.filter("n > 0").select("cls", "id").distinct()
    chosen = ids.join(job.labels(), "cls").filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = chosen.select(F.col("cls").alias("of"), F.col("id").alias("least"), "label")
    found = keyed.filter("cls is not null").join(chosen, (F.col("cls") == F.col("of")) & F.col("row")[id_col].eqNullSafe(F.col("least")))
    first = F.struct(F.xxhash64(F.col("row")[text_col]), F.xxhash64(F.to_json("row")))
    kept = found.groupBy("label").agg(F.min_by("row", first).alias("row")).select("row").unionByName(keyed.filter("cls is null").select("row"))
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
