"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering.

Legal conversations are empty or an optional system turn followed by user and assistant turns in turn,
ending with the assistant. Every row may keep or change its role (``RELABEL``; ``NAME`` if its role is none
of the three), may be merged into the turn before it of the same role (``MERGE``), and empty turns may be
inserted before it or at the end (``INSERT`` each). Dynamic programming over the automaton's states (the
role of the open turn) finds the choice of least total cost; ties go to the lower state, then to a merge.

Rows are sorted by (conversation, turn, role, text) and dealt by ranges, so a conversation with a third of all
rows lies in many partitions. Where one goes over a partition's border, its part there is first summed up
as a matrix of least costs from each state to each other (4 x 4); these matrices, at most two a partition,
are chained to find the states at the borders, and then each part is solved on its own between them.

Rendering gives each row its segment of the conversation's text: the closing of the turn before, inserted
empty turns, the header or the merge separator, and the row's text; the last row's segment also closes
the conversation. Segments in the order of ``place`` make the conversation, so no long one is gathered.

Rules: a null conversation id is a conversation of its own; null turns come first; equal turns are ordered
by role and text; repeated rows are rows of their own; a null text is empty; a null or unknown role is named
for NAME. Other columns are dropped unless kept by name. An empty table gives an empty result.
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

ROLES = ["system", "user", "assistant"]
ALIASES = {"human": "user", "prompter": "user", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)  # states: no turn yet, or the role of the open turn
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
KEEP, NAME, RELABEL, MERGE, INSERT = 0, 1, 2, 1, 3
FAR = 1 << 40


def _inserted() -> dict[tuple[int, int], tuple[int, ...]]:
    """For states p and q the shortest run of empty turns that leads from p to q."""
    runs = {(p, p): () for p in NEXT}
    front = list(runs)
    while front:
        front = [(p, n) for p, q in front for n in NEXT[q] if (p, n) not in runs and runs.setdefault((p, n), (*runs[p, q], n)) is not None]
    return runs


RUNS = _inserted()


def _step(p: int, x: int) -> tuple[int, bool, tuple[int, ...]] | None:
    """The cheapest way for a row of label x to follow state p: cost, whether merged, turns inserted before."""
    ways = [(MERGE, 0, ())] if p == x else []
    ways += [(INSERT * len(run), 1, run) for (a, q), run in RUNS.items() if a == p and x in NEXT[q]]
    cost, new, run = min(ways, default=(FAR, 0, ()))
    return None if cost == FAR else (cost, not new, run)


STEPS = {(p, x): _step(p, x) for p in range(4) for x in (SYSTEM, USER, ASSISTANT)}
#: Turns inserted behind the last row, by its state.
CLOSING = {p: RUNS[p, ASSISTANT] if p != START else () for p in range(4)}


def role_state(role: str | None) -> int:
    """The state of a role's name; START for none of the three."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else START


def row_costs(state: int) -> np.ndarray:
    """(4, 4): least cost of a row whose own role is ``state``, from each state to each."""
    m = np.full((4, 4), FAR, np.int64)
    for (p, x), step in STEPS.items():
        if step:
            m[p, x] = step[0] + (KEEP if x == state else NAME if state == START else RELABEL)
    return m


COSTS = np.stack([row_costs(s) for s in range(4)])


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least costs over both parts."""
    return np.minimum((a[:, :, None] + b[None]).min(1), FAR)


def solve(states: list[int], enter: int = START, leave: int | None = None) -> tuple[list[int], int]:
    """The labels of rows with these own roles, from state ``enter`` to ``leave`` (None: to a legal end), and the cost."""
    value, back = [FAR] * 4, []
    value[enter] = 0
    table = COSTS.tolist()
    for s in states:
        costs, new, came = table[s], [FAR] * 4, [0] * 4
        for x in (SYSTEM, USER, ASSISTANT):
            for p in range(4):
                c = value[p] + costs[p][x]
                if c < new[x]:
                    new[x], came[x] = c, p
        value = new
        back.append(came)
    ends = [v + INSERT * len(CLOSING[p]) for p, v in enumerate(value)]
    at = min(range(4), key=ends.__getitem__) if leave is None else leave
    cost, labels = (ends if leave is None else value)[at], []
    for came in reversed(back):
        labels.append(at)
        at = came[at]
    return labels[::-1], cost


def _turn(state: int, text: str) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n{text}"


END, JOIN = "<|im_end|>\n", "\n\n"


def render(states: list[int], texts: list[str | None], labels: list[int], enter: int = START, last: bool = True) -> list[tuple]:
    """(new role, action, turns inserted, segment) of each row."""
    out, p = [], enter
    for i, (s, text, x) in enumerate(zip(states, texts, labels)):
        _, merged, run = STEPS[p, x]
        action = "+".join(a for a, on in (("relabel", x != s), ("merge", merged), ("insert", bool(run))) if on) or "keep"
        if merged:
            segment = JOIN + (text or "")
        else:
            segment = (END if p != START else "") + "".join(_turn(q, "") + END for q in run) + _turn(x, text or "")
        inserted = len(run)
        if last and i == len(states) - 1:
            segment += END + "".join(_turn(q, "") + END for q in CLOSING[x])
            inserted += len(CLOSING[x])
        out.append((ROLES[x - 1], action, inserted, segment))
        p = x
    return out


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the row's place in it."""
    part, n = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(range(n, n + b.num_rows), pa.int64())],
                                         [*b.schema.names, "part", "seq"])
        n += b.num_rows


def _runs_of(batches: Iterator[pa.RecordBatch], cols: int) -> Iterator[tuple[tuple, list[list], bool, bool]]:
    """Rows sorted by (part, seq) as runs of equal (part, conversation): key, columns, whether it is its part's first, its last."""
    key, rows, first = None, [[] for _ in range(cols)], True
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if r[:2] != key:
                if key is not None:
                    yield key, rows, first, r[0] != key[0]
                    first = r[0] != key[0]
                key, rows = r[:2], [[] for _ in range(cols)]
            for c, v in zip(rows, r):
                c.append(v)
    if key is not None:
        yield key, rows, first, True


def _sum_up(conv_type: pa.DataType):
    """(part, conv, role) -> (part, conv, cost): the matrices of each part's first and last conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), cols, first, last in _runs_of(batches, 3):
            if first or last:
                total = np.where(np.eye(4, dtype=bool), 0, FAR)
                for r in cols[2]:
                    total = chained(total, COSTS[role_state(r)])
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([conv], conv_type), pa.array([total.ravel().tolist()], pa.list_(pa.int64()))],
                                                 ["part", "conv", "cost"])
    return run


def _borders(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states at which the best repair enters and leaves each part of one conversation."""
    pdf = pdf.sort_values("part")
    value, back = np.array([0, FAR, FAR, FAR]), []
    for m in pdf["cost"]:
        ways = value[:, None] + np.asarray(m).reshape(4, 4)
        back.append(ways.argmin(0))
        value = np.minimum(ways.min(0), FAR)
    at = int(np.argmin([v + INSERT * len(CLOSING[p]) for p, v in enumerate(value)]))
    states = [at]
    for came in reversed(back):
        states.append(int(came[states[-1]]))
    states.reverse()
    return pd.DataFrame({"part": pdf["part"], "conv": pdf["conv"], "enter": states[:-1], "leave": states[1:],
                         "last": [False] * (len(pdf) - 1) + [True]})


def _repair_batches(conv_type: pa.DataType, turn_type: pa.DataType):
    """(part, conv, turn, role, text, seq, enter, leave, last), sorted -> repaired rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), (_, _, turn, role, text, seq, enter, leave, last), _, _ in _runs_of(batches, 9):
            states = [role_state(r) for r in role]
            begin, whole = enter[0] if enter[0] is not None else START, last[0] is None or last[0]
            labels, _ = solve(states, begin, leave[0])
            new, action, inserted, segment = zip(*render(states, text, labels, begin, whole))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(seq), conv_type), pa.array([(part << 33) + s for s in seq], pa.int64()), pa.array(turn, turn_type), pa.array(role, pa.string()),
                 pa.array(new, pa.string()), pa.array(action, pa.string()), pa.array(inserted, pa.int64()), pa.array(segment, pa.string())],
                ["conv", "place", "turn", "role", "new_role", "action", "n_inserted", "segment"])
    return run


def repair_roles(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conversation, place, turn, role, new_role, action, n_inserted, segment) for every row of ``turns``."""
    from pyspark.sql.pandas.types import to_arrow_type

    python_ready(turns.sparkSession)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    conv, turn = rows.schema["conv"], rows.schema["turn"]
    order = ["conv", "turn", "role", F.xxhash64("text"), "row_"]
    dealt = rows.withColumn("row_", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("row_")
    numbered = stored(dealt.mapInArrow(_number, T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType())])), "turns")
    kinds = to_arrow_type(conv.dataType), to_arrow_type(turn.dataType)
    sums = (numbered.select("part", "conv", "role", "seq").repartition("part").sortWithinPartitions("part", "seq").select("part", "conv", "role")
            .mapInArrow(_sum_up(kinds[0]), T.StructType([T.StructField("part", T.IntegerType()), conv, T.StructField("cost", T.ArrayType(T.LongType()))])))
    over = sums.groupBy("conv").applyInPandas(_borders, T.StructType([T.StructField("part", T.IntegerType()), conv, *(T.StructField(c, T.IntegerType()) for c in ("enter", "leave")),
                                                                      T.StructField("last", T.BooleanType())]))
    over = stored(over, "borders")  # at most two rows a partition of the sort: small enough for a broadcast
    found = numbered.alias("n").join(F.broadcast(over.alias("o")), (F.col("n.part") == F.col("o.part")) & F.col("n.conv").eqNullSafe(F.col("o.conv")), "left")
    found = (found.select("n.part", "n.conv", "turn", "role", "text", "seq", "enter", "leave", "last").repartition("part").sortWithinPartitions("part", "seq"))
    schema = T.StructType([conv, T.StructField("place", T.LongType()), turn, *(T.StructField(c, T.StringType()) for c in ("role", "new_role", "action")),
                           T.StructField("n_inserted", T.LongType()), T.StructField("segment", T.StringType())])
    out = found.mapInArrow(_repair_batches(*kinds), schema)
    return out.select(F.col("conv").alias(conv_col), "place", F.col("turn").alias(turn_col), F.col("role").alias(role_col), "new_role", "action", "n_inserted", "segment")
