import itertools
import random

from vigil.llm import roles

LEGAL_NEXT = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def legal(seq):
    p = None
    for r in seq:
        if r not in LEGAL_NEXT[p]:
            return False
        p = r
    return p in (None, "assistant")


def least_cost(given):
    """Over all labelings, merges and insertions of up to two empty turns a gap."""
    best = 10**9
    n = len(given)
    for labels in itertools.product(roles.ROLES, repeat=n):
        base = sum(0 if x == g else roles.NAME if g not in roles.ROLES else roles.RELABEL for x, g in zip(labels, given))
        for merges in itertools.product([False, True], repeat=n):
            if any(m and (i == 0 or labels[i] != labels[i - 1]) for i, m in enumerate(merges)):
                continue
            turns = [x for x, m in zip(labels, merges) if not m]
            cost = base + roles.MERGE * sum(merges)
            if cost < best:
                best = min(best, cost + roles.INSERT * fewest_inserts(turns))
    return best


def fewest_inserts(turns):
    """Breadth first over (turns used, open role)."""
    front, seen, n = {(0, None)}, set(), 0
    while front:
        stack = list(front)
        while stack:
            i, p = stack.pop()
            if i < len(turns) and turns[i] in LEGAL_NEXT[p] and (i + 1, turns[i]) not in front:
                front.add((i + 1, turns[i]))
                stack.append((i + 1, turns[i]))
        if any(i == len(turns) and p in (None, "assistant") for i, p in front):
            return n
        seen |= front
        front = {(i, q) for i, p in front for q in LEGAL_NEXT[p]} - seen
        n += 1
    return 10**6  # such turns follow no legal state


def test_cost_is_least():
    rng = random.Random(1)
    for _ in range(120):
        given = [rng.choice([*roles.ROLES, "tool"]) for _ in range(rng.randrange(0, 5))]
        labels, cost = roles.solve([roles.role_state(g) for g in given])
        assert cost == least_cost(given), given
        text = "".join(x[3] for x in roles.render([roles.role_state(g) for g in given], [str(i) for i in range(len(given))], labels))
        turns = [t.split("\n", 1) for t in text.split("<|im_start|>")[1:]]
        assert legal([r for r, _ in turns]) and all(body.endswith("<|im_end|>\n") for _, body in turns)
        assert sum(c.isdigit() for c in text) == len(given)


SCHEMA = "conv_id long, turn long, role string, text string, place long, segment string, part int"


def conversation(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA)


def test_one_hot_conversation_over_many_partitions(spark):
    rng = random.Random(2)
    rows = [(7, i, rng.choice(["user", "user", "assistant", "system", None, "Human"]), f"t{i}") for i in range(400)]
    rows += [(c, i, rng.choice(["user", "assistant"]), f"c{c}-{i}") for c in range(20) for i in range(rng.randrange(1, 8))]
    out = roles.repair_roles(conversation(spark, rows)).collect()
    assert len(out) == len(rows)
    for conv in {r[0] for r in rows}:
        given = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] is not None, r[2] or ""))
        states = [roles.role_state(r[2]) for r in given]
        labels, cost = roles.solve(states)
        got = sorted((r for r in out if r.conv_id == conv), key=lambda r: r.place)
        assert [r.turn for r in got] == [r[1] for r in given]
        new = [roles.role_state(r.new_role) for r in got]
        paid = sum(roles.NAME if s == 0 else roles.RELABEL for s, x in zip(states, new) if s != x) + roles.INSERT * sum(r.n_inserted for r in got) \
            + roles.MERGE * sum("merge" in r.action for r in got)
        assert paid == cost
        text = "".join(r.segment for r in got)
        assert legal([t.split("\n", 1)[0] for t in text.split("<|im_start|>")[1:]]) and text.count("<|im_end|>") == text.count("<|im_start|>")
        assert [t for _, _, _, t in given] == [t for t in text.replace("<|im_end|>", "\n").split("\n") if t and "<|" not in t]


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", ""), (2, 0, "", "x" * 500_000), (3, 0, "assistant", None)]
    out = roles.repair_roles(conversation(spark, rows)).collect()
    assert len(out) == len(rows)
    first = [r for r in out if r.conv_id is None][0]
    assert legal([t.split("\n", 1)[0] for t in first.segment.split("<|im_start|>")[1:]]) and first.n_inserted == 1
    same = sorted((r for r in out if r.conv_id == 1), key=lambda r: r.place)
    assert [r.turn for r in same] == [None, 0, 0]
    assert roles.repair_roles(conversation(spark, [])).collect() == []
