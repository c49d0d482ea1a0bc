import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_data import no_docs, odd_docs
from tokenizers import Tokenizer

from vigil.llm import _remember, packing, packing_plan
from vigil.llm._text import buffer

FILE = public_tokenizers.path("word_bpe_49k.json")


def coder():
    with open(FILE, "rb") as f:
        return packing.word_coder(f.read())


def ragged(flat, cuts):
    return [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]


def test_words_alone_equal_whole_texts():
    rng = random.Random(1)
    texts = [None, "", " ", "a\x0bb\x0cc", "a\x85b\xa0c d", "A'LL we'Re 's '' x's12", "<|endoftext|>a <|startoftext|> x<|endoftext|>", "é ́x é\nÀ", "İSTANBUL ΑΣ ΑΣ.", "한국어 각 日本語", "́ ẛ̣", "x" * 5000]
    texts += ["a<|ENDOFTEXT|>b A<|endoftext|>B", "İ, xİ.", "Größe,ÄÖÜ!½12ab", "ⱥȺ,Ⱥ ªº²"]
    texts += ["".join(rng.choice("aB'İ,.Äß1²\xa0 Ⱥ<") for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["".join(rng.choice("ab'LsTRe \n\t\x0b\x1c\x85é́İß漢1½!?<|>Σ ") for _ in range(rng.randrange(60))) for _ in range(3000)]
    plain = Tokenizer.from_file(FILE)
    c = coder()
    assert c.by_word
    for _ in range(2):  # the second time from memory
        assert ragged(*c.encode(pa.array(texts))) == [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_other_files_are_encoded_whole():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        c = packing.WordCoder(f.read())
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not c.by_word and ragged(*c.encode(pa.array(["a  b c", None]))) == [plain.encode("a  b c").ids, []]


def test_remembered_pieces():
    rng = random.Random(2)
    calls = []

    def encode(texts):
        calls.extend(texts)
        return [np.frombuffer(t.encode(), np.uint8) for t in texts]

    r = _remember.Remembered(encode, 300)
    for step in range(30):
        words = ["".join(rng.choice("ab\x00é漢") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 40]))) for _ in range(rng.choice([1, 50, 2000]))]
        raw, offs = buffer(pa.array(words))
        flat, count = r.of(raw, offs[:-1], offs[1:])
        assert bytes(flat.astype(np.uint8)) == "".join(words).encode() and count.tolist() == [len(w.encode()) for w in words]
    assert r.of(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))[0].tolist() == []
    r = _remember.Remembered(encode, 1000)
    raw, offs = buffer(pa.array(["one", "two", "one"]))
    calls.clear()
    for _ in range(3):
        r.of(raw, offs[:-1], offs[1:])
    assert sorted(calls) == ["one", "two"]


@pytest.mark.parametrize("size", [100, 10_000, 10**6])
def test_pieces_stay_known_as_the_table_grows(size):
    rng = random.Random(size)
    r = _remember.Remembered(lambda texts: [np.frombuffer(t.encode(), np.uint8) for t in texts], size)
    for step in range(12):
        words = [f"{rng.randrange(2000 * (step + 1))}-{'long' * rng.randrange(6)}" for _ in range(6000)]
        raw, offs = buffer(pa.array(words))
        assert bytes(r.of(raw, offs[:-1], offs[1:])[0].astype(np.uint8)).decode() == "".join(words)


def test_colliding_pieces_are_told_apart(monkeypatch):
    keys = _remember.piece_keys
    monkeypatch.setattr(_remember, "piece_keys", lambda *a: (keys(*a)[0] & np.uint64(3), *keys(*a)[1:]))
    r = _remember.Remembered(lambda texts: [np.frombuffer(t.encode(), np.uint8) for t in texts], 1000)
    words = [f"w{i % 50}" for i in range(200)]
    for _ in range(3):
        raw, offs = buffer(pa.array(words))
        assert bytes(r.of(raw, offs[:-1], offs[1:])[0].astype(np.uint8)).decode() == "".join(words)


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_all_items_within_the_capacity(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([8, 100, 1000]))
    for n in (0, 1, 7, 400, 3000):
        items = np.sort(rng.integers(1, capacity, n) if seed % 2 else np.minimum(rng.geometric(4 / capacity, n), capacity - 1))[::-1]
        least = max(1, capacity // 4)
        counts = np.bincount(items, minlength=capacity + 1)
        large = packing_plan.LargePlan(counts, capacity, least)
        n_large = int((items >= least).sum())
        at = large.sequences(np.arange(n_large))
        load = np.bincount(at, items[:n_large], large.n).astype(int)
        assert len(load) == large.n and load.max(initial=0) <= capacity and load.min(initial=1) > 0
        order = np.argsort(capacity - load, kind="stable")
        room = sorted(zip(*np.unique(capacity - load, return_counts=True)))
        plan = packing_plan.SmallPlan(counts, capacity, least, [(int(a), int(b)) for a, b in room])
        load = np.concatenate([load[order], np.zeros(plan.n - large.n, int)])
        np.add.at(load, plan.sequences(items[n_large:], np.arange(n_large, n)), items[n_large:])
        assert load.max(initial=0) <= capacity and load.min(initial=1) > 0
        low = -(-int(items.sum()) // capacity)
        assert plan.n <= 11 / 9 * max(low, int((items > capacity // 2).sum())) + 6


def test_configurations_are_optimal_on_a_known_case():
    found = packing_plan.configurations([50, 30, 20], [4, 4, 4], 100)
    assert sum(n for _, n in found) == 4 and (sum(c * n for c, n in found) == 4).all()  # 400 of 400: each 50 + 30 + 20
    assert packing_plan.group_counts(np.array([0, 5, 0, 3]), 3) == [(3, 2), (3, 3), (1, 3)]


def test_best_fit_takes_the_fullest_sequence():
    fit = packing_plan.BestFit(10, [(3, 2), (5, 1)])
    assert fit.add(3, 1) == [(0, 1, 1, 1)] and fit.add(2, 3) == [(1, 1, 1, 1), (2, 1, 2, 2)] and fit.add(4, 3) == [(3, 2, 2, 3)] and fit.n == 5


def check(docs, rows, capacity):
    """Every piece where it should be, sequences without gaps."""
    plain = Tokenizer.from_file(FILE)
    want = []
    for d, text in docs:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(str(d), i, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes())) for i, at in enumerate(range(0, len(ids), capacity))]
    assert sorted(want) == sorted((str(r.doc_id), r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return at


def test_documents_packed_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    for capacity in (64, 4096):
        rows = packing.pack(docs, FILE, 1, capacity).collect()
        at = check([(r.doc_id, r.text) for r in docs.collect()], rows, capacity)
        assert len(at) <= 1.02 * -(-sum(r.length for r in rows) // capacity) + 1


def test_odd_documents(spark):
    docs = odd_docs(spark)
    rows = packing.pack(docs, FILE, 1, 1000).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], rows, 1000)
    assert packing.pack(no_docs(spark), FILE, 1).count() == 0


def test_sequences_are_written(spark):
    from vigil.session import scratch_path

    docs = odd_docs(spark)
    packed = packing.pack(docs, FILE, 1, 500)
    rows = packed.collect()
    path = scratch_path(spark, "sequences")
    packing.write_sequences(packed, path)
    got = spark.read.parquet(path).collect()
    assert sum(r.n_tokens for r in got) == sum(r.length for r in rows)
    for r in got:
        assert len(r.ids) == 4 * r.n_tokens and [p.offset for p in r.parts] == [0, *np.cumsum([p.length for p in r.parts])[:-1].tolist()]
    assert sorted(zlib.crc32(r.ids[4 * p.offset:4 * (p.offset + p.length)]) for r in got for p in r.parts) == sorted(zlib.crc32(r.ids) for r in rows)


def test_many_equal_rows(spark):
    docs = spark.createDataFrame([(None, "same words here")] * 3000 + [(1, "x " * 700)], "doc_id long, text string").repartition(4)
    rows = packing.pack(docs, FILE, 1, 1000).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], rows, 1000)
