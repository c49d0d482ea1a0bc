import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from llm_data import no_docs, odd_docs
from tokenizers import Tokenizer

from vigil.llm import _cuts, id_codec
from vigil.llm._text import buffer
from vigil.session import scratch_path

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip_and_parts():
    rng = random.Random(1)
    for n in (0, 1, 2, 239, 241, 1023, 1024, 1025, 5000):
        for top in (1, 2, 1 << 7, 1 << 16, 1 << 20, 1 << 40, 1 << 64):
            x = np.array([rng.randrange(top) for _ in range(n)], np.uint64)
            data = id_codec.pack(x)
            assert np.array_equal(id_codec.unpack(data), x)
            for _ in range(4):
                a = rng.randrange(n + 1)
                b = rng.randrange(a, n + 1)
                assert np.array_equal(id_codec.unpack(data, a, b), x[a:b])


def test_mixed_widths_escapes_and_size():
    rng = random.Random(2)
    x = np.array([rng.choice([0, 1, 3, 500, 1 << 59, 1 << 60, (1 << 64) - 1]) for _ in range(9000)], np.uint64)
    assert np.array_equal(id_codec.unpack(id_codec.pack(x)), x)
    assert len(id_codec.pack(np.zeros(1 << 16, np.uint64))) < 4000
    assert len(id_codec.pack(np.full(1 << 16, 40_000, np.uint64))) < (1 << 16) * 64 / 3 / 8 * 1.02


def test_library_ids():
    plain = Tokenizer.from_file(FILE)
    plain.encode_special_tokens = True
    with open(FILE, "rb") as f:
        coder = id_codec.library_coder(f.read())
    rng = random.Random(3)
    texts = [None, "", " ", "a  b ", "\t x\x1c\x1dy", "Ünï ß²½ 漢字 <|endoftext|>"] + ["".join(rng.choice("ab '\n\t éЖ漢1!?s") for _ in range(50)) for _ in range(500)]
    want = [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    flat, cuts = coder.encode(pa.array(texts))
    assert coder.usual and [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == want
    flat, cuts = id_codec.with_end(flat, cuts, 2)
    assert [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [x + [2] for x in want]


def test_cuts_equal_the_pattern():
    rng = random.Random(5)
    texts = ["", "it's  'll x", "don't I'LL 's 'sound '' ''s 'lx a'", "x\x85 y", "x\xa0\xa0y \xa0z", "12½ ²x", "a \n b\n\n", "!'s"]
    texts += ["".join(rng.choice("ab '\n\t é1!?stmdrevl\xa0\x85ñ") for _ in range(rng.randrange(40))) for _ in range(3000)]
    raw, offs = buffer(pa.array(texts))
    start = _cuts.pieces(raw, _cuts.classes(raw), offs)
    got = [[] for _ in texts]
    for a, b, i in zip(start, np.append(start[1:], len(raw)), np.searchsorted(offs, start, "right") - 1):
        got[i].append(raw[a:b].tobytes().decode())
    find = regex.compile(_cuts.USUAL).findall
    assert got == [find(t) for t in texts]


def test_forgetting_changes_nothing():
    with open(FILE, "rb") as f:
        coder = id_codec.LibraryCoder(f.read())
    coder.pieces.size = 3
    for t in ("the quick brown fox", "jumps over", "the lazy dog", "漢字", None):
        flat, _ = coder.encode(pa.array([t], pa.string()))
        assert flat.tolist() == coder.tokenizer.encode(t or "", add_special_tokens=False).ids


def by_hand(rows, end_id):
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_documents(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "quick", "Füchse", "x1", "\n"]) for _ in range(rng.randrange(300)))) for i in rng.sample(range(10**6), 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = id_codec.encoded_digest(docs, FILE, 2)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, 2)
    path = scratch_path(spark, "ids")
    id_codec.write_ids(docs, path, FILE, 2)
    ids = [r.doc_ids for r in spark.read.parquet(path).orderBy("shard", "first").collect()]
    assert [i for part in ids for i in part] == sorted(i for i, _ in rows)  # one ascending order over all shards


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = id_codec.encoded_digest(docs, FILE, 2).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ours = sorted((r.start, r.n_tokens) for r in got)
    assert [a for a, _ in ours] == [0, *np.cumsum([n for _, n in ours])[:-1].tolist()]
    want = by_hand(rows, 2)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted((d, n, c) for d, _, n, c in want if d is not None)
    assert id_codec.encoded_digest(no_docs(spark), FILE, 2).collect() == []


def test_added_tokens_within_texts(spark):
    """As by the library's default: the string of an added token is that token; later starts follow."""
    plain = Tokenizer.from_file(FILE)
    texts = ["a <|endoftext|> b", "a <|endoftext|", "<|endoftext|><|endoftext|>", None, "it's  1 b", "Ünï 漢字 <|endoftext|>x"]
    at, want = 0, []
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, id_codec.encoded_digest(docs, FILE, 2).collect())) == want


@pytest.mark.parametrize("kind", ["date", "decimal(20,0)", "timestamp", "smallint", "string"])
def test_ids_of_any_type(spark, kind):
    docs = spark.range(30).selectExpr(("timestamp_seconds(id * 86400)" if kind in ("date", "timestamp") else "id") + " as n", "concat('text ', id) as text")
    docs = docs.selectExpr(f"cast(n as {kind}) as doc_id", "text").unionByName(spark.createDataFrame([(None, "none")], "doc_id string, text string").selectExpr(f"cast(doc_id as {kind}) as doc_id", "text"))
    got = id_codec.encoded_digest(docs.repartition(3), FILE, 2)
    assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, (r.doc_id for r in docs.collect())))
