import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_data import no_docs, odd_docs

from vigil.llm import prefix_bpe
from vigil.llm._cuts import USUAL
from vigil.llm._text import small

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(FILE, "rb") as f:
        return prefix_bpe.coder(f.read(), public_tokenizers.PATTERN)


def texts():
    rng = random.Random(1)
    out = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "it's  'll x", "\t a\tb  c", "\x1c a\x1cb !\x1c\x1d", "日本語 текст 🙂🙂", "a" * 2000, "=-" * 300, "x\x85 y z", "12 ½ ١٢٣",
           "<|endoftext|>", "\r\n\r\n a", "don't I'LL we've 's'S"]
    out += ["".join(rng.choice("ab '\n\t éЖ漢1!?s") for _ in range(rng.randrange(60))) for _ in range(800)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x2FFF)])) for _ in range(30)) for _ in range(400)]
    return out


def test_ids_equal_the_library(coder, library):
    assert public_tokenizers.PATTERN == USUAL
    flat, cuts = coder.encode(pa.array(texts()))
    for t, a, b in zip(texts(), cuts[:-1], cuts[1:]):
        ids = flat[a:b].tolist()
        assert ids == library.encode_ordinary(t), repr(t)
        assert coder.decode(ids) == t.encode() and coder.joined(ids) == ",".join(map(str, ids))
    other = prefix_bpe.TextCoder(coder.vocabulary, r"\S+|\s+")  # another pattern: no shortcut for usual pieces
    flat, cuts = other.encode(pa.array(["ab  cd", None]))
    assert other.decode(flat.tolist()) == b"ab  cd" and cuts.tolist()[1:] == [len(flat)] * 2


def test_pairs_by_merging(coder):
    v, rng = coder.vocabulary, random.Random(2)
    tokens = rng.sample(sorted(v.ranks), 400)
    for a, b in zip(tokens, tokens[1:] + tokens[:1]):
        assert v.side_by_side(a, b) == (v.merged(a + b) == [a, b])


def test_appends_and_edits_stay_exact(coder):
    rng, v = random.Random(3), coder.vocabulary
    for _ in range(150):
        data = bytes(rng.choice(b"abcdefgh then\xc3\xa9") for _ in range(rng.randrange(1, 600)))
        table = prefix_bpe.PrefixTable(v)
        for i in range(0, len(data), 37):
            table.append(data[i:i + 37])
        assert table.tokens() == prefix_bpe.PrefixTable(v, data).tokens() == [v.ranks[t] for t in v.merged(data)]
        a = rng.randrange(len(data) + 1)
        b = rng.randrange(a, min(len(data), a + 5) + 1)
        new = bytes(rng.choice(b"abth ") for _ in range(rng.randrange(4)))
        table.replace(a, b, new)
        assert table.tokens() == prefix_bpe.PrefixTable(v, data[:a] + new + data[b:]).tokens()
    long = prefix_bpe.PrefixTable(v, b" the quick fox" * 2000)
    assert long.replace(100, 101, b"x") < 1000


def test_small_vocabularies():
    rng = random.Random(4)
    for _ in range(60):
        ranks = {b"a": 0, b"b": 1, b"c": 2}
        for i in range(3, 12):  # each new token joins two older ones that stand side by side
            x, y = rng.choice(sorted(ranks)), rng.choice(sorted(ranks))
            if prefix_bpe.Vocabulary(ranks).merged(x + y) == [x, y]:
                ranks[x + y] = i
        v = prefix_bpe.Vocabulary(ranks).check()
        for _ in range(20):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14)))
            assert prefix_bpe.PrefixTable(v, data).tokens() == [v.ranks[t] for t in v.merged(data)], (ranks, data)
    with pytest.raises(ValueError):
        prefix_bpe.Vocabulary({b"a": 5, b"b": 6, b"c": 7, b"ab": 3, b"abc": 1}).check()


def test_odd_rows(spark, library):
    docs = odd_docs(spark)
    got = prefix_bpe.encode_texts(docs, FILE, public_tokenizers.PATTERN)
    assert got.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest(), ids))
    rows = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert prefix_bpe.encode_texts(no_docs(spark), FILE, public_tokenizers.PATTERN, keep=["doc_id"], ids=False).collect() == []


def test_batches_of_bounded_texts():
    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["ab", None, "x" * 50, "", "cd", "ef"])], ["i", "t"])
    cut = list(small(iter([b]), 1, 4))
    assert [x.column(0).to_pylist() for x in cut] == [[0, 1], [2], [3, 4, 5]]
    assert [t for x in cut for t in x.column(1).to_pylist()] == b.column(1).to_pylist()
