import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from llm_data import BASE, no_docs, odd_docs, shingles
from pyspark.sql import functions as F
from test_chosen_path import by_hand as components_by_hand
from test_lines import BLANK, normal, site_lines_by_hand, verdicts_by_hand

import __spark_entry__ as entry
import corpus_pipeline
from vigil.llm.queries import ORACLE, QUERIES


def corpus():
    """Good, bad, near-equal and contaminated documents with boilerplate of their source."""
    rng = random.Random(8)

    def line(n):
        return " ".join(rng.choice(BASE) + str(rng.randrange(60)) for _ in range(n))

    items = [(i, line(rng.randrange(12, 30))) for i in range(6)]
    foot = {s: line(9) for s in ("a", "b")}
    few = line(8)  # on few pages of a small source: too few for the quality stage, enough for the line dedup
    rows = []
    for i in range(160):
        s = rng.choice(["a", "a", "b", None])
        parts = [line(rng.randrange(15, 30)) for _ in range(rng.randrange(1, 7))]
        if rng.random() < 0.15:
            parts.insert(1, rng.choice(items)[1])
        if rng.random() < 0.5:
            parts.append(foot.get(s, "x"))
        if rng.random() < 0.1:
            parts = [" ".join(["spam ham egg"] * 40)]
        if rows and rng.random() < 0.25:  # a near copy
            parts = rng.choice(rows)[1].replace("alpha1", "changed").split("\n")
        if i % 20 == 7:
            s, parts = "c", [*parts, few]
        text = "\n".join(parts)
        rows.append((i, text, "en", s, len(text)))
    return rows + [(160, None, None, None, None), (161, "", "en", "a", 0)], items


def pipeline_by_hand(rows, items):
    verdicts, frequent = verdicts_by_hand(rows, 10, 0.02, 0.3)
    clean = lambda r: "\n".join(x for x in r[1].split("\n") if not x.strip(BLANK) or (r[3], normal(x)) not in frequent)
    rows = [(r[0], clean(r), *r[2:]) for r, v in zip(rows, verdicts) if v[-1]]
    bad = site_lines_by_hand(rows, 5, 0.02)
    rows = [(r[0], "\n".join(x for x in r[1].split("\n") if (r[3], x.strip(BLANK)) not in bad), *r[2:4]) for r in rows]
    kept = {d for d, _, _, k in components_by_hand([(r[0], r[1]) for r in rows], 5, 80, 100) if k}
    rows = [r for r in rows if r[0] in kept]
    tests = [shingles(t, 5) for _, t in items]
    return [r for r in rows if not any(len(q & shingles(r[1], 5)) >= 0.8 * len(q) for q in tests)], len(bad)


def test_pipeline_equals_plain_python(spark, tmp_dir):
    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    want, n_bad = pipeline_by_hand(rows, items)
    assert n_bad and 30 < len(want) < 110
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    assert sorted((r.doc_id, r.lang, r.source, r.ids, r.decoded_sha256) for r in got) == sorted(
        ((d, k, s, library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for d, t, k, s in want), key=lambda x: x[0])


def clashing(docs):
    """With columns of the names that stages use themselves."""
    return docs.withColumns({"gone_": F.lit("x"), "Gone__": F.lit(1), "site_": F.lit("y"), "row_": F.lit(2), "label": F.lit("z"), "cls": F.lit(None).cast("binary"), "key": F.lit(3)})


def test_stages_keep_the_columns(spark, tmp_dir):
    items = spark.createDataFrame([(1, "three four five SIX seven"), (None, None)], "item_id long, text string")
    items.write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "encode"]
    odd, none = odd_docs(spark), no_docs(spark)
    for docs in (odd, none, clashing(odd), odd.drop("n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, tmp_dir)
            if name != "encode":
                assert got.schema.names == docs.schema.names, name
            n = got.count()
            assert n == 0 if docs is none else n > 0, name
    kept = {r.doc_id for r in corpus_pipeline.decontaminate(spark, odd, tmp_dir).collect()}
    assert 1 not in kept and {2, 3, 4, 6, 8} <= kept


def test_empty_documents(spark, tmp_dir):
    no_docs(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and len(QUERIES) == 13
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE) <= set(entry.oracle_sql())
