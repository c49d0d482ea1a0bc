"""Quoted CSV records across lines and split borders, held against a plain parser."""

import csv
import glob
import io
import os
import random

import numpy as np
import pytest

from vigil.sources import records
from vigil.sources.files import read_cases


def land(tmp_dir, text, name="a.csv", encoding="utf-8"):
    with open(os.path.join(tmp_dir, name), "w", encoding=encoding, newline="") as f:
        f.write(text)
    return tmp_dir


def parsed(text, sep=","):
    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]


def read(spark, path, split=None, **kw):
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    if split:
        spark.conf.set(key, str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return [tuple(r["row"]) for r in sorted(records.read_csv(spark, path, header=False, **kw).collect(), key=lambda r: (r["file"], r["number"]))]
    finally:
        spark.conf.set(key, was)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def same(got, want):
    return [tuple(x or "" for x in r) for r in got] == [tuple(r) for r in want]


HARD = ['plain', '', 'Korea "South"', 'a,b', 'two\nlines', 'x\\', '\\', '"', '""', 'line\n\n\nbreaks\n', 'mid"dle', ' blank ', '\r\nwin', "'", 'é漢', ',\n","\n']


def table(seed, rows, width=4):
    rng = random.Random(seed)
    out = io.StringIO()
    w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    w.writerow([f"h{i}" for i in range(width)])
    for _ in range(rows):
        w.writerow([rng.choice(HARD) for _ in range(width - 1)] + ["end"])
    return out.getvalue()


@pytest.mark.parametrize("split", [None, 1 << 20, 200, 37])
def test_hard_fields_equal_the_plain_parser(spark, tmp_dir, split):
    text = table(split or 1, 60)
    land(tmp_dir, text)
    assert same(read(spark, tmp_dir, split), parsed(text))


def test_a_text_over_many_splits(spark, tmp_dir):
    long = "\n".join(f'line {i} with ""quotes"", and commas' for i in range(300))
    text = f'a,b\n1,"{long}"\n2,"x"\n3,"y\n"\n'
    land(tmp_dir, text)
    got = read(spark, tmp_dir, 100)
    assert same(got, parsed(text)) and len(got) == 4


def test_files_are_numbered_on_their_own(spark, tmp_dir):
    texts = {f"f{i}.csv": table(i + 10, 20) for i in range(4)}
    for name, text in texts.items():
        land(tmp_dir, text, name)
    rows = records.read_csv(spark, tmp_dir).orderBy("file", "number").collect()
    assert rows[0]["row"].asDict().keys() == {"h0", "h1", "h2", "h3"}
    assert same([tuple(r["row"]) for r in rows], [r for n in sorted(texts) for r in parsed(texts[n])[1:]])
    land(tmp_dir, "other,header\n", "z.csv")
    with pytest.raises(ValueError, match="different headers"):
        records.read_csv(spark, tmp_dir)


def test_simple_quotes_need_no_python(spark, tmp_dir):
    text = 'a,b\n1,"x, y"\n2,"say ""hi"""\n\n3,\n4,"z"\n'
    land(tmp_dir, text)
    df = records.read_csv(spark, tmp_dir, header=False)
    assert "Arrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert same(read(spark, tmp_dir, 8), parsed(text))
    assert [r.number for r in records.read_records(spark, tmp_dir).orderBy("number").collect()] == [0, 1, 2, 4, 5]


def test_stray_quotes_separators_and_encodings(spark, tmp_dir):
    text = 'n;v\n5" pipe;a\nit"s;"b;\nc"\nno"quote;"d"\n'
    land(tmp_dir, text)
    assert same(read(spark, tmp_dir, 9, sep=";"), parsed(text, ";"))
    other = tmp_dir + "-latin"
    os.mkdir(other)
    land(other, 'n,v\n"São\nTomé",1\n', encoding="latin-1")
    assert read(spark, other, encoding="ISO-8859-1") == [("n", "v"), ("São\nTomé", "1")]
    with pytest.raises(ValueError, match="encoding"):
        records.read_records(spark, other, encoding="UTF-16")
    with pytest.raises(ValueError, match="single"):
        records.read_records(spark, other, sep="||")


def test_empty_and_quoted_empty_fields(spark, tmp_dir):
    land(tmp_dir, 'a,b\n,""\n"",\n')
    assert read(spark, tmp_dir) == [("a", "b"), (None, ""), ("", None)]


def test_unended_text_and_empty_files(spark, tmp_dir):
    land(tmp_dir, 'a,b\n1,"never\nends\n')
    with pytest.raises(ValueError, match="no end"):
        records.read_csv(spark, tmp_dir)
    other = tmp_dir + "-empty"
    os.mkdir(other)
    land(other, "")
    with pytest.raises(ValueError, match="no records"):
        records.read_csv(spark, other)
    land(other, "a,a,,A\n1,2,3,4\n", "b.csv")
    assert records.read_csv(spark, other).select("row.*").columns == ["a", "a1", "_c2", "A3"]


def test_long_fields_with_many_quotes(spark, tmp_dir):
    big = '""' * 200_000
    text = f'a,b\n"{big}",1\n"{"x" * 300_000}\n",2\n' + ",".join(["c"] * 20_000) + "\n"
    land(tmp_dir, text)
    got = records.read_records(spark, tmp_dir).orderBy("number").collect()
    assert [len(r.record) for r in got] == [3, len(big) + 4, 300_005, 39_999]


def test_states_compose():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(0, 12))
        out, in_ = rng.random(n) < 0.4, rng.random(n) < 0.6
        for first in (False, True):
            want = [first]
            for i in range(n):
                want.append(bool(in_[i] if want[-1] else out[i]))
            assert records._states(out, in_, first).tolist() == want


def test_reader_probe_rows(spark, tmp_dir):
    text = 'iso_code,date,location,continent,new_cases,new_deaths\nKOR,2020-01-01,"Korea ""South""",Asia,1,2\nXXX,2020-01-02,"two\nlines",Asia,3,4\nYYY,2020-01-03,"x\\",Asia,5,6\n'
    land(tmp_dir, text)
    got = read_cases(spark, tmp_dir, ordinal=True).orderBy("source_ordinal").collect()
    assert [(r.id, r.location, r.new_cases, r.new_deaths) for r in got] == [("KOR", 'Korea "South"', 1, 2), ("XXX", "two\nlines", 3, 4), ("YYY", "x\\", 5, 6)]
    assert [r.source_ordinal.row for r in got] == [1, 2, 3] and len(glob.glob(tmp_dir + "/*.csv")) == 1
