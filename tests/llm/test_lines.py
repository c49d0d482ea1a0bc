import random
import re
from collections import Counter, defaultdict

from llm_data import BASE, LOW, WORD, no_docs, no_python, odd_docs

from vigil.llm import _lines, line_quality, site_lines

BLANK = " \t\n\x0b\x0c\r"


def corpus(spark, seed=1):
    """Sites (one with a third of all rows) with boilerplate lines of their own, copies, repeats and junk."""
    rng = random.Random(seed)

    def line():
        return " ".join(rng.choice(BASE) + str(rng.randrange(50)) for _ in range(rng.randrange(1, 30)))

    common = {s: [line() for _ in range(3)] for s in ("a", "b", "c", None)}
    rows = []
    for i in range(240):
        s = rng.choice(["a", "a", "b", "c", None, "tiny" + str(i)])
        own = [line() for _ in range(rng.randrange(0, 8))]
        extra = [x if rng.random() < 0.5 else f" {x.upper()}\t" for x in common.get(s, []) if rng.random() < 0.3]
        parts = own + extra + rng.choice([[], ["", "  "], own[:2], [" ".join(["spam ham egg"] * 30)]])
        rng.shuffle(parts)
        rows.append((i, rng.choice(["\n", "\n", "\r\n"]).join(parts), "en", s, 1))
    rows += [rows[0], (None, "a b c", "en", "a", 1), (None, None, None, None, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def base_by_hand(text):
    w = WORD.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    places = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    full = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(places)


def normal(x):
    return re.sub(r"[\x20\x09-\x0D]+", " ", x.strip(BLANK).translate(LOW))


def verdicts_by_hand(rows, least, max_share, max_lost):
    docs, held = defaultdict(set), defaultdict(set)
    for r in rows:
        doc = r[1] or ""
        docs[r[3]].add(doc)
        for x in {normal(x) for x in (r[1] or "").split("\n") if x.strip(BLANK)}:
            held[r[3], x].add(doc)
    bad = {k for k, d in held.items() if len(d) >= least and len(d) > max_share * len(docs[k[0]])}
    out = []
    for r in rows:
        m = base_by_hand(r[1])
        lost = sum(len(WORD.findall(x)) for x in (r[1] or "").split("\n") if x.strip(BLANK) and (r[3], normal(x)) in bad)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        out.append((r[0], *m, lost, failed, not failed and lost <= max_lost * m[0]))
    return out, bad


def test_quality_equals_plain_python(spark, monkeypatch):
    rows, docs = corpus(spark)
    cols = ["doc_id", *line_quality.MEASURES, "words_lost", "base_failed", "kept"]
    want, bad = verdicts_by_hand(rows, 5, 0.1, 0.2)
    assert bad and len({(w[-2], w[-1]) for w in want}) == 3
    for limit in (1 << 25, 0):  # a broadcast, then the salted join
        monkeypatch.setattr("vigil.llm._jobs.BROADCAST_BYTES", limit)
        got = line_quality.judged(docs, least=5, max_share=0.1, max_lost=0.2)
        assert no_python(got)
        assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(want, key=str)
    kept = line_quality.keep_good(docs, least=5, max_share=0.1, max_lost=0.2)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if w[-1])


def site_lines_by_hand(rows, least, ratio):
    pages = Counter(s for s, _ in {(r[3], r[1] or "") for r in rows})
    held = Counter((s, x) for s, t in {(r[3], r[1] or "") for r in rows} for x in {x.strip(BLANK) for x in t.split("\n")} if x)
    return {k for k, n in held.items() if n >= least and n > ratio * pages[k[0]]}


def test_site_lines_equal_plain_python(spark, monkeypatch):
    rows, docs = corpus(spark, 2)
    bad = site_lines_by_hand(rows, 4, 0.1)
    assert bad
    want = []
    for r in rows:
        full = (r[1] or "").split("\n")
        left = [x for x in full if (r[3], x.strip(BLANK)) not in bad]
        want.append((r[0], None if r[1] is None else "\n".join(left), r[2], r[3], r[4], len(full) - len(left)))
    for limit in (1 << 25, 0):
        monkeypatch.setattr("vigil.llm._jobs.BROADCAST_BYTES", limit)
        got = site_lines.drop_site_lines(docs, max_ratio=0.1, min_pages=4, dropped_col="gone")
        assert no_python(got)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_odd_rows(spark):
    docs, none = odd_docs(spark), no_docs(spark)
    rows = docs.collect()
    got = line_quality.judged(docs)
    assert sorted(((r.doc_id, r.n_words, r.n_repeat_words) for r in got.collect()), key=str) == sorted(((r.doc_id, *[base_by_hand(r.text)[i] for i in (0, 4)]) for r in rows), key=str)
    assert line_quality.keep_good(docs).schema == docs.schema and line_quality.keep_good(docs).count() == 2
    assert line_quality.judged(none).collect() == [] and line_quality.keep_good(none).collect() == []
    clean = site_lines.drop_site_lines(docs)
    assert clean.schema == docs.schema and sorted(map(str, clean.collect())) == sorted(map(str, rows))
    assert site_lines.drop_site_lines(none).collect() == []


def test_windows_of_a_long_repetitive_text(spark):
    text = " ".join(["x y z"] * 20_000 + [f"w{i}" for i in range(20_000)])
    got = line_quality.judged(spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string")).first()
    assert (got.n_words, got.n_repeat_words, got.kept) == (80_000, 60_000, False)
    assert _lines.BLANK == BLANK


def test_copies_make_no_boilerplate(spark):
    """1,000 copies of a text on a site of 60: its lines stay, and don't hide the footer that 10 different texts hold."""
    rng = random.Random(9)

    def line(n):
        return " ".join(rng.choice(BASE) + str(rng.randrange(10**6)) for _ in range(n))

    own, foot = "\n".join(line(30) for _ in range(4)), line(6)
    rows = [(i, "\n".join([line(60), *([foot] if i < 12 else [])]), "a") for i in range(60)] + [(100 + i, own, "a") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in site_lines.drop_site_lines(docs, dropped_col="gone").collect()}
    assert all(got[i].gone == (1 if i < 12 else 0) for i in got) and all(got[i].text == own for i in range(100, 1100))
    judged = {r.doc_id: r for r in line_quality.judged(docs).collect()}
    assert all(judged[i].kept and judged[i].words_lost == (6 if i < 12 else 0) for i in judged)


def test_a_site_of_many_frequent_lines(spark, monkeypatch):
    """A row of 3,000 hashes counts with its bytes: beyond the limit it isn't broadcast, and the result is the same."""
    from vigil.llm import _jobs

    lines = [f"line number {i} of this site" for i in range(3000)]
    rows = [(i, "\n".join([*lines, f"text {i} of its own"]), "a") for i in range(6)] + [(9, "one\ntwo", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bad = _lines.frequent_lines(docs, _lines.site_key("source"), docs["text"], lambda x: _lines.F.xxhash64(x), 5, 0.5)
    assert 24_000 < _jobs.measured_bytes(bad) < 80_000
    plans = []
    for limit in (1 << 20, 20_000):
        monkeypatch.setattr("vigil.llm._jobs.BROADCAST_BYTES", limit)
        got = site_lines.drop_site_lines(docs, max_ratio=0.5, dropped_col="gone")
        plans.append("salt_" in got._jdf.queryExecution().logical().toString())
        assert sorted((r.doc_id, r.gone) for r in got.collect()) == [*((i, 3000) for i in range(6)), (9, 0)]
    assert plans == [False, True]


def test_frequent_lines_leave_the_text(spark, monkeypatch):
    rows, docs = corpus(spark, 3)
    want, bad = verdicts_by_hand(rows, 5, 0.1, 0.2)

    def clean(r):
        full = (r[1] or "").split("\n")
        left = [x for x in full if not x.strip(BLANK) or (r[3], normal(x)) not in bad]
        return r[1] if len(left) == len(full) else "\n".join(left)

    texts = [(r[0], clean(r), w[-1]) for r, w in zip(rows, want)]
    assert sum(t != r[1] for r, (_, t, kept) in zip(rows, texts) if kept) > 10
    for limit in (1 << 25, 0):
        monkeypatch.setattr("vigil.llm._jobs.BROADCAST_BYTES", limit)
        got = line_quality.judged(docs, least=5, max_share=0.1, max_lost=0.2).select("doc_id", "text", "kept")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(texts, key=str)
        kept = line_quality.keep_good(docs, least=5, max_share=0.1, max_lost=0.2)
        assert no_python(kept) and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((t[:2] for t in texts if t[2]), key=str)


def test_a_depleted_document_at_the_production_parameters(spark):
    """60 documents of a site, 12 of them with a shared passage of 90 words; one has hardly more than that."""
    rng = random.Random(4)

    def text(n):
        return " ".join(rng.choice(BASE) + str(rng.randrange(10**6)) for _ in range(n))

    shared = [text(30) for _ in range(3)]
    rows = [(i, "\n".join([text(20), *(shared if i < 12 else []), text(200 if i else 10)]), "a", 7) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = {r.doc_id: r for r in line_quality.judged(docs).collect()}
    assert (got[0].words_lost, got[0].n_words, got[0].base_failed, got[0].kept) == (90, 120, False, False)
    assert all(r.kept for r in got.values() if r.doc_id)
    from corpus_pipeline import quality

    left = {r.doc_id: r for r in quality(spark, docs, "").collect()}
    assert sorted(left) == list(range(1, 60))
    for i, t, _, n in rows[1:]:
        mine = "\n".join(x for x in t.split("\n") if x not in shared)
        assert (left[i].text, left[i].n_chars) == (mine, len(mine) if i < 12 else n)
