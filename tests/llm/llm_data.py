"""Small inputs of the llm tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

#: Extra columns whose names the operators use themselves.
EXTRA = "n_words long, kept string, host string, verdict string, ids string, spans string, label_ int, n int"
DOC_SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    long = " ".join(rng.choice(BASE) + str(rng.randrange(3000)) for _ in range(30_000))
    rows = [(1, "One two three four five six seven", "en", "a", 3), (1, "One two three four five six seven", "en", "a", 3), (None, "One two three four five six seven", None, None, None),
            (2, None, "en", "a", None), (3, "", "fr", "b", 0), (4, "  \n\t ", None, "b", 5), (5, "word", "de", None, 4), (None, None, None, None, None),
            (6, long, "en", "a", len(long)), (7, long, "en", "c", len(long)), (8, "Ünï 漢字 🙂 \x85 x\n\ny", "xx", "", 1), (8, "other text under the same id", "en", "a", 1)]
    extra = (1, "x", "h", "v", "i", "s", 9, 8)
    return spark.createDataFrame([(*r, *(extra if i % 2 else (None,) * 8)) for i, r in enumerate(rows)], DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def families(seed, groups, size, length, change):
    """Texts in groups of near copies: each a base text with some words changed."""
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [rng.choice(BASE) + str(rng.randrange(400)) for _ in range(length)]
        for _ in range(rng.randrange(1, size + 1)):
            out.append(" ".join(w if rng.random() > change else w.upper() if rng.random() < 0.2 else "new" + str(rng.randrange(10**6)) for w in base))
    rng.shuffle(out)
    return out


def no_python(df):
    """The plan has no Python node."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)
