"""Text queries: cleaning rules, lengths, tokens, stop words, n-grams, sentiment, polarity
(X-5..X-16, G-9, F-2, F-3, F-4, O-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.stopwords import ENGLISH_STOPWORDS
from vigil.functions.text import (clean_text, remove_colon, remove_hash, remove_links, remove_mentions,
                                  remove_rt, remove_stopwords, sentiment_label, text_length, tokens, word_count)
from vigil.operators.ngrams import explode_ngrams, ngram_counts, top_ngrams, top_ngrams_of, with_ngrams
from vigil.operators.sentiment import score_polarity, score_sentiment, score_sentiment_rules
from vigil.plans.catalog.base import oracle, register
from vigil.sources.tables import Inputs

# ---- DuckDB spellings ---------------------------------------------------------------------------


def clean_sql(col: str) -> str:
    s = f"regexp_replace({col}, '@[A-Za-z0–9]+', '', 'g')"
    s = f"replace(replace({s}, '#', ''), ':', '')"
    s = f"regexp_replace({s}, 'RT[\\s]+', '', 'g')"
    return f"regexp_replace({s}, 'https?//\\S+', '', 'g')"


STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOPWORDS) + "]"
TOKENS_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
FILTERED_SQL = "list_filter(" + TOKENS_SQL + ", lambda t: NOT list_contains(" + STOP_SQL + ", t))"


def ngrams_sql(list_expr: str, n: int) -> str:
    return (f"list_transform(range(1, len({list_expr}) - {n - 2}), "
            f"lambda i: array_to_string({list_expr}[i:i + {n - 1}], ' '))")


ALL_POSTS = ("posts_in", f"SELECT post_id, date, tweet, {clean_sql('tweet')} AS text FROM v_posts")
EN_POSTS = ("posts_in", ALL_POSTS[1] + " WHERE language = 'en'")
FILTERED = ("filtered", f"SELECT post_id, {FILTERED_SQL.format('text')} AS f FROM posts_in")

# Test lexicon (a parameter of the scorer, not the published one): words that occur in the
# driver's documents, with valences that are exact binary fractions.
LEXICON = [("best", 3.0), ("great", 3.0), ("good", 1.75), ("free", 1.5), ("with", 0.5), ("for", 0.25),
           ("this", -0.25), ("no", -1.0), ("worthless", -2.0), ("idiot", -2.5), ("stupid", -2.5)]
# (polarity, subjectivity, intensity, modifier)
POLARITY_LEXICON = [("best", 1.0, 0.25, 1.0, False), ("great", 0.75, 0.75, 1.0, False), ("good", 0.625, 0.5, 1.0, False), ("with", 0.125, 0.25, 1.25, True),
                    ("this", 0.0, 0.5, 1.0, False), ("so", 0.25, 0.25, 1.5, True), ("no", -0.25, 0.5, 1.0, False), ("really", 0.25, 0.25, 1.25, True),
                    ("slow", -0.25, 0.5, 0.5, False), ("worthless", -0.5, 0.75, 1.0, False), ("idiot", -0.75, 1.0, 2.0, False), ("stupid", -0.75, 1.0, 1.0, False)]
#: What every fifth text gets behind it, by its id: modifiers, negations and exclamations.
POLAR_PHRASES = ["really good", "not good", "not a good day", "really not good", "it isn't really good", "not my good", "so so good!", "good! really", "never is so a great",
                 "no really best !!", "really of good", "so not a slow good", "not slow good", "really idiot good", "!"]
POLAR_SQL = ("text || CASE WHEN post_id % 5 = 0 THEN ' ' || [" + ", ".join("'" + x.replace("'", "''") + "'" for x in POLAR_PHRASES)
             + f"][post_id // 5 % {len(POLAR_PHRASES)} + 1] ELSE '' END")


def lexicon_df(inp: Inputs) -> DataFrame:
    return inp.spark.createDataFrame(LEXICON, "token string, valence double")


def polarity_df(inp: Inputs) -> DataFrame:
    return inp.spark.createDataFrame(POLARITY_LEXICON, "token string, polarity double, subjectivity double, intensity double, modifier boolean")


# "so" is a booster: it scores 0 itself although the lexicon has it; the others are words of the phrases below
LEXICON += [("so", 1.0), ("death", -2.5), ("bomb", -1.5), ("right", 0.75), ("kind", 2.25)]
LEX_CTE = ("lex", "SELECT token, CAST(valence AS DOUBLE) AS valence FROM (VALUES "
           + ", ".join(f"('{t}', {v})" for t, v in LEXICON) + ") t(token, valence)")
POL_CTE = ("pol", "SELECT token, CAST(polarity AS DOUBLE) AS polarity, CAST(subjectivity AS DOUBLE) AS subjectivity, CAST(intensity AS DOUBLE) AS intensity, modifier "
           "FROM (VALUES " + ", ".join(f"('{t}', {p}, {q}, {i}, {m})" for t, p, q, i, m in POLARITY_LEXICON)
           + ") t(token, polarity, subjectivity, intensity, modifier)")
# a text's tokens folded one by one: sp, ss, c: sums of closed assessments; p, s, i, neg: the open one; m, n: a modifier, a negation is held
_CLIP = "greatest(-1.0, least(1.0, {}))"
_CLOSE = "a.{0} + CASE WHEN a.has THEN {1} ELSE 0.0 END"
_SUMS = {"sp": _CLOSE.format("sp", "a.p * CASE WHEN a.neg THEN -0.5 ELSE 1.0 END"), "ss": _CLOSE.format("ss", "a.s"), "c": _CLOSE.format("c", "1.0")}
_UNKNOWN_N = "(x.isneg OR a.n AND x.size <= 1)"
_KNOWN = {**{k: f"CASE WHEN a.m THEN a.{k} ELSE {v} END" for k, v in _SUMS.items()}, "p": f"CASE WHEN a.m THEN {_CLIP.format('x.vp * a.i')} ELSE x.vp END",
          "s": f"CASE WHEN a.m THEN {_CLIP.format('x.vs * a.i')} ELSE x.vs END", "i": "CASE WHEN a.n THEN 1 / x.vi ELSE x.vi END",
          "neg": "a.n OR a.m AND a.neg", "has": "true", "m": "x.vm", "n": "x.isneg"}
_UNKNOWN = {"sp": "a.sp", "ss": "a.ss", "c": "a.c", "p": f"CASE WHEN x.excl THEN {_CLIP.format('a.p * 1.25')} ELSE a.p END", "s": "a.s", "i": "a.i",
            "neg": f"a.neg OR {_UNKNOWN_N} AND a.m", "has": "a.has", "m": f"a.m AND ({_UNKNOWN_N} OR x.size <= 2)", "n": f"{_UNKNOWN_N} AND NOT a.m"}
_TOKEN = {"known": "l.token IS NOT NULL", "vp": "COALESCE(l.polarity, 0.0)", "vs": "COALESCE(l.subjectivity, 0.0)", "vi": "COALESCE(l.intensity, 1.0)", "vm": "COALESCE(l.modifier, false)",
          "isneg": "t.tok IN ('no', 'not', 'n''t', 'never')", "excl": "t.tok = '!'", "size": "length(trim(t.tok, chr(39)))"}
_REST = {"known": "false", "vp": "CAST(0 AS DOUBLE)", "vs": "CAST(0 AS DOUBLE)", "vi": "CAST(1 AS DOUBLE)", "vm": "false", "isneg": "false", "excl": "false", "size": "CAST(0 AS BIGINT)"}
_NONE = {**{c: "CAST(0 AS DOUBLE)" for c in ("sp", "ss", "c", "p", "s", "i")}, **{c: "false" for c in ("neg", "has", "m", "n")}}


def _row(*parts: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{k}': {v}" for part in parts for k, v in part.items()) + "}"


def _step(c: str) -> str:
    return f"CASE WHEN x.known THEN {_KNOWN[c]} ELSE {_UNKNOWN[c]} END"


POLARITY_CTES = [
    POL_CTE,
    ("ptok", r"""SELECT post_id, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS pos FROM (SELECT post_id,
       regexp_extract_all(replace(lower(text), 'n''t', ' n''t'), 'n''t|[\p{L}\p{N}_]+(?:[''\-][\p{L}\p{N}_]+)*|!') AS toks FROM posts_in) z"""),
    ("pcode", f"SELECT post_id, list({_row(_TOKEN, _NONE)} ORDER BY pos) AS xs FROM ptok t LEFT JOIN pol l ON t.tok = l.token GROUP BY post_id"),
    ("pfold", f"SELECT post_id, list_reduce(xs, lambda a, x: {_row(_REST, {c: _step(c) for c in _NONE})}, {_row(_REST, _NONE)}) AS a FROM pcode"),
    ("psum", "SELECT post_id, " + ", ".join(f"{v} AS {k}" for k, v in _SUMS.items()) + " FROM pfold"),
]
_PUNCT = r"(?:\?!\?!|!\?!\?|\?!\?|!\?!|!!!|\?\?\?|!!|\?\?|[.!?,;:\-''\"])"
STRIP = f"regexp_replace(w0, '^{_PUNCT}([^[:punct:]]{{2,}})$|^([^[:punct:]]{{2,}}){_PUNCT}$', '\\1\\2')"
WORDS_CTE = ("wds", f"""SELECT post_id, CASE WHEN length(w0) > 1 THEN {STRIP} ELSE w0 END AS tok
FROM (SELECT post_id, unnest(regexp_extract_all(text, '\\S+')) AS w0 FROM posts_in) x""")
SCORES_CTES = [
    LEX_CTE, WORDS_CTE,
    ("vals", "SELECT w.post_id, CASE WHEN lower(w.tok) = 'so' THEN 0.0 ELSE COALESCE(l.valence, 0.0) END AS v FROM wds w LEFT JOIN lex l ON lower(w.tok) = l.token "
             "WHERE length(w.tok) > 1"),
    ("g", """SELECT post_id, COALESCE(SUM(CASE WHEN v > 0 THEN v + 1 END), 0.0) AS ps,
       COALESCE(SUM(CASE WHEN v < 0 THEN v - 1 END), 0.0) AS ns,
       CAST(COUNT(CASE WHEN v = 0 THEN 1 END) AS DOUBLE) AS nu, COALESCE(SUM(v), 0.0) AS s
FROM vals GROUP BY post_id"""),
    ("sc", """SELECT p.post_id, p.date, p.tweet, p.text, COALESCE(g.ps, 0.0) AS ps, COALESCE(g.ns, 0.0) AS ns,
       COALESCE(g.nu, 0.0) AS nu, COALESCE(g.s, 0.0) AS s, COALESCE(g.ps, 0.0) + abs(COALESCE(g.ns, 0.0))
       + COALESCE(g.nu, 0.0) AS tot
FROM posts_in p LEFT JOIN g ON p.post_id = g.post_id"""),
    ("scores", """SELECT post_id, date, tweet, text,
       CASE WHEN tot > 0 THEN round(abs(ns / tot), 3) ELSE 0.0 END AS neg,
       CASE WHEN tot > 0 THEN round(abs(nu / tot), 3) ELSE 0.0 END AS neu,
       CASE WHEN tot > 0 THEN round(abs(ps / tot), 3) ELSE 0.0 END AS pos,
       CASE WHEN s <> 0 THEN round(s / sqrt(s * s + 15.0), 4) ELSE 0.0 END AS compound
FROM sc"""),
    ("labelled", """SELECT *, CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN 'positive' ELSE 'neutral' END
       AS sentiment FROM scores"""),
]


#: What every seventh text gets behind it, by its id: each multi-word rule stands in some posts.
PHRASES = ["a slow kiss of death here", "it was the bomb today", "they said yeah right again", "and that was kind of good really", "one of the least good days",
           "it is at least good now", "never so good as then", "we never had this good time", "Never did so great", "this is so good", "the very least great one", "a kind of", "it was kind good of them",
           "the kiss of death good", "just enough food great"]
PHRASED_SQL = ("text || CASE WHEN post_id % 7 = 0 THEN ' ' || [" + ", ".join(f"'{x}'" for x in PHRASES) + f"][post_id // 7 % {len(PHRASES)} + 1] ELSE '' END")
POLAR_POSTS = ("posts_in", f"SELECT post_id, date, tweet, {POLAR_SQL} AS text FROM ({ALL_POSTS[1]}) p")
PHRASED_POSTS = ("posts_in", f"SELECT post_id, date, tweet, {PHRASED_SQL} AS text FROM ({ALL_POSTS[1]}) p")


def _with_phrases(posts: DataFrame, phrases: list[str], every: int) -> DataFrame:
    of = F.get(F.array(*map(F.lit, phrases)), F.expr(f"int(post_id div {every} % {len(phrases)})"))
    return posts.withColumn("text", F.concat("text", F.when(F.col("post_id") % every == 0, F.concat(F.lit(" "), of)).otherwise(F.lit(""))))


def all_posts(inp: Inputs) -> DataFrame:
    return inp.view("v_posts").select("post_id", "date", "tweet", "language", clean_text("tweet").alias("text"))


def en_posts(inp: Inputs) -> DataFrame:
    return all_posts(inp).where(F.col("language") == "en")


# ---- cleaning rules, one query each -------------------------------------------------------------

def _rule(name: str, fn, sql_expr: str):
    @register(name, oracle(f"SELECT post_id, {sql_expr} AS text FROM v_posts", ["v_posts"]))
    def q(inp: Inputs) -> DataFrame:
        return inp.view("v_posts").select("post_id", fn("tweet").alias("text"))
    return q


_rule("clean_mentions", remove_mentions, "regexp_replace(tweet, '@[A-Za-z0–9]+', '', 'g')")
_rule("clean_hash", remove_hash, "replace(tweet, '#', '')")
_rule("clean_colon", remove_colon, "replace(tweet, ':', '')")
_rule("clean_rt", remove_rt, "regexp_replace(tweet, 'RT[\\s]+', '', 'g')")
_rule("clean_links", remove_links, "regexp_replace(tweet, 'https?//\\S+', '', 'g')")
_rule("clean_text", clean_text, clean_sql("tweet"))


# ---- lengths, tokens, n-grams -------------------------------------------------------------------

@register("text_len", oracle("SELECT post_id, CAST(length(text) AS BIGINT) AS text_len FROM posts_in",
                             ["v_posts"], [ALL_POSTS]))
def text_len(inp: Inputs) -> DataFrame:
    return all_posts(inp).select("post_id", text_length("text").alias("text_len"))


@register("text_word_count", oracle("SELECT post_id, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) "
                                    "AS text_word_count FROM posts_in", ["v_posts"], [ALL_POSTS]))
def text_word_count(inp: Inputs) -> DataFrame:
    return all_posts(inp).select("post_id", word_count("text").alias("text_word_count"))


@register("tokens", oracle(f"SELECT post_id, array_to_string(t, ' ') AS tokens, CAST(len(t) AS BIGINT) AS n_tokens "
                           f"FROM (SELECT post_id, {TOKENS_SQL.format('text')} AS t FROM posts_in) x",
                           ["v_posts"], [ALL_POSTS]))
def tokens_q(inp: Inputs) -> DataFrame:
    t = all_posts(inp).select("post_id", tokens("text").alias("t"))
    return t.select("post_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("bigint").alias("n_tokens"))


@register("stopwords", oracle("SELECT post_id, array_to_string(f, ' ') AS tokens, CAST(len(f) AS BIGINT) AS n_tokens "
                              "FROM filtered", ["v_posts"], [ALL_POSTS, FILTERED]))
def stopwords_q(inp: Inputs) -> DataFrame:
    t = all_posts(inp).select("post_id", remove_stopwords(tokens("text")).alias("f"))
    return t.select("post_id", F.array_join("f", " ").alias("tokens"), F.size("f").cast("bigint").alias("n_tokens"))


@register("ngrams_of_row", oracle(f"""
SELECT post_id, CAST(unnest(range(1, len(g) + 1)) AS BIGINT) AS pos, unnest(g) AS ngram
FROM (SELECT post_id, {ngrams_sql('f', 2)} AS g FROM filtered) x""", ["v_posts"], [ALL_POSTS, FILTERED]))
def ngrams_of_row(inp: Inputs) -> DataFrame:
    g = with_ngrams(all_posts(inp), "text", 2, "g", keep=["post_id"])
    g = explode_ngrams(g, "g", "ngram", position="pos")
    return g.withColumn("pos", (F.col("pos") + 1).cast("bigint"))


BIGRAM_COUNTS = ("bigram_counts", f"""SELECT words, COUNT(*) AS total
FROM (SELECT unnest({ngrams_sql('f', 2)}) AS words FROM filtered) x GROUP BY words""")
TRIGRAM_COUNTS = ("trigram_counts", f"""SELECT words, COUNT(*) AS total
FROM (SELECT unnest({ngrams_sql('f', 3)}) AS words FROM filtered) x GROUP BY words""")


@register("ngram_counts", oracle("SELECT words, total FROM bigram_counts", ["v_posts"],
                                 [ALL_POSTS, FILTERED, BIGRAM_COUNTS]))
def ngram_counts_q(inp: Inputs) -> DataFrame:
    return ngram_counts(all_posts(inp), "text", 2)


@register("top_bigrams", oracle("SELECT words, total, DATE '2024-01-01' AS date FROM bigram_counts "
                                "ORDER BY total DESC, words LIMIT 20", ["v_posts"],
                                [EN_POSTS, FILTERED, BIGRAM_COUNTS]))
def top_bigrams(inp: Inputs) -> DataFrame:
    return top_ngrams(en_posts(inp), "text", 2, 20, stamp="2024-01-01")


@register("top_trigrams", oracle("SELECT words, total, DATE '2024-01-31' AS date FROM trigram_counts "
                                 "ORDER BY total DESC, words LIMIT 20", ["v_posts"],
                                 [EN_POSTS, FILTERED, TRIGRAM_COUNTS]))
def top_trigrams(inp: Inputs) -> DataFrame:
    return top_ngrams(en_posts(inp), "text", 3, 20, stamp="2024-01-31")


def _heavy(name: str, n: int, counts: tuple[str, str]):
    @register(name, oracle(f"SELECT words, total FROM {counts[0]} ORDER BY total DESC, words LIMIT 20", ["v_posts"], [EN_POSTS, FILTERED, counts]))
    def q(inp: Inputs) -> DataFrame:
        """The same by heavy hitters: candidates from summaries, then only these are counted."""
        return top_ngrams(en_posts(inp), "text", n, 20, heavy=True)
    return q


_heavy("top_bigrams_heavy", 2, BIGRAM_COUNTS)
_heavy("top_trigrams_heavy", 3, TRIGRAM_COUNTS)


@register("top_ngrams_by_day", oracle("""SELECT n, date, words, total FROM (SELECT *, row_number() OVER (PARTITION BY n, date ORDER BY total DESC, words) AS place FROM (
SELECT n, date, words, count(*) AS total FROM (
    SELECT CAST(2 AS BIGINT) AS n, date, unnest(""" + ngrams_sql("f", 2) + """) AS words FROM dated UNION ALL SELECT CAST(3 AS BIGINT) AS n, date, unnest(""" + ngrams_sql("f", 3) + """) AS words FROM dated) x
GROUP BY n, date, words) y) z WHERE place <= 5""", ["v_posts"], [EN_POSTS, ("dated", f"SELECT date, {FILTERED_SQL.format('text')} AS f FROM posts_in")]))
def top_ngrams_by_day(inp: Inputs) -> DataFrame:
    """Both marts of every day from one pass over the texts."""
    by_size = top_ngrams_of(en_posts(inp), "date", "text", (2, 3), 5)
    return by_size[0].withColumn("n", F.lit(2)).unionByName(by_size[1].withColumn("n", F.lit(3)))


# ---- sentiment ----------------------------------------------------------------------------------

@register("sentiment_scores", oracle("SELECT post_id, neg, neu, pos, compound, sentiment FROM labelled",
                                     ["v_posts"], [ALL_POSTS, *SCORES_CTES]))
def sentiment_scores(inp: Inputs) -> DataFrame:
    return score_sentiment(all_posts(inp), "post_id", "text", lexicon_df(inp))


@register("sentiment_label", oracle("SELECT post_id, CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN "
                                    "'positive' ELSE 'neutral' END AS label FROM scores",
                                    ["v_posts"], [ALL_POSTS, *SCORES_CTES]))
def sentiment_label_q(inp: Inputs) -> DataFrame:
    s = score_sentiment(all_posts(inp), "post_id", "text", lexicon_df(inp))
    return s.select("post_id", sentiment_label("neg", "pos").alias("label"))


@register("polarity", oracle("""
SELECT p.post_id, round(CASE WHEN c > 0 THEN sp / c ELSE 0.0 END, 4) AS polarity, round(CASE WHEN c > 0 THEN ss / c ELSE 0.0 END, 4) AS subjectivity
FROM posts_in p LEFT JOIN psum a ON p.post_id = a.post_id""",
                             ["v_posts"], [POLAR_POSTS, *POLARITY_CTES]))
def polarity(inp: Inputs) -> DataFrame:
    """Averages over words with modifiers, negations and exclamations."""
    return score_polarity(_with_phrases(all_posts(inp), POLAR_PHRASES, 5), "post_id", "text", polarity_df(inp), intensity_col="intensity", modifier_col="modifier")


# ---- sentiment with the positional rules ----------------------------------------------------------

def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _in_list(col: str, words) -> str:
    return f"{col} IN (" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _upper(col: str) -> str:
    return f"({col} = upper({col}) AND {col} <> lower({col}))"


class S:
    """The published constants and word lists, written out here so that the oracle shares none with the operator."""

    C_INCR, B_INCR, B_DECR, N_SCALAR = 0.733, 0.293, -0.293, -0.74
    BOOSTER_DISTANCE_SCALE = (1.0, 0.95, 0.9)
    BUT_BEFORE, BUT_AFTER = 0.5, 1.5
    IDIOMS = {"the shit": 3, "the bomb": 3, "bad ass": 1.5, "yeah right": -2, "cut the mustard": 2, "kiss of death": -1.5, "hand to mouth": -2}
    EXCLAMATION_MAX, EXCLAMATION_STEP, QUESTION_CAP, QUESTION_STEP = 4, 0.292, 0.96, 0.18
    NEGATIONS = ("aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt havent isnt "
                 "mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor not nothing nowhere "
                 "oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely "
                 "seldom despite").split()
    BOOST_UP = ("absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously entirely especially "
                "exceptional exceptionally extreme extremely fabulously flipping flippin frackin fracking fricking frickin frigging friggin fully "
                "fuckin fucking fuggin fugging greatly hella highly hugely incredible incredibly intensely major majorly more most particularly "
                "purely quite really remarkably so substantially thoroughly total totally tremendous tremendously uber unbelievably unusually utter "
                "utterly very").split()
    BOOST_DOWN = ("almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly scarce scarcely slight "
                  "slightly somewhat sorta sortof sort-of").split()


def _rules_ctes() -> list[tuple[str, str]]:
    strip = STRIP.replace("w0", "x")
    lags = ", ".join(f"lag(w, {k}) OVER win AS p{k}" for k in (1, 2, 3)) + ", lead(w, 1) OVER win AS f1, lead(w, 2) OVER win AS f2"
    ctes = [
        ("rw", f"""SELECT post_id,
       list_transform(list_filter(regexp_extract_all(text, '\\S+'), lambda t: length(t) > 1), lambda x: {strip}) AS ws,
       length(text) - length(replace(text, '!', '')) AS excl, length(text) - length(replace(text, '?', '')) AS qm
FROM posts_in"""),
        ("rp", f"""SELECT post_id, excl, qm, ws, len(list_filter(ws, lambda w: {_upper('w')})) AS n_up, len(ws) AS n_w,
       COALESCE(list_position(list_transform(ws, lambda w: lower(w)), 'but'), 0) AS bp FROM rw"""),
        ("ru", "SELECT post_id, excl, qm, (n_up > 0 AND n_up < n_w) AS cd, bp, unnest(ws) AS w, "
               "unnest(range(1, n_w + 1)) AS pos FROM rp"),
        ("rl", f"SELECT *, {lags} FROM ru WINDOW win AS (PARTITION BY post_id ORDER BY pos)"),
        ("r0", f"""SELECT r.*, l1.token IS NULL AS out1, l2.token IS NULL AS out2, l3.token IS NULL AS out3,
       CASE WHEN {_in_list('lower(r.w)', [*S.BOOST_UP, *S.BOOST_DOWN])} OR lower(r.w) = 'kind' AND lower(COALESCE(r.f1, '')) = 'of' THEN NULL
            WHEN {_upper('r.w')} AND r.cd THEN (CASE WHEN l.valence > 0 THEN l.valence + {_dbl(S.C_INCR)}
            ELSE l.valence - {_dbl(S.C_INCR)} END) ELSE l.valence END AS v
FROM rl r LEFT JOIN lex l ON lower(r.w) = l.token LEFT JOIN lex l1 ON lower(r.p1) = l1.token
LEFT JOIN lex l2 ON lower(r.p2) = l2.token LEFT JOIN lex l3 ON lower(r.p3) = l3.token"""),
    ]
    prev = "r0"
    for k, scale in zip((1, 2, 3), S.BOOSTER_DISTANCE_SCALE):
        p = f"p{k}"
        applies = f"({p} IS NOT NULL AND out{k} AND v IS NOT NULL)"
        raw = (f"(CASE WHEN {_in_list(f'lower({p})', S.BOOST_UP)} THEN {_dbl(S.B_INCR)} "
               f"WHEN {_in_list(f'lower({p})', S.BOOST_DOWN)} THEN {_dbl(S.B_DECR)} ELSE {_dbl(0.0)} END)")
        signed = f"(CASE WHEN v < 0 THEN -{raw} ELSE {raw} END)"
        capped = (f"(CASE WHEN {signed} <> 0 AND {_upper(p)} AND cd THEN (CASE WHEN v > 0 THEN {signed} + "
                  f"{_dbl(S.C_INCR)} ELSE {signed} - {_dbl(S.C_INCR)} END) ELSE {signed} END)")
        ctes.append((f"rb{k}", f"SELECT * REPLACE (CASE WHEN {applies} THEN v + {capped} * {_dbl(scale)} "
                               f"ELSE v END AS v) FROM {prev}"))
        never = {1: "false", 2: "p2 = 'never' AND p1 IN ('so', 'this')", 3: "p3 = 'never' AND p2 IN ('so', 'this') OR p1 IN ('so', 'this')"}[k]
        negated = f"({_in_list(f'lower({p})', S.NEGATIONS)} OR contains(lower({p}), 'n''t'))"
        ctes.append((f"rn{k}", f"SELECT * REPLACE (CASE WHEN {applies} AND ({never}) THEN v * {_dbl({1: 1.0, 2: 1.5, 3: 1.25}[k])} "
                               f"WHEN {applies} AND {negated} THEN v * {_dbl(S.N_SCALAR)} ELSE v END AS v) FROM rb{k}"))
        prev = f"rn{k}"

    def phrase(*words: str) -> str:
        return "CASE " + " || ' ' || ".join(words) + " " + " ".join(f"WHEN '{k}' THEN {_dbl(v)}" for k, v in S.IDIOMS.items()) + " END"

    found = ", ".join(phrase(*x) for x in (("w", "f1", "f2"), ("w", "f1"), ("p1", "w"), ("p2", "p1", "w"), ("p2", "p1"), ("p3", "p2", "p1"), ("p3", "p2")))
    damp = " OR ".join(f"COALESCE({a} || ' ' || {b} IN ('kind of', 'sort of', 'just enough'), false)" for a, b in (("p3", "p2"), ("p2", "p1")))
    ctes += [
        ("ri", f"""SELECT * REPLACE (CASE WHEN p3 IS NOT NULL AND out3 AND v IS NOT NULL THEN COALESCE({found}, v)
       + CASE WHEN {damp} THEN {_dbl(S.B_DECR)} ELSE 0.0 END ELSE v END AS v) FROM {prev}"""),
        ("rt", f"""SELECT * REPLACE (CASE WHEN lower(p1) = 'least' AND out1 AND NOT COALESCE(lower(p2) IN ('at', 'very'), false)
       THEN v * {_dbl(S.N_SCALAR)} ELSE v END AS v) FROM ri"""),
    ]
    prev = "rt"
    ctes += [
        ("rbut", f"""SELECT * REPLACE (CASE WHEN bp > 0 AND pos < bp THEN v * {_dbl(S.BUT_BEFORE)}
       WHEN bp > 0 AND pos > bp THEN v * {_dbl(S.BUT_AFTER)} ELSE v END AS v) FROM {prev}"""),
        ("rg", """SELECT post_id, COALESCE(SUM(CASE WHEN val > 0 THEN val + 1 END), 0.0) AS ps,
       COALESCE(SUM(CASE WHEN val < 0 THEN val - 1 END), 0.0) AS ns,
       CAST(COUNT(CASE WHEN val = 0 THEN 1 END) AS DOUBLE) AS nu, COALESCE(SUM(val), 0.0) AS s,
       MAX(excl) AS excl, MAX(qm) AS qm
FROM (SELECT *, COALESCE(v, 0.0) AS val FROM rbut) z GROUP BY post_id"""),
        ("ra", f"""SELECT *, least(excl, {S.EXCLAMATION_MAX}) * {_dbl(S.EXCLAMATION_STEP)}
       + CASE WHEN qm > 3 THEN {_dbl(S.QUESTION_CAP)} WHEN qm > 1 THEN qm * {_dbl(S.QUESTION_STEP)}
              ELSE {_dbl(0.0)} END AS amp FROM rg"""),
        ("rs", """SELECT p.post_id,
       COALESCE(CASE WHEN a.s > 0 THEN a.s + a.amp WHEN a.s < 0 THEN a.s - a.amp ELSE a.s END, 0.0) AS s,
       COALESCE(CASE WHEN a.ps > abs(a.ns) THEN a.ps + a.amp ELSE a.ps END, 0.0) AS ps,
       COALESCE(CASE WHEN a.ps < abs(a.ns) THEN a.ns - a.amp ELSE a.ns END, 0.0) AS ns,
       COALESCE(a.nu, 0.0) AS nu
FROM posts_in p LEFT JOIN ra a ON p.post_id = a.post_id"""),
        ("rscores", """SELECT post_id,
       CASE WHEN ps + abs(ns) + nu > 0 THEN round(abs(ns / (ps + abs(ns) + nu)), 3) ELSE 0.0 END AS neg,
       CASE WHEN ps + abs(ns) + nu > 0 THEN round(abs(nu / (ps + abs(ns) + nu)), 3) ELSE 0.0 END AS neu,
       CASE WHEN ps + abs(ns) + nu > 0 THEN round(abs(ps / (ps + abs(ns) + nu)), 3) ELSE 0.0 END AS pos,
       CASE WHEN s <> 0 THEN round(s / sqrt(s * s + 15.0), 4) ELSE 0.0 END AS compound
FROM rs"""),
        ("rlabelled", "SELECT *, CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN 'positive' "
                      "ELSE 'neutral' END AS sentiment FROM rscores"),
    ]
    return ctes


RULES_CTES = [LEX_CTE, *_rules_ctes()]


@register("sentiment_rules", oracle("SELECT post_id, neg, neu, pos, compound, sentiment FROM rlabelled",
                                    ["v_posts"], [PHRASED_POSTS, *RULES_CTES]))
def sentiment_rules(inp: Inputs) -> DataFrame:
    return score_sentiment_rules(_with_phrases(all_posts(inp), PHRASES, 7), "post_id", "text", lexicon_df(inp))
