"""Lexicon sentiment of short texts (F-3, F-4, X-16), scored within the row.

Base form of the published rule-based valence scorer: words are white-space split, one-character words
are dropped, one listed punctuation mark (or run of '!' and '?') is stripped from the front or the end of
a word that has no other punctuation and two characters left, and each word's valence is looked up
lower-cased (0 when absent; a token listed twice counts once, with its largest values). Then

    pos = sum(v + 1 | v > 0), neg = sum(v - 1 | v < 0), neu = count(v == 0)
    shares = |x| / (pos + |neg| + neu), rounded to 3 places
    compound = s / sqrt(s^2 + 15) with s = sum(v), rounded to 4 places

and a text without words scores 0 everywhere. ``score_sentiment_rules`` adds the scorer's rules on neighbouring words,
``score_polarity`` is the averaging scorer with modifiers and negations.

A text's words stay an array in its row: each is looked up in the lexicon, a one-row value (an array of small maps, by the
hash of the token) whose bytes are measured before it travels with the tasks, and only the few words found go through
the rules. So there is no explode, no shuffle, no row number, and each input row gives one row, whatever its id
(ids may repeat or be null). A lexicon above the bound is first reduced to the words that the texts hold.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import sentiment_label, words
from vigil.operators.joins import BROADCAST_BYTES, row_bytes
from vigil.session import materialize

ALPHA = 15.0  # fixed value: normalisation constant of the compound score
# Punctuation that is stripped from one end of a word.
PUNCT = r"(?:\?!\?!|!\?!\?|\?!\?|!\?!|!!!|\?\?\?|!!|\?\?|[.!?,;:\-'\"])"
_BARE = r"([^!-/:-@\[-`{-~\s]{2,})"  # two characters or more, none of them ASCII punctuation
PUNCT_EDGE = rf"(?U)(?<!\S)(?:{PUNCT}{_BARE}|{_BARE}{PUNCT})(?!\S)"

# Constants and single-word lists of the published rule-based valence scorer.
B_INCR = 0.293
B_DECR = -0.293
C_INCR = 0.733
N_SCALAR = -0.74
BOOSTER_DISTANCE_SCALE = (1.0, 0.95, 0.9)
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_CAP = 0.18, 0.96
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't",
    "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't",
    "never", "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh",
    "wasnt", "werent", "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't", "without", "wont",
    "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite",
)
BOOST_UP = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "effing", "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking", "fricking", "frickin", "frigging",
    "friggin", "fully", "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally", "tremendous",
    "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
BOOST_DOWN = (
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginal", "marginally",
    "occasional", "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta",
    "sortof", "sort-of",
)
# Phrases with a valence of their own, and phrases that dampen what follows.
IDIOMS = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0, "kiss of death": -1.5, "hand to mouth": -2.0}
DAMPENING_PHRASES = ("kind of", "sort of", "just enough")
NEVER_NEAR, NEVER_FAR = 1.5, 1.25  # 'never so' or 'never this' two and three words before
# Negations of the averaging scorer, and how it scales a negated word and one before '!'.
POLARITY_NEGATIONS = ("no", "not", "n't", "never")
NEGATED, EXCLAIMED = -0.5, 1.25
_POLARITY_TOKEN = r"n't|[\p{L}\p{N}_]+(?:['\-][\p{L}\p{N}_]+)*|!"
#: Maps of a lexicon: a look-up reads one map, of a few tokens.
BUCKETS = 4096


def scorer_words(text: Column | str) -> Column:
    """Words of a text as the scorer sees them (see module doc); null text: none."""
    text = F.col(text) if isinstance(text, str) else text
    bare = words(F.regexp_replace(text, PUNCT_EDGE, "$1$2"))  # one pass over the text, not one a word
    return F.coalesce(F.filter(bare, lambda w: F.length(w) > 1), F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a column used within a lambda may be computed for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def packed_lexicon(lexicon: DataFrame, token_col: str, values: Mapping[str, Column], max_bytes: int, seen: Callable[[], DataFrame]) -> DataFrame:
    """One row, ``lex``: an array of BUCKETS maps from token to the named values (the largest, where a token is listed twice).

    ``seen`` gives the lower-cased words of the texts (column ``w``), to which a lexicon of more than ``max_bytes`` is reduced;
    one that is still larger is an error.
    """
    rows = lexicon.where(F.col(token_col).isNotNull()).groupBy(F.col(token_col).cast("string").alias("t")).agg(*[F.max(c).alias(n) for n, c in values.items()])

    def size(df: DataFrame) -> int:
        return df.agg(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0

    rows = materialize(rows)
    if size(rows) > max_bytes:
        rows = materialize(rows.join(seen().distinct(), F.col("t") == F.col("w"), "left_semi"))
        if size(rows) > max_bytes:
            raise ValueError(f"the texts' words have more than {max_bytes} bytes of lexicon")
    maps = rows.groupBy(_bucket(F.col("t")).alias("b")).agg(F.map_from_entries(F.collect_list(F.struct("t", F.struct(*values)))).alias("m"))
    every = lexicon.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(maps, "b", "left")
    return materialize(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "m")), lambda x, y: x["b"] - y["b"]), lambda x: x["m"]).alias("lex")))


def _with_lexicon(df: DataFrame, lexicon: DataFrame, token_col: str, values: Mapping[str, Column], max_bytes: int, text: str, toks: Callable[[Column], Column]) -> DataFrame:
    lex = packed_lexicon(lexicon, token_col, values, max_bytes, lambda: df.select(F.explode(toks(F.col(text))).alias("w")).select(F.lower("w").alias("w")))
    return df.withColumn("__lex", lex.scalar())


def _found(token: Column) -> Column:
    """The lexicon's values of a lower-cased token, or null."""
    return F.get(F.col("__lex"), _bucket(token))[token]


def _valence(lexicon: str) -> dict[str, Column]:
    return {"v": F.col(lexicon).cast("double")}


def _summed(vals: Column, n: Column) -> Column:
    """The sums of a text's non-zero valences, and how many of its ``n`` words have none."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("pos"), zero.alias("neg"), zero.alias("s"))
    return F.aggregate(vals, start, lambda a, v: F.struct(
        (a["pos"] + F.when(v > 0, v + 1).otherwise(zero)).alias("pos"), (a["neg"] + F.when(v < 0, v - 1).otherwise(zero)).alias("neg"), (a["s"] + v).alias("s")),
        lambda a: F.struct(a["pos"].alias("pos"), a["neg"].alias("neg"), a["s"].alias("s"), (n - F.size(F.filter(vals, lambda v: v != 0))).cast("double").alias("neu")))


def _shares(g: DataFrame, id_col: str, keep: Sequence[str]) -> DataFrame:
    """The result columns from a text's sums in ``__r``."""
    r = F.col("__r")
    total = r["pos"] + F.abs(r["neg"]) + r["neu"]

    def share(c: str) -> Column:
        return F.when(total > 0, F.round(F.abs(r[c] / total), 3)).otherwise(F.lit(0.0))

    s = r["s"]
    compound = F.when(s != 0, F.round(s / F.sqrt(s * s + F.lit(ALPHA)), 4)).otherwise(F.lit(0.0))
    out = g.select(id_col, *keep, share("neg").alias("neg"), share("neu").alias("neu"), share("pos").alias("pos"), compound.alias("compound"))
    return out.withColumn("sentiment", sentiment_label("neg", "pos"))


def _is_upper(w: Column) -> Column:
    """All cased characters upper-case, and at least one cased character."""
    return (w == F.upper(w)) & (w != F.lower(w))


def _count_char(text: Column, ch: str) -> Column:
    return F.coalesce(F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit(""))), F.lit(0))


def _scored(df: DataFrame, id_col: str, text: str, lexicon: DataFrame, keep: Sequence[str], token_col: str, valence_col: str, max_bytes: int,
            score: Callable[[Column, Column, Column], Column], sums: Callable[[Column], Column]) -> DataFrame:
    """``score(words, lower-cased words, hits)`` gives the valences of the hits: the places and valences of words found in the lexicon."""
    keep = [c for c in keep if c != id_col]

    def of_words(w: Column) -> Column:
        def of_lower(low: Column) -> Column:
            places = F.filter(F.transform(low, lambda x, i: F.struct(i.alias("i"), _found(x)["v"].alias("v"))),
                              lambda h: h["v"].isNotNull() & ~_scores_nothing(low, h["i"]))
            return let(score(w, low, places), lambda vals: _summed(vals, F.size(w)))
        return let(F.transform(w, F.lower), of_lower)

    rows = _with_lexicon(df.select(F.col(id_col), F.col(text).alias("__text"), *[c for c in keep if c != text], *([F.col(text)] if text in keep and text != id_col else [])),
                         lexicon, token_col, _valence(valence_col), max_bytes, "__text", scorer_words)
    return _shares(rows.withColumn("__r", let(let(scorer_words("__text"), of_words), sums)), id_col, keep)


def _scores_nothing(low: Column, i: Column) -> Column:
    """Boosters, and 'kind' before 'of', score 0 themselves."""
    w = F.get(low, i)
    return w.isin(*BOOST_UP, *BOOST_DOWN) | (w == "kind") & F.coalesce(F.get(low, i + 1) == "of", F.lit(False))


def score_sentiment(df: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                    keep: Sequence[str] = (), token_col: str = "token", valence_col: str = "valence",
                    max_lexicon_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """id, kept columns, neg, neu, pos, compound, sentiment (label) for every row of ``df``."""
    return _scored(df, id_col, text, lexicon, keep, token_col, valence_col, max_lexicon_bytes, lambda w, low, hits: F.transform(hits, lambda h: h["v"]), lambda r: r)


def _phrase(*parts: Column) -> Column:
    """Words joined by blanks; null where one is missing."""
    return F.concat(*[x for p in parts for x in (F.lit(" "), p)][1:])


def _negates(low: Column) -> Column:
    return low.isin(*NEGATIONS) | low.contains("n't")


def _modified(w: Column, low: Column, hit: Column, caps_differ: Column, phrases: Column | None) -> Column:
    """The valence of a hit after its neighbours."""
    i = hit["i"]

    def at(k: int) -> Column:
        return F.when(i >= k, F.get(w, i - k)) if k > 0 else F.get(w, i - k)

    def emphasised(v: Column) -> Column:
        return F.when(_is_upper(at(0)) & caps_differ, F.when(v > 0, v + C_INCR).otherwise(v - C_INCR)).otherwise(v)

    def boosted(v: Column, p: Column, scale: float) -> Column:
        q = F.lower(p)
        raw = F.when(q.isin(*BOOST_UP), F.lit(B_INCR)).when(q.isin(*BOOST_DOWN), F.lit(B_DECR)).otherwise(F.lit(0.0))
        signed = F.when(v < 0, -raw).otherwise(raw)
        in_caps = (raw != 0) & _is_upper(p) & caps_differ
        return v + F.when(in_caps, F.when(v > 0, signed + C_INCR).otherwise(signed - C_INCR)).otherwise(signed) * F.lit(scale)

    def negated(v: Column, k: int) -> Column:
        flip = F.when(_negates(F.lower(at(k))), v * F.lit(N_SCALAR)).otherwise(v)
        so = lambda p: F.coalesce(p.isin("so", "this"), F.lit(False))
        if k == 2:
            return F.when((at(2) == "never") & so(at(1)), v * F.lit(NEVER_NEAR)).otherwise(flip)
        if k == 3:
            return F.when((at(3) == "never") & so(at(2)) | so(at(1)), v * F.lit(NEVER_FAR)).otherwise(flip)
        return flip

    def idiom(v: Column) -> Column:
        if phrases is None:
            return v
        before = F.coalesce(*[phrases[_phrase(*map(at, ks))] for ks in ((1, 0), (2, 1, 0), (2, 1), (3, 2, 1), (3, 2))], v)
        found = F.coalesce(phrases[_phrase(at(0), at(-1), at(-2))], phrases[_phrase(at(0), at(-1))], before)
        damp = _phrase(at(3), at(2)).isin(*DAMPENING_PHRASES) | _phrase(at(2), at(1)).isin(*DAMPENING_PHRASES)
        return F.when(damp, found + B_DECR).otherwise(found)

    def least(v: Column) -> Column:
        one = F.lower(at(1))
        counts = (one == "least") & _found(one).isNull() & ~F.coalesce(F.lower(at(2)).isin("at", "very"), F.lit(False))
        return F.when(counts, v * F.lit(N_SCALAR)).otherwise(v)

    def step(v: Column, k: int) -> Column:
        if k > 3:
            return least(v)
        applies = (i >= k) & _found(F.lower(at(k))).isNull()
        after = let(boosted(v, at(k), BOOSTER_DISTANCE_SCALE[k - 1]), lambda b: negated(b, k) if k < 3 else let(negated(b, 3), idiom))
        return let(F.when(applies, after).otherwise(v), lambda x: step(x, k + 1))

    return let(emphasised(hit["v"]), lambda v: step(v, 1))


def score_sentiment_rules(df: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                          keep: Sequence[str] = (), token_col: str = "token", valence_col: str = "valence",
                          max_lexicon_bytes: int = BROADCAST_BYTES, idioms: Mapping[str, float] | None = None) -> DataFrame:
    """The scorer with its rules, applied to every word found in the lexicon:

    * a booster word, and 'kind' before 'of', scores 0 itself, also where the lexicon has it;
    * capitals: an all-caps word in a text that is not all caps moves by C_INCR away from 0;
    * for each of the three preceding words that is not itself in the lexicon: a booster adds
      +-B_INCR (sign of the valence, x0.95 / x0.9 at distance 2 / 3, +-C_INCR when in capitals),
      then a negation word (or one containing "n't") multiplies the valence by N_SCALAR; in its place 'never so' and
      'never this' two words before multiply by NEVER_NEAR, three words before (or 'so' or 'this' right before) by NEVER_FAR;
    * after the third: a phrase of ``idioms`` (default: the published ones) that ends at the word or before it sets the valence (the first of: two words
      up to it, three up to it, two before it, three before it, two with a word between), then one that begins at it, the
      longest first; a dampening phrase ('kind of') before it takes B_INCR off;
    * 'least' right before, but for 'at least' and 'very least', multiplies by N_SCALAR;
    * 'but': valences before the first 'but' x0.5, after it x1.5;
    * '!' (up to 4) and '?' (more than one) amplify the sum and the dominant share.

    Phrases, 'never', 'so' and 'this' are compared as written, all else lower-cased.
    """
    idioms = IDIOMS if idioms is None else idioms
    phrases = F.create_map(*[x for k, v in idioms.items() for x in (F.lit(k), F.lit(float(v)))]) if idioms else None

    def score(w: Column, low: Column, hits: Column) -> Column:
        n_upper = F.size(F.filter(w, _is_upper))

        def with_text(t: Column) -> Column:
            def one(h: Column) -> Column:
                but = t["but"] - 1
                return let(_modified(w, low, h, t["caps"], phrases), lambda v: F.when(but < 0, v).when(h["i"] < but, v * F.lit(BUT_BEFORE)).when(h["i"] > but, v * F.lit(BUT_AFTER)).otherwise(v))
            return F.transform(hits, one)

        return let(F.struct(((n_upper > 0) & (n_upper < F.size(w))).alias("caps"), F.array_position(low, "but").alias("but")), with_text)

    def amplified(r: Column) -> Column:
        t = F.col("__text")
        excl, qm = F.least(_count_char(t, "!"), F.lit(EXCLAMATION_MAX)), _count_char(t, "?")
        amp = excl * F.lit(EXCLAMATION_STEP) + F.when(qm > 3, F.lit(QUESTION_CAP)).when(qm > 1, qm * F.lit(QUESTION_STEP)).otherwise(F.lit(0.0))
        s, p, n = r["s"], r["pos"], r["neg"]
        return F.struct(F.when(s > 0, s + amp).when(s < 0, s - amp).otherwise(s).alias("s"), F.when(p > F.abs(n), p + amp).otherwise(p).alias("pos"),
                        F.when(p < F.abs(n), n - amp).otherwise(n).alias("neg"), r["neu"].alias("neu"))

    return _scored(df, id_col, text, lexicon, keep, token_col, valence_col, max_lexicon_bytes, score, amplified)


def polarity_tokens(text: Column) -> Column:
    """Lower-cased words and '!'; "n't" is a word of its own. Null text: none."""
    apart = F.replace(F.lower(text), F.lit("n't"), F.lit(" n't"))
    return F.coalesce(F.regexp_extract_all(apart, F.lit(_POLARITY_TOKEN), F.lit(0)), F.array().cast("array<string>"))


def _assessed(codes: Column) -> Column:
    """(polarity sum, subjectivity sum, assessments) of a text's tokens, by the state machine of ``score_polarity``."""
    zero, no = F.lit(0.0), F.lit(False)
    start = F.struct(*[zero.alias(c) for c in ("sp", "ss", "c", "p", "s", "i")], *[no.alias(c) for c in ("neg", "has", "m", "n")])

    def clip(x: Column) -> Column:
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))

    def closed(a: Column) -> dict[str, Column]:
        """The sums with the open assessment."""
        return {"sp": a["sp"] + F.when(a["has"], a["p"] * F.when(a["neg"], F.lit(NEGATED)).otherwise(F.lit(1.0))).otherwise(zero),
                "ss": a["ss"] + F.when(a["has"], a["s"]).otherwise(zero), "c": a["c"] + F.when(a["has"], 1.0).otherwise(zero)}

    def struct(**fields: Column) -> Column:
        return F.struct(*[fields[c].alias(c) for c in ("sp", "ss", "c", "p", "s", "i", "neg", "has", "m", "n")])

    def known(a: Column, x: Column) -> Column:
        v, joins = x["v"], a["m"]
        sums = closed(a)
        i = v["i"]
        return struct(**{k: F.when(joins, a[k]).otherwise(c) for k, c in sums.items()},
                      p=F.when(joins, clip(v["p"] * a["i"])).otherwise(v["p"]), s=F.when(joins, clip(v["s"] * a["i"])).otherwise(v["s"]),
                      i=F.when(a["n"] & (i != 0), 1 / i).otherwise(i), neg=a["n"] | joins & a["neg"], has=F.lit(True), m=v["m"], n=x["neg"])

    def unknown(a: Column, x: Column) -> Column:
        n = x["neg"] | a["n"] & (x["size"] <= 1)
        both = n & a["m"]
        return struct(sp=a["sp"], ss=a["ss"], c=a["c"], p=F.when(x["excl"], clip(a["p"] * F.lit(EXCLAIMED))).otherwise(a["p"]), s=a["s"], i=a["i"],
                      neg=a["neg"] | both, has=a["has"], m=a["m"] & (both | (x["size"] <= 2)), n=n & ~both)

    return F.aggregate(codes, start, lambda a, x: F.when(x["v"].isNotNull(), known(a, x)).otherwise(unknown(a, x)), lambda a: F.struct(*[c.alias(k) for k, c in closed(a).items()]))


def score_polarity(df: DataFrame, id_col: str, text: str, lexicon: DataFrame, token_col: str = "token",
                   polarity_col: str = "polarity", subjectivity_col: str = "subjectivity",
                   max_lexicon_bytes: int = BROADCAST_BYTES, intensity_col: str | None = None, modifier_col: str | None = None) -> DataFrame:
    """id, polarity, subjectivity for every row: averages over a text's assessments (0 when none), rounded to 4 places.

    A word found in the lexicon is an assessment (polarity, subjectivity, intensity). After a modifier (a lexicon word whose
    ``modifier_col`` is true, such as an adverb) it takes the modifier's place, polarity and subjectivity times the modifier's
    intensity, within -1 and 1. A negation before it ('no', 'not', 'never', "n't") multiplies the polarity by -0.5 and turns the intensity into its
    reciprocal. A negation holds across words of one letter, a modifier across words of two; a negation after a modifier ('really
    not good') goes to the modifier's assessment, and the modifier holds on. '!' multiplies the last polarity by 1.25. Without
    ``intensity_col`` all intensities are 1, without ``modifier_col`` no word is a modifier.
    """
    one = F.col(intensity_col).cast("double") if intensity_col else F.lit(1.0)
    values = {"p": F.col(polarity_col).cast("double"), "s": F.col(subjectivity_col).cast("double"), "i": F.coalesce(one, F.lit(1.0)),
              "m": F.coalesce(F.col(modifier_col), F.lit(False)) if modifier_col else F.lit(False)}
    rows = _with_lexicon(df.select(F.col(id_col), F.col(text).alias("__text")), lexicon, token_col, values, max_lexicon_bytes, "__text", polarity_tokens)

    def code(t: Column) -> Column:
        return F.struct(_found(t).alias("v"), t.isin(*POLARITY_NEGATIONS).alias("neg"), (t == "!").alias("excl"), F.length(F.trim(t, F.lit("'"))).alias("size"))

    def of_codes(codes: Column) -> Column:
        def plain(x: Column) -> Column:  # ends both a negation's and a modifier's reach, as often as it comes
            return x["v"].isNull() & ~x["neg"] & (x["size"] > 2)
        return _assessed(F.filter(codes, lambda x, i: ~(plain(x) & F.coalesce((i > 0) & plain(F.get(codes, i - 1)), F.lit(False)))))

    r = rows.withColumn("__r", let(F.transform(polarity_tokens(F.col("__text")), code), of_codes))

    def mean(c: str) -> Column:
        return F.round(F.when(F.col("__r")["c"] > 0, F.col("__r")[c] / F.col("__r")["c"]).otherwise(F.lit(0.0)), 4)

    return r.select(id_col, mean("sp").alias("polarity"), mean("ss").alias("subjectivity"))
