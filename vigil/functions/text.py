"""Text Column functions: post cleaning, lengths, tokens, stop words, n-grams.

All are built-in expressions (regexp, higher-order array functions), so they stay inside
whole-stage codegen and need no Python worker. Patterns use Java regex; ``(?U)`` makes ``\\w``,
``\\s`` and ``\\b`` Unicode-aware, which matches Python's ``re`` on str patterns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.stopwords import ENGLISH_STOPWORDS

# Fixed values (must equal the reference's cleaning rules).
# The mention class is written with an en dash between 0 and 9, so it holds the letters, '0',
# the dash itself and '9' only: digits 1-8 and '_' survive ("@user_1" -> "_1").
MENTION_PATTERN_LEGACY = "@[A-Za-z0–9]+"
MENTION_PATTERN_WORD = r"(?U)@\w+"
RT_PATTERN = r"(?U)RT[\s]+"          # not anchored: "START now" -> "STAnow"
LINK_PATTERN = r"(?U)https?//\S+"    # ':' is removed before, so only this form can still match

TOKEN_PATTERN = r"(?U)\b\w\w+\b"     # lower-cased tokens of two or more word characters
WORD_PATTERN = r"(?U)\S+"            # white-space separated words


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_mentions(c: Column | str, pattern: str = MENTION_PATTERN_LEGACY) -> Column:
    return F.regexp_replace(_c(c), pattern, "")


def remove_hash(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit("#"), F.lit(""))


def remove_colon(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit(":"), F.lit(""))


def remove_rt(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), RT_PATTERN, "")


def remove_links(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), LINK_PATTERN, "")


def clean_text(c: Column | str, mention_pattern: str = MENTION_PATTERN_LEGACY) -> Column:
    """mentions -> '#' -> ':' -> 'RT ' -> links, in that order, as one nested expression."""
    return remove_links(remove_rt(remove_colon(remove_hash(remove_mentions(c, mention_pattern)))))


def text_length(c: Column | str) -> Column:
    """Length in code points."""
    return F.length(_c(c)).cast("bigint")


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(WORD_PATTERN), F.lit(0))


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words (Python ``len(s.split())``)."""
    return F.size(words(c)).cast("bigint")


def tokens(c: Column | str) -> Column:
    """Lower-case, then every maximal run of two or more word characters."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_PATTERN), F.lit(0))


def remove_stopwords(toks: Column, stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> Column:
    """Drop stop words, keep order and duplicates. ``isin`` over literals becomes a hash set."""
    stop = sorted(set(stopwords))
    if not stop:
        return toks
    return F.filter(toks, lambda t: ~t.isin(*stop))


def ngrams(toks: Column, n: int, sep: str = " ") -> Column:
    """Contiguous n-grams of a token array (pass a column reference); empty when shorter than n.

    Built from n shifted copies of the array joined element-wise with ``zip_with``: linear in the
    number of tokens. (Taking ``slice(toks, i, n)`` for every position copies the whole array
    each time, which is quadratic on long texts.)
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return toks
    size = F.size(toks)
    acc = toks
    for j in range(1, n):
        shifted = F.slice(toks, j + 1, F.greatest(size, F.lit(1)))
        acc = F.zip_with(acc, shifted, lambda a, b: F.concat_ws(sep, a, b))
    grams = F.slice(acc, 1, size - F.lit(n - 1))
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))


def ngrams_of_words(toks: Column, n: int) -> Column:
    """Contiguous n-grams of an array of white-space-free tokens (as ``tokens`` produces).

    The tokens are joined by single spaces and one regex pass takes, at every token start, the n
    tokens ahead of it (a look-ahead capture, so matches overlap). It is a single built-in
    expression, faster than the element-wise lambdas of ``ngrams``; do not use it for tokens that
    may contain white space.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return toks
    pattern = "(?=(" + " ".join([r"\S+"] * n) + r"))\S+"
    return F.regexp_extract_all(F.array_join(toks, " "), F.lit(pattern), F.lit(1))


def sentiment_label(neg: Column | str, pos: Column | str) -> Column:
    """negative if neg > pos, positive if pos > neg, neutral otherwise (also when null)."""
    neg, pos = _c(neg), _c(pos)
    return (F.when(neg > pos, F.lit("negative"))
            .when(pos > neg, F.lit("positive"))
            .otherwise(F.lit("neutral")))
