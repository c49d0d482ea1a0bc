"""N-gram frequencies of a corpus (G-9, F-2, O-3).

Tokens, stop-word removal and n-gram building are per-row array expressions; the counts are an
``explode`` + ``groupBy`` whose partial aggregation pre-reduces frequent n-grams in every task, so a
hot n-gram costs one row per task in the shuffle. The top-k is TakeOrderedAndProject.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.stopwords import ENGLISH_STOPWORDS
from vigil.functions.text import ngrams_of_words, remove_stopwords, tokens
from vigil.operators.heavy import top_values
from vigil.session import materialize


def content_tokens(text: Column | str, stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> Column:
    """Lower-case tokens with stop words removed (before n-grams are formed)."""
    text = F.col(text) if isinstance(text, str) else text
    return remove_stopwords(tokens(text), stopwords)


def with_ngrams(df: DataFrame, text: str, n: int, out: str = "ngrams", keep: Sequence[str] = (),
                stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> DataFrame:
    """``keep`` columns plus the n-gram array of ``text``.

    The token array is projected first and the n-grams are built over that column, so the token
    regex runs once per text.
    """
    toks = df.select(*keep, content_tokens(text, stopwords).alias("__toks"))
    # tokens are runs of word characters, so the single-regex n-gram builder applies
    return toks.select(*keep, ngrams_of_words(F.col("__toks"), n).alias(out))


def ngram_counts(df: DataFrame, text: str, n: int, stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> DataFrame:
    """(words, total) over the whole corpus; n-grams never cross texts."""
    grams = explode_ngrams(with_ngrams(df, text, n, "__g", (), stopwords), "__g", "words")
    return grams.groupBy("words").agg(F.count(F.lit(1)).alias("total"))


def explode_ngrams(df: DataFrame, column: str, out: str, position: str | None = None) -> DataFrame:
    """One row per n-gram. ``explode_outer`` + a null filter instead of ``explode``: for an inner
    explode Catalyst infers ``size(array) > 0`` below the generator and inlines the whole token
    expression into that filter, tokenizing every text twice."""
    keep = [c for c in df.columns if c != column]
    if position:
        x = df.select(*keep, F.posexplode_outer(column).alias(position, out))
    else:
        x = df.select(*keep, F.explode_outer(column).alias(out))
    return x.where(F.col(out).isNotNull())


def _ngrams_of_sizes(toks: Column, sizes: Sequence[int]) -> Column:
    """The n-grams of all ``sizes`` of a token array, one size after another. The tokens are a lambda's variable, so they are made once."""
    def of(x: Column, n: int) -> Column:
        starts = F.slice(x, 1, F.greatest(F.size(x) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda w, i: F.concat_ws(" ", w, *(F.get(x, i + j) for j in range(1, n))))

    return F.get(F.transform(F.array(toks), lambda x: F.concat(*(of(x, n) for n in sizes))), F.lit(0))


def top_ngrams_of(df: DataFrame, by: str | None, text: str, sizes: Sequence[int], k: int = 20,
                  stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> list[DataFrame]:
    """For each of ``sizes`` (by, words, total): the k most frequent n-grams of each value of ``by`` (None: of all rows), ties by
    n-gram. One scan and one tokenisation make the n-grams of all sizes: a text's tokens hold no blanks, so an n-gram's size is that
    of its words, and all are counted together. The rank filter keeps k rows of each value and size per task before they meet; the
    result, k rows of each, is stored once.

    Most n-grams occur once, and these can be among the first k only where fewer than k occur twice or more. So only n-grams that
    occur twice or more are sorted for their ranks; the values and sizes with fewer than k of them are counted again on their own, all
    n-grams ranked.
    """
    keep = [by] if by else []

    def ranked(rows: DataFrame, wanted: Sequence[int], least: int) -> DataFrame:
        grams = rows.select(*keep, _ngrams_of_sizes(content_tokens(text, stopwords), wanted).alias("__g"))
        counts = explode_ngrams(grams, "__g", "words").groupBy(*keep, "words").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= least)
        counts = counts.withColumn("__n", F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1)
        place = F.row_number().over(Window.partitionBy(*keep, "__n").orderBy(F.desc("total"), F.asc("words")))
        return materialize(counts.withColumn("__place", place).where(F.col("__place") <= k).drop("__place"))

    top, out = ranked(df, sizes, 2), []
    for n in sizes:
        of_size = top.where(F.col("__n") == n).drop("__n")
        if by:
            full = of_size.groupBy(F.col(by).alias("__by")).count().where(F.col("count") >= k)
            few = materialize(df.select(F.col(by).alias("__by")).distinct().join(full.withColumnRenamed("__by", "__full"), F.col("__by").eqNullSafe(F.col("__full")), "left_anti"))
            again = None if few.isEmpty() else df.join(few, F.col(by).eqNullSafe(F.col("__by")), "left_semi")
            rest = of_size.join(few, F.col(by).eqNullSafe(F.col("__by")), "left_anti")
        else:
            again, rest = (df if of_size.count() < k else None), of_size.limit(0)
        out.append(of_size if again is None else rest.unionByName(ranked(again, [n], 1).drop("__n")))
    return out


def top_ngrams(df: DataFrame, text: str, n: int, k: int | None = 20,
               stopwords: Iterable[str] = ENGLISH_STOPWORDS, stamp=None, heavy: bool = False) -> DataFrame:
    """The k most frequent n-grams (all when k is None), ties by n-gram; optional date stamp. With ``heavy`` by heavy hitters
    (``operators.heavy``) instead of a full count, for corpora whose distinct n-grams are too many to shuffle."""
    if heavy and k is not None:
        out = top_values(explode_ngrams(with_ngrams(df, text, n, "__g", (), stopwords), "__g", "words"), "words", k)
    else:
        counts = ngram_counts(df, text, n, stopwords)
        ordered = counts.orderBy(F.desc("total"), F.asc("words"))
        out = ordered.limit(k) if k is not None else ordered
    if stamp is not None:
        out = out.withColumn("date", F.lit(stamp).cast("date"))
    return out
