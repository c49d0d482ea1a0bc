"""Posts job (F-10): search -> language filter -> cleaning -> sentiment -> marts.

One scan with pushed filters feeds two branches: the posts mart (sentiment label per post) and the
two n-gram marts (top bigrams stamped with the first day of the period, top trigrams with the
day after it, as in the daily run), which one pass over the texts makes. ``build_posts(stage=True)`` checkpoints the cleaned posts once
when all three marts are written.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.stopwords import ENGLISH_STOPWORDS
from vigil.functions.text import clean_text, text_length, word_count
from vigil.operators.ngrams import top_ngrams_of
from vigil.operators.search import PostFilter, search_posts
from vigil.operators.sentiment import score_sentiment, score_sentiment_rules
from vigil.session import materialize

MART_COLUMNS = ["date", "tweet", "text", "sentiment"]
TOP_K = 20  # fixed value: n-grams kept per run


@dataclass
class PostsRun:
    since: date
    until: date
    keyword: str | None = None
    lang: str = "en"
    limit: int | None = None
    popular: bool = True
    k: int = TOP_K

    @classmethod
    def daily(cls, run_date: date, **kw) -> "PostsRun":
        """The daily load: posts of the day before ``run_date``."""
        return cls(since=run_date - timedelta(days=1), until=run_date, **kw)


def cleaned_posts(posts: DataFrame, run: PostsRun) -> DataFrame:
    f = PostFilter(keyword=run.keyword, since=run.since.isoformat(), until=run.until.isoformat(),
                   popular=run.popular, limit=run.limit)
    p = search_posts(posts, f)
    p = p.where(F.col("language") == run.lang)
    return p.withColumn("text", clean_text("tweet"))


def with_lengths(df: DataFrame) -> DataFrame:
    return df.withColumns({"text_len": text_length("text"), "text_word_count": word_count("text")})


def posts_mart(clean: DataFrame, lexicon: DataFrame, rules: bool = True) -> DataFrame:
    """date, tweet, text and the sentiment label (with the positional rules by default)."""
    score = score_sentiment_rules if rules else score_sentiment
    scored = score(clean, "post_id", "text", lexicon, keep=["date", "tweet", "text"])
    return scored.select("post_id", *MART_COLUMNS)


def ngram_marts(clean: DataFrame, run: PostsRun, stopwords=ENGLISH_STOPWORDS) -> tuple[DataFrame, DataFrame]:
    """The bigram and the trigram mart from one pass over the texts."""
    bigrams, trigrams = top_ngrams_of(clean, None, "text", (2, 3), run.k, stopwords)
    return tuple(g.select("words", "total", F.lit(stamp).cast("date").alias("date")) for g, stamp in ((bigrams, run.since), (trigrams, run.until)))


def build_posts(posts: DataFrame, run: PostsRun, lexicon: DataFrame, stopwords=ENGLISH_STOPWORDS,
                stage: bool = False, ngrams: bool = True):
    """(posts mart, bigram mart, trigram mart); the n-gram marts (k rows each) are made when this is called, unless
    ``ngrams`` is False (then they are None).

    With ``stage`` the cleaned posts of the period are checkpointed once (reliably, in the shared
    folder), so writing all marts scans and cleans the texts once.
    """
    clean = cleaned_posts(posts, run)
    if stage:
        clean = materialize(clean.select("post_id", "date", "tweet", "text"))
    bigrams, trigrams = ngram_marts(clean, run, stopwords) if ngrams else (None, None)
    return posts_mart(clean, lexicon), bigrams, trigrams
