"""The daily posts load (F-10 + K-2..K-4) as an incremental Structured Streaming job.

New files landing in the posts folder trigger a micro-batch. A micro-batch only tells which days
received posts; the touched days are then recomputed together from the landed table (one read, which
prunes to their range where the table is partitioned by date) and written with dynamic partition
overwrite. Top-k n-grams of a day are therefore always computed over the complete day, never over a fragment of it, and a replayed
batch (after a failure) rewrites the same partitions: the sink is idempotent. A recomputed day that is left without
posts is emptied. The stream's progress lives in a checkpoint folder beside the marts (or a named one), so a
restart goes on where the last run stopped.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil.functions.stopwords import ENGLISH_STOPWORDS
from vigil.functions.text import clean_text
from vigil.operators.ngrams import top_ngrams_of
from vigil.plans.posts import TOP_K, posts_mart
from vigil.session import scratch_path
from vigil.sinks.tables import delete_folder, write_daily


def recompute(posts: DataFrame, out: str, lexicon: DataFrame, days: list[date], lang: str = "en", k: int = TOP_K, stopwords=ENGLISH_STOPWORDS) -> None:
    """Write the marts of ``days``, whose posts ``posts`` holds, in one job for each mart; a day without posts is emptied. Bigrams
    carry the posts' day, trigrams the day after it (the daily run's stamps)."""
    clean = posts.where(F.col("language") == lang).withColumn("text", clean_text("tweet"))
    staged = scratch_path(posts.sparkSession, "posts-batch")  # read by both marts' jobs; goes with the batch
    clean.select("post_id", "date", "tweet", "text").write.parquet(staged)
    clean = posts.sparkSession.read.parquet(staged)
    try:
        write_daily(posts_mart(clean, lexicon), f"{out}/posts", days=days)
        bigrams, trigrams = top_ngrams_of(clean, "date", "text", (2, 3), k, stopwords)
        write_daily(bigrams, f"{out}/bigrams", days=days)
        write_daily(trigrams.withColumn("date", F.date_add("date", 1)), f"{out}/trigrams", days=[d + timedelta(days=1) for d in days])
    finally:
        delete_folder(posts.sparkSession, staged)


def load_days(spark: SparkSession, landing: str, schema: StructType, out: str, lexicon: DataFrame,
              days: list[date], lang: str = "en") -> None:
    """Recompute and replace the marts of the given posting days."""
    posts = spark.read.schema(schema).parquet(landing)
    recompute(posts.where(F.col("date").isin(days)), out, lexicon, days, lang)


def load_touched(spark: SparkSession, landing: str, schema: StructType, out: str, lexicon: DataFrame, batch: DataFrame,
                 lang: str = "en") -> None:
    """Recompute the days that a batch of posts touches, over everything that has landed for them. The days (at most the calendar's)
    prune a landing table that is partitioned by date."""
    days = [r["date"] for r in batch.select(F.to_date("ts").alias("date")).where(F.col("date").isNotNull()).distinct().collect()]
    if days:
        load_days(spark, landing, schema, out, lexicon, days, lang)


def start(spark: SparkSession, landing: str, schema: StructType, out: str, lexicon: DataFrame,
          checkpoint: str | None = None, lang: str = "en", available_now: bool = True,
          processing_time: str = "1 hour") -> StreamingQuery:
    """Start the incremental load; ``available_now`` processes what has landed and stops. ``checkpoint`` (default: ``<out>/_progress``)
    is the stream's own: a later start with the same folder takes only what has landed since."""
    checkpoint = checkpoint or f"{out}/_progress"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        load_touched(spark, landing, schema, out, lexicon, batch, lang)

    writer = (spark.readStream.schema(schema).parquet(landing)
              .writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
