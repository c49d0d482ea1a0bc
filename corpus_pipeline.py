"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, byte-pair encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``documents``. ``run`` chains them over ``documents``; each stage's rows are
written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import chosen_path, containment, line_quality, prefix_bpe, site_lines
from vigil.llm._jobs import stored


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have (whatever its case)."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _new_length(clean: DataFrame, docs: DataFrame, gone: str) -> DataFrame:
    """n_chars, if ``docs`` has it, of the texts that lost something, which ``gone`` counts."""
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.select(*(F.col(f"`{c}`") for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are frequent on their source go, and documents that the quality rules reject; n_chars follows the text."""
    gone = _unused(docs, "gone_")
    return _new_length(line_quality.keep_good(docs, lost_col=gone), docs, gone)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; n_chars follows the text."""
    gone = _unused(docs, "gone_")
    return _new_length(site_lines.drop_site_lines(docs, dropped_col=gone), docs, gone)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (5-word shingles, similarity of 0.8 or more)."""
    return chosen_path.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go (0.8 or more of its 5-word shingles)."""
    return containment.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids, and digests of the ids and of the text decoded from them."""
    return prefix_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: No SQL expresses the last stage; the tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
