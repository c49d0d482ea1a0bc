"""Lines of texts, and the lines that are frequent on a site, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm._jobs import broadcast_if_small, stored

#: White space of the word definition: 0x20 and 0x09-0x0D.
BLANK = " \t\n\x0b\x0c\r"
BLANKS = r"[\x20\x09-\x0D]+"
#: Copies of a site's row in a join that can't be a broadcast, so a site with a third of all rows is spread.
SALTS = 32


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(BLANK))


def site_key(column: str) -> Column:
    """A site's name; null is a site of its own."""
    c = F.col(column).cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c))


def look_up(big: DataFrame, small: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join of a stored table with one row a key: a broadcast if its measured bytes allow it, else a shuffle in
    which each key is dealt to SALTS partitions by ``spread``."""
    sent = broadcast_if_small(small)
    if sent is not small:
        return big.join(sent, key, "left")
    salted = small.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("salt_", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(salted, [key, "salt_"], "left").drop("salt_")


def frequent_lines(docs: DataFrame, site: Column, text: Column, line_hash: Callable[[Column], Column], least: int, share: float) -> DataFrame:
    """(site_, bad_): for each site the hashes of lines with text that more than ``share`` of its different texts
    and at least ``least`` of them hold: copies of a text, however many, are one page in both counts (null and empty are the same
    text), so copying makes no line boilerplate. A site's array has at most (lines of its average text) / ``share`` entries."""
    held = F.array_distinct(F.transform(F.filter(lines(text), lambda x: trimmed(x) != ""), line_hash))
    doc = F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))
    rows = docs.select(site.alias("site_"), doc.alias("doc_"), held.alias("held_"))
    each = rows.select("site_", "doc_", F.explode("held_").alias("line_")).distinct()
    counts = each.groupBy("site_", "line_").agg(F.count("*").alias("n_")).filter(F.col("n_") >= least)
    totals = stored(rows.select("site_", "doc_").distinct().groupBy("site_").agg(F.count("*").alias("total_")), "sites")
    bad = look_up(counts, totals, "site_", F.col("line_")).filter(F.col("n_") > F.col("total_") * share)
    return stored(bad.groupBy("site_").agg(F.sort_array(F.collect_list("line_")).alias("bad_")), "frequent_lines")

