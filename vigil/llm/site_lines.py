"""Line dedup by site-relative frequency, in DataFrame functions only.

Pages are grouped by host; a line's ratio is the number of the host's pages that hold it over the number
of the host's pages. Exact copies of a page's text are one page in both numbers, so a text that stands on a host many
times doesn't make its lines boilerplate, nor does it hide others. Lines whose ratio exceeds ``max_ratio`` (and that at least ``min_pages`` pages
hold) are boilerplate and go from every page of that host. Lines are compared without white space at
their ends; lines without text are never dropped and never counted.

Counts are taken before the shuffle and again after it; what comes back to the pages is one bounded array
a host (at most average lines a page / max_ratio hashes), by a broadcast of checked size or a salted join,
so a host with a third of all pages is in no single task.

Rules: a null text stays null and holds no lines; it counts as an empty page; null hosts are one host. Repeated rows all stay. All other columns are kept as they are. A page of boilerplate only
keeps its row, without those lines. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm._lines import frequent_lines, lines, look_up, site_key, trimmed


def drop_site_lines(pages: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = 0.02,
                    min_pages: int = 5, dropped_col: str | None = None) -> DataFrame:
    """The rows of ``pages`` with ``text_col`` rewritten; ``dropped_col`` adds the number of lines dropped."""
    def line_hash(x):
        return F.xxhash64(trimmed(x))

    bad = frequent_lines(pages, site_key(host_col), F.col(text_col), line_hash, min_pages, max_ratio)
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row"), site_key(host_col).alias("site_"))
    was = F.col("row")[text_col]
    found = look_up(rows, bad, "site_", was).withColumn("lines", lines(was))
    hashes = F.transform("lines", lambda x: F.when(trimmed(x) != "", line_hash(x)))
    found = found.withColumn("gone", F.array_intersect(hashes, "bad_"))  # by hash sets: linear in the lines and the site's array
    clean = F.filter("lines", lambda x: (trimmed(x) == "") | ~F.array_contains("gone", line_hash(x)))
    found = found.withColumn("clean", F.when(F.coalesce(F.size("gone"), F.lit(0)) <= 0, F.col("lines")).otherwise(clean))
    gone = F.size("lines") - F.size("clean")
    text = F.when(gone > 0, F.array_join("clean", "\n")).otherwise(was)
    return found.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in pages.columns),
                        *([gone.cast("long").alias(dropped_col)] if dropped_col else []))
