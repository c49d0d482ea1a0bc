"""URL filter: host and path rules, then trust and distrust over the host graph; DataFrame functions only.

1. Rules. A rule (host, path) fits its host and all its subdomains if the url's path starts with the
   rule's; the longest rule wins (ties: the longer host, then block). Rules are joined on the suffixes of
   distinct hosts, so a rule list of any size works.
2. Seeds. A host's trust seed is the share of its pages that rules allow, its distrust seed the share
   that rules block.
3. Edges. Host a links to host b if pages of a hold absolute or scheme-relative links to b (weight: such
   pages), and both ways between a host and the page host that it is a subdomain of (weight 1).
4. Propagation. Trust is a personalised PageRank from the trust seeds along edges; distrust runs from the
   distrust seeds against them: score = seed + damping * (weighted mean over edges of the neighbours'
   scores), iterated until no score moves by ``tolerance``: all changes together shrink by ``damping`` at each step, so it
   ends (``most`` ends it earlier, with a warning); scores are stored at each step.
5. Verdict of a page without a rule: block if its host's distrust is at least ``threshold`` and above its
   trust, else allow.

A host's facts come back to its pages by a broadcast of measured bytes or a salted join. Links of a page are
counted before the shuffle.

Rules for odd rows: a null url or one without ``://`` has an empty host and path, which no rule fits, and is
allowed; a null page holds no links; repeated rows are pages of their own; other columns are kept; an
empty table gives an empty result.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm._jobs import stored
from vigil.llm._lines import look_up

#: (verdict, rule): a host, then a path.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    return pages.withColumn("host", lower(F.regexp_extract(url, _URL, 1))).withColumn("path", F.regexp_extract(url, _URL, 2))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules_): the rules (verdict, rule) that fit each host, the longest first."""
    parts = (rules.select("verdict", "rule", F.substring_index("rule", "/", 1).alias("of"))
             .withColumn("path", F.expr("substring(rule, length(of) + 1)"))
             .withColumn("rank", F.struct(-F.length("rule"), -F.length("of"), F.when(F.col("verdict") == "block", 0).otherwise(1))))
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    near = hosts.select("host", labels.alias("labels")).select("host", F.explode(ends).alias("of"))
    return near.join(parts, "of").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path", "rule", "verdict"))).alias("rules_"))


def best_rule() -> Column:
    """Of a row with path and rules_: the first rule that fits (null: none)."""
    return F.get(F.filter("rules_", lambda r: F.col("path").startswith(r["path"])), F.lit(0))


def host_edges(pages: DataFrame, hosts: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, w) between different hosts; pages has host and ``html_col``."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), F.lit(1)), lower))
    links = pages.select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    up = hosts.select("host", F.regexp_replace("host", r"^[^.]*\.", "").alias("up")).filter("host <> up")
    up = up.join(hosts.select(F.col("host").alias("up")), "up")
    near = up.select(F.col("host").alias("src"), F.col("up").alias("dst")).unionByName(up.select(F.col("up").alias("src"), F.col("host").alias("dst")))
    return (links.unionByName(near).filter("src <> dst and src <> '' and dst <> ''")
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))


def propagated(seeds: DataFrame, edges: DataFrame, damping: float, tolerance: float, most: int | None) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) and edges (src, dst, w)."""
    out = edges.groupBy("src").agg(F.sum("w").alias("all_out"))
    into = edges.groupBy("dst").agg(F.sum("w").alias("all_in"))
    shares = edges.join(out, "src").join(into, "dst")
    both = stored(shares.select(F.col("src").alias("from"), F.col("dst").alias("host"), (F.col("w") / F.col("all_out")).alias("t"), F.lit(0.0).alias("d"))
                  .unionByName(shares.select(F.col("dst").alias("from"), F.col("src").alias("host"), F.lit(0.0).alias("t"),
                                             (F.col("w") / F.col("all_in")).alias("d"))), "shares")
    nodes = both.select("host").distinct().join(seeds, "host", "full_outer").na.fill(0.0)
    nodes = stored(nodes, "seeds")
    state = nodes
    if not 0 <= damping < 1:
        raise ValueError("damping lies in [0, 1)")
    steps, going = 0, not both.isEmpty()
    while going:
        sent = both.join(state.select(F.col("host").alias("from"), "trust", "distrust"), "from")
        got = sent.groupBy("host").agg(F.sum(F.col("t") * F.col("trust")).alias("t"), F.sum(F.col("d") * F.col("distrust")).alias("d"))
        new = nodes.join(got, "host", "left").na.fill(0.0).select(
            "host", (F.col("trust") + damping * F.col("t")).alias("trust"), (F.col("distrust") + damping * F.col("d")).alias("distrust"))
        was = state.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
        state = stored(new.join(was, "host"), "scores")
        moved = state.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("t0")), F.abs(F.col("distrust") - F.col("d0")))).alias("m")).first()["m"]
        state = state.select("host", "trust", "distrust")
        steps += 1
        if moved is None or moved < tolerance:
            break
        if steps == most:
            warnings.warn(f"scores still move by {moved} after {most} steps")
            break
    return state


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame = RULES, url_col: str = "url", html_col: str = "html",
               damping: float = 0.7, tolerance: float = 1e-3, most: int | None = None, threshold: float = 0.5) -> DataFrame:
    """``pages`` (without ``html_col``) with host, path, rule, verdict, trust and distrust."""
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame(rules, "verdict string, rule string")
    made = ["host", "path", "rule", "verdict", "trust", "distrust"]
    keep = [c for c in pages.columns if c not in made and c != html_col]
    placed = with_host_path(pages.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    hosts = stored(placed.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    fitting = stored(hosts.select("host").join(host_rules(hosts, rules), "host", "left"), "host_rules")
    ruled = look_up(placed.select("host", "path"), fitting, "host", F.col("path")).select("host", best_rule()["verdict"].alias("v"))
    seeds = ruled.groupBy("host").agg(*(F.avg(F.when(F.col("v") == v, 1.0).otherwise(0.0)).alias(c) for v, c in (("allow", "trust"), ("block", "distrust"))))
    edges = stored(host_edges(placed, hosts, "html"), "host_edges")
    scores = propagated(stored(seeds, "host_seeds"), edges, damping, tolerance, most)
    facts = stored(fitting.join(scores, "host", "left"), "host_facts")
    found = look_up(placed.select("row", "url", "host", "path"), facts, "host", F.col("url")).withColumn("best", best_rule())
    trust, distrust = F.round(F.coalesce("trust", F.lit(0.0)), 9), F.round(F.coalesce("distrust", F.lit(0.0)), 9)
    own = F.when((distrust >= threshold) & (distrust > trust), "block").otherwise("allow")
    return found.select(*(F.col("row")[c].alias(c) for c in keep), "host", "path", F.col("best")["rule"].alias("rule"),
                        F.coalesce(F.col("best")["verdict"], own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
