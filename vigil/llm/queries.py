"""The ``opN_*`` queries over the test tables, with production parameters, and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (chosen_path, containment, hard_negatives, id_codec, langid, line_quality, packing, prefix_bpe, pseudo_lm, roles, site_lines, url_filter,
                       vector_codes)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# DuckDB: words are runs outside 0x20 and 0x09-0x0D, A-Z as a-z.
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SHINGLES = """CASE WHEN len(w) >= {k} THEN list_distinct([list_aggregate(w[i:i + {k} - 1], 'string_agg', ' ') FOR i IN range(1, len(w) - {k} + 2)])
  WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END"""


def query(sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_id_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text in Simple-8b shards, in ascending doc_id order, read back."""
    import public_tokenizers

    return id_codec.encoded_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query()
def op2_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url: the longest rule's, else by trust and distrust over the host graph."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


@query()
def op3_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from documents whose crc32(doc_id) mod 4 isn't 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.train(docs.filter(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"], spans=False, any_script=True)


@query()
def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masked pseudo-likelihood of every text under a network trained on this corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudo_lm.score(docs, *pseudo_lm.train(docs))


@query(f"""
WITH l AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
h AS (SELECT DISTINCT source, text, trim(x, {_BLANK}) AS t FROM (SELECT source, text, unnest(ls) AS x FROM l) WHERE trim(x, {_BLANK}) <> ''),
n AS (SELECT source, count(DISTINCT coalesce(text, '')) AS n FROM documents GROUP BY 1),
bad AS (SELECT source, list(t) AS bad FROM (SELECT source, t, count(DISTINCT text) AS c FROM h GROUP BY 1, 2) JOIN n USING (source) WHERE c >= 5 AND 50 * c > n GROUP BY 1),
k AS (SELECT doc_id, text, ls, list_filter(ls, lambda x: NOT list_contains(coalesce(bad, []), trim(x, {_BLANK}))) AS ks FROM l LEFT JOIN bad USING (source))
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(ks, chr(10)) END AS text, coalesce(len(ls) - len(ks), 0) AS n_dropped FROM k
""")
def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate: lines on more than 0.02 of the site's different texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return site_lines.drop_site_lines(docs, dropped_col="n_dropped").select("doc_id", "text", "n_dropped")


@query(f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
g AS (SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1) GROUP BY 1),
x AS (SELECT doc_id, source, text, x, regexp_replace({_LOW.replace("coalesce(text, '')", f"trim(x, {_BLANK})")}, '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM (SELECT doc_id, source, text, unnest(ls) AS x FROM d) WHERE trim(x, {_BLANK}) <> ''),
n AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY 1),
bad AS (SELECT source, t FROM (SELECT source, t, count(DISTINCT text) AS c FROM x GROUP BY 1, 2) JOIN n USING (source) WHERE c >= 10 AND 50 * c > n),
lost AS (SELECT doc_id, sum(len({_WORDS.format("x")})) AS n FROM x JOIN bad USING (source, t) GROUP BY 1),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(list_filter(ls, lambda x: trim(x, {_BLANK}) <> '')) - len(list_distinct(list_filter(ls, lambda x: trim(x, {_BLANK}) <> ''))) AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS words_lost FROM d LEFT JOIN r USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * words_lost <= 3 * n_words AS kept FROM m
""")
def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a verdict for every text; documents of frequent lines of their site are rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_quality.judged(docs).drop("text", "source")


@query()
def op9_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its repaired role and its segment of the rendered conversation."""
    return roles.repair_roles(table(spark, sf_dir, "conversations"))


@query()
def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the table of last tokens, and the bytes decoded from them."""
    import public_tokenizers

    return prefix_bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                   public_tokenizers.PATTERN, keep=["doc_id"], ids=False)


@query("""
WITH RECURSIVE s AS (SELECT doc_id, unnest(g) AS g FROM (SELECT doc_id, %s AS g FROM (SELECT doc_id, %s AS w FROM documents))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * c >= 85 * (u.n + v.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
""" % (_SHINGLES.format(k=3), _WORDS.format(_LOW)))
def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a similarity of 0.85 or more."""
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


@query("""
WITH d AS (SELECT DISTINCT doc_id, unnest(g) AS g FROM (SELECT doc_id, %s AS g FROM (SELECT doc_id, %s AS w FROM documents))),
b AS (SELECT DISTINCT item_id, unnest(g) AS g FROM (SELECT item_id, %s AS g FROM (SELECT item_id, %s AS w FROM benchmark))),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1)
SELECT doc_id, item_id, n AS n_item, count(*) AS n_shared, count(*) / n AS containment
FROM b JOIN d USING (g) JOIN n USING (item_id) GROUP BY 1, 2, 3 HAVING 10 * count(*) >= 8 * n
""" % (_SHINGLES.format(k=5), _WORDS.format(_LOW), _SHINGLES.format(k=5), _WORDS.format(_LOW)))
def op8_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain at least 0.8 of a benchmark item's 5-word shingles."""
    return containment.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
_WHOLE = "list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT))"


def _code_round(n: int) -> str:
    """Assignment n, and from its sums the codebook n + 1 (codebook 0: the first vectors)."""
    return f"""
a{n} AS (SELECT i, p, any_value(x) AS x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT t.i, t.p, t.x, c.e, list_sum(list_transform(range(1, len(t.x) + 1), lambda j: (t.x[j] - c.x[j]) * (t.x[j] - c.x[j])))::BIGINT AS d
  FROM t JOIN c{n} c USING (p)) GROUP BY 1, 2),
m{n} AS (SELECT p, e, list(s ORDER BY j) AS x FROM (SELECT p, e, j, floor(sum(x[j])::DECIMAL(38, 0) / count(*))::BIGINT AS s FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS j FROM a{n}) GROUP BY 1, 2, 3) GROUP BY 1, 2),
c{n + 1} AS (SELECT p, e, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (p, e))"""


@query(f"""
WITH v AS (SELECT vec_id, label, {_WHOLE} AS x, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i FROM embeddings WHERE {_USABLE}),
t AS (SELECT i, p, x[p * len(x) // 16 + 1:(p + 1) * len(x) // 16] AS x FROM (SELECT i, x, unnest(range(16)) AS p FROM v)),
c0 AS (SELECT p, i - 1 AS e, x FROM t WHERE i <= 64),{_code_round(0)},{_code_round(1)},{_code_round(2)},
r AS (SELECT i, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY 1)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256 FROM r JOIN v USING (i)
""")
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as 16 entry numbers of codebooks of 64, trained in two rounds over all vectors."""
    return vector_codes.coded_digest(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


@query(f"""
WITH v AS (SELECT row_number() OVER () AS i, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS x FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
s AS (SELECT a.i AS a, a.vec_id AS anchor_id, b.i AS b, b.vec_id, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.x) + 1), lambda j: a.x[j] * b.x[j]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.i <> b.i),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id) <= 5
""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every anchor (vec_id divisible by 100) and each of its five positives the first five rows of other labels in the window."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query()
def op13_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in sequences of 4096 tokens."""
    import public_tokenizers

    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
