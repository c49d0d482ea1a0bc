"""Quality rules: counts within a text, then cross-document line frequency; DataFrame functions only.

Within a text: words, symbols, repeated lines, and words in repeated 3-word windows. Across documents:
lines are normalised (A-Z as a-z, white space collapsed), hashed, and counted by distinct documents of
their site (copies of a text are one document in all counts). Lines that more than ``max_share`` of a site's documents (and at least ``least``) hold are
removed from the text, and a document that loses more than ``max_lost`` of its words that way is depleted
and rejected. Measures and base rules are those of the text as it came.

Everything within a text is computed in its row. Counts of lines are taken before the shuffle; what comes
back is one bounded array of hashes a site, by a broadcast of checked size or a salted join. Repeated
windows are found by sorting (hash, position) numbers and comparing neighbours, word by word where hashes
agree, so time is n log n in a text's words; texts whose windows' hashes all differ need no sorting.

Rules: a null text has no words, so it fails the base rules. A null site is a site of its own. Repeated rows each get the
same verdict.
Lines without text stay; a text that loses no line stays as it is. Other columns are kept. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm._lines import BLANKS, frequent_lines, lines, look_up, site_key, trimmed

SYMBOLS = "[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _words(text: Column) -> Column:
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS))


def _normal(line: Column) -> Column:
    def low(x: Column) -> Column:  # translate goes through a dictionary for every character; lower does the same where all are ASCII
        letters = F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(letters)

    return _let(trimmed(line), lambda x: F.xxhash64(F.regexp_replace(low(x), BLANKS, " ")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once. (A column used within a lambda may be inlined into it by
    the optimiser and computed for every element; a lambda's own variable can't.)"""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _counted(words: Column) -> Column:
    """(n, chars, repeated): words, their characters, and words in 3-word windows that occur twice or more."""
    nothing = F.array().cast("array<bigint>")

    def hashes(w: Column, m: Column) -> Column:
        """Each window's hash."""
        each = F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(m > 0, each).otherwise(nothing)

    def keys(h: Column, bits: Column) -> Column:
        """Each hash over its place: sorting puts equal windows side by side."""
        high = lambda x: F.call_function("shiftleft", F.call_function("shiftright", x, bits), bits)
        return F.sort_array(F.transform(h, lambda x, i: high(x).bitwiseOR(i.cast("long"))))

    def places(w: Column, m: Column, bits: Column, mask: Column, s: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            p, q = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            near = F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)
            for k in range(3):
                near = near & (F.get(w, p + k) == F.get(w, q + k))
            return near

        twice = F.filter(s, lambda x, i: ((i > 0) & same(x, F.get(s, i - 1))) | ((i < m - 1) & same(x, F.get(s, i + 1))))
        return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(mask)))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
        return F.aggregate(at, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(3).cast("long"), x - a["last"])).alias("n"), x.alias("last")),
                           lambda a: a["n"])

    def repeated(w: Column) -> Column:
        def with_bits(m: Column, h: Column, bits: Column) -> Column:  # places 0 to m - 1 fit into so many bits
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
            return _let(mask, lambda k: _let(keys(h, bits), lambda s: covered(places(w, m, bits, k, s))))

        def with_hashes(m: Column, h: Column) -> Column:
            return F.when(F.size(F.array_distinct(h)) == m, F.lit(0).cast("long")).otherwise(_let(F.length(F.bin(m)), lambda bits: with_bits(m, h, bits)))
        return _let(F.greatest(F.size(w) - 2, F.lit(0)), lambda m: _let(hashes(w, m), lambda h: with_hashes(m, h)))

    return _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeated(w).alias("repeated")))


def _judgement(text: Column, bad: Column, max_lost: float) -> Column:
    """A struct of MEASURES, words_lost, base_failed and kept, computed once."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def lost(held: Column) -> Column:
        def of(gone: Column) -> Column:
            removed = F.filter(held, lambda x: F.array_contains(gone, _normal(x)))
            n = F.aggregate(removed, F.lit(0), lambda n, x: n + F.size(F.split(trimmed(x), BLANKS)))
            return F.when(F.coalesce(F.size(gone), F.lit(0)) <= 0, F.lit(0)).otherwise(n).cast("long")
        return _let(_gone(held, bad), of)

    def of_lines(held: Column) -> Column:
        return F.struct((F.size(held) - F.size(F.array_distinct(held))).cast("long").alias("dup"), lost(held).alias("lost"))

    def measures(counted: Column, held: Column) -> Column:
        return F.struct(counted["n"].alias("n_words"), counted["chars"].alias("word_chars"), (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
                        held["dup"].alias("n_dup_lines"), counted["repeated"].alias("n_repeat_words"), held["lost"].alias("words_lost"))

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        return F.struct(*(m[c].alias(c) for c in [*MEASURES, "words_lost"]), failed.alias("base_failed"),
                        (~failed & (m["words_lost"] <= m["n_words"] * max_lost)).alias("kept"))

    held = F.filter(lines(text), lambda x: trimmed(x) != "")
    return _let(_let(_counted(_words(text)), lambda c: _let(_let(held, of_lines), lambda h: measures(c, h))), verdict)


def _gone(held: Column, bad: Column) -> Column:
    """The hashes of a text's lines that are above the limit, by hash sets; null where the site has none."""
    return F.when(bad.isNotNull(), F.array_intersect(F.transform(held, _normal), bad))


def _without(text: Column, bad: Column) -> Column:
    return _let(_gone(lines(text), bad), lambda gone: F.array_join(F.filter(lines(text), lambda x: (trimmed(x) == "") | ~F.array_contains(gone, _normal(x))), "\n"))


def judged(docs: DataFrame, text_col: str = "text", site_col: str = "source", least: int = 10,
           max_share: float = 0.02, max_lost: float = 0.3, whole_rows: bool = False, lost_col: str | None = None) -> DataFrame:
    """``docs``, its texts without the removed lines, with MEASURES, words_lost (words in removed lines), base_failed
    and kept (columns of ``docs`` with these names are left out); with ``whole_rows`` only the kept rows, with the
    columns of ``docs`` and, if named, ``lost_col`` (words_lost)."""
    bad = frequent_lines(docs, site_key(site_col), F.col(text_col), _normal, least, max_share)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row_"), site_key(site_col).alias("site_"))
    was, found = F.col("row_")[text_col], F.col("found_")
    rows = look_up(rows, bad, "site_", was)
    judgement = _judgement(was, F.col("bad_"), max_lost)
    text = F.when(found["words_lost"] > 0, _without(was, F.col("bad_"))).otherwise(was)

    def column(c: str) -> Column:
        return (text if c == text_col else F.col("row_")[c]).alias(c)

    if whole_rows:  # a generated value can't be computed again by a filter on it
        kept = rows.select("row_", "bad_", F.explode_outer(F.array(judgement)).alias("found_")).filter(found["kept"])
        return kept.select(*map(column, docs.columns), *([found["words_lost"].alias(lost_col)] if lost_col else []))
    made = [*MEASURES, "words_lost", "base_failed", "kept"]
    return rows.withColumn("found_", judgement).select(*(column(c) for c in docs.columns if c not in made), *(found[c].alias(c) for c in made))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, without the removed lines, with the columns of ``docs``."""
    return judged(docs, whole_rows=True, **options)
