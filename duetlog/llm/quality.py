"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` lists, per measure, the least and the greatest value that a text of
running prose has.  ``compile_rules`` turns the table into one boolean
column and one array column (names of the broken rules); ``measures`` gives
the length, symbol, stop-word and line figures the table speaks of.  All of
it is built-in functions over the row's own text: no user function, no
shuffle, no state beyond one row.

Defined results: a null text counts as empty; an empty text has zero for
every count, ratio 0, and fails the base rule (fewer than 50 words).
Repeated rows are judged alike; extra columns are passed by.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

#: Characters that count as symbols (fixed by the query's contract).
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the corpus languages.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "by",
    "this", "have", "from", "at", "or", "an", "not",
    # German
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im", "dem", "nicht", "ein", "eine", "auf", "für",
    # French
    "le", "la", "les", "des", "du", "et", "un", "une", "est", "que", "qui", "dans", "pour", "pas", "sur", "avec", "au",
    # Spanish
    "el", "los", "las", "en", "por", "con", "para", "se", "es", "no", "una", "su", "lo", "al", "de", "y",
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


class Rule(NamedTuple):
    name: str
    measure: str
    least: float | None
    greatest: float | None


RULES = (
    Rule("length", "n_words", MIN_WORDS, None),
    Rule("repetition", "repeat_ratio", None, MAX_REPEAT_PERCENT / 100),
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbol_ratio", None, 0.10),
    Rule("letters", "letter_word_ratio", 0.70, None),
    Rule("stop_words", "stop_ratio", 0.05, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.30),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.30),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.90),
)


def _let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, n: Column) -> Column:
    """Words inside a three-word window that the text holds twice or more.

    Windows are compared by a 64-bit hash chained over their words.  Only a
    text that has a repeated window is sorted: (hash, place) pairs next to an
    equal hash give the repeated places, and a place covers up to three words
    not covered by the place before it."""
    hashes = F.transform(F.sequence(F.lit(0), n - 3),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = _let(pairs, lambda s: F.transform(
            F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))),
            lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(F.sort_array(places), zero,
                           lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
                           lambda a: a["n"])

    some = _let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)))
    return F.when(n < 4, F.lit(0)).otherwise(some).cast("long")


def measures(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus every count and ratio of the rules."""
    t = F.coalesce(column(df, text), F.lit(""))
    words = F.filter(F.split(t, "[ \\t-\\r]+"), lambda w: w != F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    parts = df.select(*[column(df, c) for c in keep], t.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    parts = parts.withColumn("_n", F.size("_words")).withColumn("_n_lines", F.size("_lines"))
    n, n_lines = F.col("_n"), F.col("_n_lines")
    counts = parts.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words"), n).alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).alias("n_stop"),
        F.size(F.filter("_words", lambda w: w.rlike("\\p{L}"))).alias("n_letter_words"),
        n_lines.alias("n_lines"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("n_ellipsis"),
        F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike("^[-*•]"))).alias("n_bullets"),
    )

    def ratio(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return counts.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
        ratio("n_stop", "n_words").alias("stop_ratio"),
        ratio("n_letter_words", "n_words").alias("letter_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_ellipsis", "n_lines").alias("ellipsis_line_ratio"),
        ratio("n_bullets", "n_lines").alias("bullet_line_ratio"),
    )


def compile_rules(rules=RULES) -> tuple[Column, Column]:
    """(all rules hold, names of the rules that do not)."""
    checks = []
    for r in rules:
        ok = F.lit(True)
        if r.least is not None:
            ok = ok & (F.col(r.measure) >= F.lit(r.least))
        if r.greatest is not None:
            ok = ok & (F.col(r.measure) <= F.lit(r.greatest))
        checks.append((r.name, ok))
    every = F.lit(True)
    for _, ok in checks:
        every = every & ok
    broken = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks]), lambda x: x.isNotNull())
    return every, broken


def judge(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """Every row of ``df`` with its counts, the base verdict, the verdict of
    the table and the rules it breaks."""
    m = measures(df, text, keep)
    every, broken = compile_rules(rules)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return m.select("*", base.alias("base_failed"), (~base & every).alias("kept"), broken.alias("broken_rules"))


def quality(df: DataFrame) -> DataFrame:
    """Digest of ``judge``: one row per document."""
    return judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                            "base_failed", "kept")


def oracle_sql() -> str:
    """The same in DuckDB, worked out by unnesting (text constants are the
    fixed values above)."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    symbols = "[" + SYMBOLS.replace("|", "\\|").replace("$", "\\$").replace("*", "\\*") + "]"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS l FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM s WHERE len(w) >= 3),
h AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM g),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM h),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r WHERE c > 1) GROUP BY doc_id),
m AS (SELECT s.doc_id, len(w) AS n_words, length(regexp_replace(t, '[ \t\n\x0b\f\r]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '{symbols}', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS n_ell,
             len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bul, len(l) AS n_lines
      FROM s LEFT JOIN c USING (doc_id)),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       (NOT base_failed AND n_repeat_words / n_words <= {MAX_REPEAT_PERCENT / 100}
        AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.1
        AND n_letter / n_words >= 0.7 AND n_stop / n_words >= 0.05
        AND n_dup_lines <= 0.3 * n_lines AND n_ell <= 0.3 * n_lines AND n_bul <= 0.9 * n_lines) AS kept
FROM b"""
