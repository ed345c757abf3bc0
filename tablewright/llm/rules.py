"""Quality rules: clean line by line, then judge what is left of the document.

Each line is tested for broken punctuation, navigation and boilerplate. Lines
that fail are taken out. A document is rejected if the counts over its whole
text break a base rule, or if too large a share of its words went with the
lines. Everything is one projection of built-in functions: no shuffle, and a
document is one row whatever its length.

Defined results: a null text counts as empty; it has no words, fails the base
rules and is rejected. Repeated rows are judged alike. Columns of the input
stay as they are, under any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arrays import let
from tablewright.llm.common import SPACE, WORD, documents, whole
from tablewright.llm.registry import query

#: Signs counted as symbols, and phrases of notices that are not prose.
SYMBOLS = r"[#*$%&|<>]"
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|"
    r"enable javascript|lorem ipsum|^ *(this work is )?(licensed|released) under |^ *(copyright|©|\(c\)) "
)


@dataclass(frozen=True)
class RuleSet:
    """Thresholds; percentages are per word of the line or of the document."""

    min_words: int = 50
    max_repeat_percent: int = 50
    symbol_percent: int = 30
    bang_percent: int = 20
    separator_percent: int = 20
    boilerplate_words: int = 25
    max_lost_percent: int = 30


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_fails(line: Column, rules: RuleSet) -> Column:
    """Verdict on one line; a line without a word never fails."""
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    n = count(WORD)
    punctuation = (100 * count(SYMBOLS) > rules.symbol_percent * n) | (
        100 * count(r"[!?]{2,}") > rules.bang_percent * n
    )
    navigation = 100 * count(r"(?:^|[\x20\x09-\x0D])[|›»•·]") > rules.separator_percent * n
    boilerplate = (n <= rules.boilerplate_words) & line.rlike(BOILERPLATE)
    return (n > 0) & (punctuation | navigation | boilerplate)


def clean_text(text: Column, rules: RuleSet) -> Column:
    return F.array_join(F.filter(_lines(text), lambda line: ~line_fails(line, rules)), "\n")


def repeated_words(text: Column) -> Column:
    """Words inside a window of three words that occurs twice or more in the text."""
    words = F.array_remove(F.split(text, SPACE, -1), "")

    def windows(w: Column) -> Column:
        n = F.size(w)
        return F.when(
            n >= 3,
            F.transform(
                F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0))),
                lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    def starts(h: Column) -> Column:
        """Positions of the windows found more than once, by sorting (window, position)."""
        sorted_pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            s,
            lambda e, j: F.coalesce(e["h"] == F.get(s, j + 1)["h"], F.lit(False))
            | F.coalesce(e["h"] == F.get(s, j - 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(let(sorted_pairs, twice), lambda e: e["i"]))

    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x,
    )
    count = lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), let(starts(h), covered)
    ).otherwise(F.lit(0).cast("bigint"))
    return let(words, lambda w: let(windows(w), count))


def judge(docs: DataFrame, rules: RuleSet = RuleSet(), text: str = "text") -> DataFrame:
    """(doc, counts, verdict, cleaned text) of every row, all input columns inside ``doc``."""
    t = F.col("t")
    rows = docs.select(F.struct("*").alias("doc"), whole(F.col(text)).alias("t"))
    lines = F.filter(_lines(t), lambda line: line.rlike(WORD))
    rows = rows.select(
        "doc",
        "t",
        n_words(t).alias("n_words"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(t).alias("n_repeat_words"),
        clean_text(t, rules).alias("clean"),
    )
    rows = rows.withColumn("n_clean_words", n_words(F.col("clean"))).withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words)
        | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
    )
    lost = F.col("n_words") - F.col("n_clean_words")
    return rows.withColumn("kept", ~F.col("base_failed") & (100 * lost <= rules.max_lost_percent * F.col("n_words"))).drop("t")


def passing(docs: DataFrame, rules: RuleSet = RuleSet(), text: str = "text") -> DataFrame:
    """The rows that pass, with cleaned texts and otherwise the columns they came with."""
    kept = judge(docs, rules, text).where("kept")
    cols = [F.col("clean").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    out = kept.select(*cols)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType))
    return out


@query(
    "op10_quality_rules",
    r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
    win AS (
        SELECT rid, i, list_slice(w, i, i + 2) AS g
        FROM w, unnest(range(1, len(w) - 1)) AS u(i)
    ),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
    rep AS (
        SELECT rid, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid
    ),
    ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d),
    lc AS (
        SELECT rid, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
            len(regexp_extract_all(l, '[#*$%&|<>]')) AS sym,
            len(regexp_extract_all(l, '[!?]{2,}')) AS bang,
            len(regexp_extract_all(l, '(?:^|[\x20\x09-\x0D])[|›»•·]')) AS sep
        FROM ln
    ),
    la AS (
        SELECT rid, sum(CASE WHEN 100 * sym > 30 * n OR 100 * bang > 20 * n OR 100 * sep > 20 * n
                OR (n <= 25 AND regexp_matches(l, '(?i)all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|enable javascript|lorem ipsum|^ *(this work is )?(licensed|released) under |^ *(copyright|©|\(c\)) '))
                THEN n ELSE 0 END) AS lost,
            count(*) FILTER (WHERE n > 0) - count(DISTINCT l) FILTER (WHERE n > 0) AS n_dup_lines
        FROM lc GROUP BY rid
    ),
    base AS (
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words,
            length(regexp_replace(w.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
            len(regexp_extract_all(w.t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            la.n_dup_lines::BIGINT AS n_dup_lines, coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words, la.lost
        FROM w JOIN la USING (rid) LEFT JOIN rep USING (rid)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= 30 * n_words AS kept
    FROM base
    """,
)
def op10_quality_rules(spark, sf_dir):
    return judge(documents(spark, sf_dir, "doc_id", "text")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
