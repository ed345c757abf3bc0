"""Turning categories and text into numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.clean import frequent_values
from tablewright.operators.lookup import lookup
from tablewright.operators.ranking import positioned
from tablewright.session import written

#: Runs of two or more letters, digits or underscores, in any script.
TOKEN = r"[\p{L}\p{M}\p{N}_]{2,}"

#: Columns that a table of dummies may have.
MOST_DUMMIES = 5000


def long_categories(df: DataFrame, row_id: str, cols: Sequence[str], *keep: str) -> DataFrame:
    """(row_id, feature, value) rows."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    return df.select(row_id, *keep, F.explode(F.array(*entries)).alias("_e")).select(row_id, *keep, "_e.*")


def target_encode(df: DataFrame, row_id: str, cols: Sequence[str], target: str, prior: float = 0.5) -> DataFrame:
    """(row_id, feature, value, encoded): mean target per category, unlabelled rows counting as the prior."""
    long = long_categories(df, row_id, cols, target)
    means = long.groupBy("feature", "value").agg(
        F.avg(F.coalesce(F.col(target).cast("double"), F.lit(prior))).alias("encoded")
    )
    return lookup(long.drop(target), means, ["feature", "value"], "inner")


def fit_one_hot(train: DataFrame, cols: Sequence[str], threshold: int = 0) -> DataFrame:
    """Vocabulary (feature, value, idx): categories seen more often than the threshold."""
    kept = frequent_values(train, cols, threshold).where(F.col("value").isNotNull())
    return positioned(kept, ["feature", "value"], pos="idx").select("feature", "value", "idx")


def one_hot_long(df: DataFrame, row_id: str, vocabulary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(row_id, idx) of the cells that are 1; unseen categories give none."""
    return lookup(long_categories(df, row_id, cols), vocabulary, ["feature", "value"], "inner").select(row_id, "idx")


def one_hot_wide(df: DataFrame, vocabulary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Dummy columns named col=value in place of the categorical ones; for many categories see ``one_hot_long``."""
    rows = vocabulary.orderBy("idx").limit(MOST_DUMMIES + 1).collect()
    if len(rows) > MOST_DUMMIES:
        raise ValueError(f"more than {MOST_DUMMIES} dummy columns; use one_hot_long")
    dummies = [
        F.coalesce((F.col(r["feature"]).cast("string") == r["value"]).cast("int"), F.lit(0)).alias(
            f"{r['feature']}={r['value']}"
        )
        for r in rows
    ]
    return df.select(*[c for c in df.columns if c not in cols], *dummies)


def tokens(text: Column, pattern: str = TOKEN) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def term_counts(docs: DataFrame, key: str, text: str, stop: Sequence[str] = (), pattern: str = TOKEN) -> DataFrame:
    """(key, term, n) over whole texts."""
    terms = docs.select(key, F.explode(tokens(F.col(text), pattern)).alias("term"))
    if stop:
        terms = terms.where(~F.col("term").isin(list(stop)))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def document_frequency(docs: DataFrame, key: str, text: str, min_df: int, stop: Sequence[str] = ()) -> DataFrame:
    """(term, df) of the terms found in at least ``min_df`` documents."""
    terms = docs.select(F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))
    if stop:
        terms = terms.where(~F.col("term").isin(list(stop)))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)


def bag_of_words(docs: DataFrame, key: str, text: str, min_df: int, stop: Sequence[str] = ()) -> DataFrame:
    """(key, term, n) for the terms kept by document frequency.

    The texts are cut into words once: both the vocabulary and the result read
    the written counts. These are many times the vocabulary, so they are not sorted for the join.
    """
    counts = written(term_counts(docs, key, text, stop))
    vocabulary = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    return counts.join(vocabulary.select("term").hint("shuffle_hash"), "term", "left_semi")


def anova_f(df: DataFrame, vec: str, label: str) -> DataFrame:
    """One-way F statistic of each vector cell against the class: (i, f)."""
    per = df.select(label, F.posexplode(vec).alias("i", "x")).groupBy("i", label).agg(
        F.count("x").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")
    )
    tot = per.groupBy("i").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"),
    )
    between = F.col("b") - F.col("s") * F.col("s") / F.col("n")
    within = F.col("q") - F.col("b")
    f = F.try_divide(between / (F.col("k") - 1), within / (F.col("n") - F.col("k")))
    return tot.select("i", f.alias("f"))


def select_k_best(train: DataFrame, vec: str, label: str, k: int) -> list[int]:
    """Positions of the k cells with the largest F, smaller position on ties."""
    best = anova_f(train, vec, label).orderBy(F.col("f").desc_nulls_last(), "i").limit(k)
    return sorted(r["i"] for r in best.collect())
