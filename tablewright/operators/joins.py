"""Joins between tables and between rows.

No side is forced to broadcast: Spark measures the sides at run time and
broadcasts only below its threshold, and splits hot partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import draw
from tablewright.operators.ranking import positioned, ring_next


def left_join(df: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Left outer join to the wanted columns of a dimension table."""
    return df.join(dim.select(key, *cols), key, "left")


def left_join_default(df: DataFrame, factor: DataFrame, key: str, col: str, default: float = 1.0) -> DataFrame:
    return left_join(df, factor, key, [col]).withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def semi_join_on_values(
    train: DataFrame, test: DataFrame | Mapping[str, DataFrame], cols: Sequence[str]
) -> DataFrame:
    """Training rows that share a value with the test rows in any of the columns.

    Nulls in the test column count as 0; a null training key never matches.
    A mapping gives each column test rows of its own.
    Rows are read once and marked per column by a join with its distinct
    values, so every row comes out once.
    """
    rows = train.select(F.struct("*").alias("_row"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    hit = F.lit(False)
    for i, c in enumerate(cols):
        found = test[c] if isinstance(test, Mapping) else test
        values = found.select(F.coalesce(F.col(c), F.lit(0)).alias(f"_c{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        rows = rows.join(values, f"_c{i}", "left")
        hit = hit | F.coalesce(f"_hit{i}", F.lit(False))
    return rows.where(hit).select("_row.*")


def column_bind(blocks: Sequence[DataFrame], row_id: str) -> DataFrame:
    """Feature blocks side by side on an explicit row id."""
    out = blocks[0]
    for b in blocks[1:]:
        out = out.join(b, row_id)
    return out


def pair_totals(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number of ordered row pairs (i != j) per group and their mean squared value difference.

    Sum over pairs of (a - b)^2 is 2 (n * sum(x^2) - sum(x)^2), so two partial
    sums per group replace the pairs. Values are centred on the overall mean
    first to keep the difference well conditioned.
    """
    shift = df.agg(F.avg(value)).first()[0] or 0.0
    x = F.col(value) - F.lit(float(shift))
    sums = df.groupBy(*keys).agg(
        F.count(value).alias("_n"), F.sum(x).alias("_s"), F.sum(x * x).alias("_q")
    )
    pairs = F.col("_n") * (F.col("_n") - 1)
    squares = 2 * (F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s"))
    return sums.select(*keys, pairs.alias("pairs"), F.try_divide(squares, pairs).alias("mean_sq_diff"))


def convex_combinations(df: DataFrame, group: Sequence[str], row_id: str, vec: str, k: int, partners: int = 1) -> DataFrame:
    """k synthetic rows per row and partner in its group: a*A + (1-a)*B if a > 0.5, else A.

    A and B are scaled by a draw around 1. Partners are the next rows of the
    group, closed to a ring: with one less than the group has, they are all
    ordered pairs; with fewer, large groups stay linear.
    """
    both = ring_next(df, group, row_id, [vec], partners).withColumn("kk", F.explode(F.sequence(F.lit(1), F.lit(k))))
    pair = F.col(row_id), F.col(f"{row_id}_b"), F.col("kk")
    drawn = both.select(
        row_id,
        F.col(f"{row_id}_b"),
        "kk",
        draw("convex", *pair).alias("_a"),
        (F.lit(1.0) + (draw("scale a", *pair) - 0.5) / 5).alias("_ra"),
        (F.lit(1.0) + (draw("scale b", *pair) - 0.5) / 5).alias("_rb"),
        F.col(vec).alias("_va"),
        F.col(f"{vec}_b").alias("_vb"),
    )
    a = F.col("_a")
    mixed = F.zip_with(
        "_va",
        "_vb",
        lambda x, y: F.when(a > 0.5, a * F.col("_ra") * x + (1 - a) * F.col("_rb") * y).otherwise(
            F.col("_ra") * x
        ),
    )
    return drawn.select(row_id, f"{row_id}_b", "kk", mixed.alias(vec))


def mixup(df: DataFrame, positive: Column, negative: Column, row_id: str, vec: str, n: int, seed: int = 1) -> DataFrame:
    """n extra positives pos + U/2 * neg, both drawn with replacement from the original rows."""
    pos = positioned(df.where(positive).select(row_id, vec), [row_id], pos="_ip")
    neg = positioned(df.where(negative).select(row_id, vec), [row_id], pos="_in")
    n_pos, n_neg = pos.count(), neg.count()
    if not n_pos or not n_neg:
        return df.select(F.col(row_id).alias("src"), F.col(row_id).alias("neg"), F.lit(0).alias("seq"), vec).limit(0)
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("seq"),
        F.floor(draw("positive", seed, F.col("id")) * n_pos).alias("_ip"),
        F.floor(draw("negative", seed, F.col("id")) * n_neg).alias("_in"),
        draw("share", seed, F.col("id")).alias("_u"),
    )
    left = pos.select("_ip", F.col(row_id).alias("src"), F.col(vec).alias("_vp"))
    right = neg.select("_in", F.col(row_id).alias("neg"), F.col(vec).alias("_vn"))
    return draws.join(left, "_ip").join(right, "_in").select(
        "src", "neg", "seq", F.zip_with("_vp", "_vn", lambda a, b: a + F.col("_u") / 2 * b).alias(vec)
    )


def repeat_rows(df: DataFrame, k: int, out: str = "copy") -> DataFrame:
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(k))))
