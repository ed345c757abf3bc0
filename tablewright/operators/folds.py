"""Cross-validation splits as a fold column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import draw
from tablewright.operators.lookup import lookup
from tablewright.operators.ranking import positioned


def _order(row_id: str, seed: int | None) -> list[Column]:
    """By row id, or by a seeded draw with the row id on ties."""
    return [F.col(row_id)] if seed is None else [draw("fold", seed, F.col(row_id)), F.col(row_id)]


def _segments(df: DataFrame, row_id: str, seed: int | None, starts: Sequence[int], out: str) -> DataFrame:
    """Number of the segment a row falls in, when the ordered rows are cut at the given positions.

    Only the ids are ordered. The few keys at the cuts come back as literals,
    so the full rows are not moved.
    """
    order = _order(row_id, seed)
    ids = df.select(*[c.alias(f"_o{i}") for i, c in enumerate(order)])
    names = ids.columns
    placed = positioned(ids, names, pos="_p")
    cuts = placed.where(F.col("_p").isin([int(s) for s in starts])).collect()
    segment = F.lit(0)
    for cut in cuts:
        later = order[-1] >= cut[names[-1]]
        if len(order) == 2:
            later = (order[0] > cut[names[0]]) | ((order[0] == cut[names[0]]) & later)
        segment = segment + later.cast("int")
    return df.withColumn(out, segment)


def kfold(df: DataFrame, row_id: str, k: int, shuffle: bool = False, seed: int = 1, out: str = "fold") -> DataFrame:
    """Contiguous folds in id order, or in a seeded random order; the first n % k hold one row more."""
    n = df.count()
    starts = [i * (n // k) + min(i, n % k) for i in range(1, k)]
    return _segments(df, row_id, seed if shuffle else None, starts, out)


def _within_class(df: DataFrame, row_id: str, label: str, seed: int | None) -> DataFrame:
    """Rows with their place in their class; only ids and labels are ordered and written."""
    placed = positioned(df.select(row_id, label), [F.col(label), *_order(row_id, seed)], pos="_p")
    spans = placed.groupBy(label).agg(F.min("_p").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    same = placed[label].eqNullSafe(spans[label])
    placed = lookup(placed, spans, same, "inner").select(
        F.col(row_id).alias("_id"), (F.col("_p") - F.col("_lo")).alias("_p"), "_n"
    )
    return df.join(placed, df[row_id] == F.col("_id")).drop("_id")


def stratified(df: DataFrame, row_id: str, label: str, k: int, seed: int | None = None, out: str = "fold") -> DataFrame:
    """Every class is dealt round robin over the folds."""
    return _within_class(df, row_id, label, seed).withColumn(out, (F.col("_p") % k).cast("int")).drop("_p", "_n")


def stratified_shuffle(df: DataFrame, row_id: str, label: str, test: float = 0.1, seed: int = 1, out: str = "is_test") -> DataFrame:
    """One random split with the same test share in every class."""
    placed = _within_class(df, row_id, label, seed)
    return placed.withColumn(out, F.col("_p") < F.round(F.col("_n") * test)).drop("_p", "_n")


def shuffle_split(df: DataFrame, row_id: str, train: float, seed: int = 1, out: str = "is_train") -> DataFrame:
    """A random share of the rows for training."""
    cut = _segments(df, row_id, seed, [round(train * df.count())], "_s")
    return cut.withColumn(out, F.col("_s") == 0).drop("_s")


def repeated_shuffles(
    df: DataFrame, row_id: str, label: str, n_iter: int, test: float = 0.1, seed: int = 1
) -> DataFrame:
    """(row_id, split, is_test): ``n_iter`` independent stratified splits, one row per row and split.

    All splits come from one global order of ids.
    """
    rows = df.select(row_id, label, F.explode(F.sequence(F.lit(1), F.lit(n_iter))).alias("split"))
    drawn = rows.withColumn("_u", draw("split", seed, F.col("split"), F.col(row_id)))
    placed = positioned(drawn, ["split", label, "_u", row_id], pos="_p")
    spans = placed.groupBy("split", label).agg(F.min("_p").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    out = placed.join(spans.withColumnRenamed("split", "_s").withColumnRenamed(label, "_l"),
                      (F.col("split") == F.col("_s")) & F.col(label).eqNullSafe(F.col("_l")))
    return out.select(row_id, "split", (F.col("_p") - F.col("_lo") < F.round(F.col("_n") * test)).alias("is_test"))
