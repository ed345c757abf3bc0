"""Selecting, filling, clipping and scaling columns.

Every fitted operator has a ``fit_*`` that reduces a training table to a few
numbers per column and an ``apply_*`` that uses them as literals, so applying
is a projection without a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.lookup import lookup
from tablewright.operators.ranking import column_medians, grouped_median, melt


def split_by(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and rows where it is false; null goes to neither."""
    return df.where(cond), df.where(~cond)


def row_slice(df: DataFrame, row_id: str, start: int, stop: int, closed: bool = False) -> DataFrame:
    """Rows with start <= row_id < stop (<= stop when closed)."""
    upper = F.col(row_id) <= stop if closed else F.col(row_id) < stop
    return df.where((F.col(row_id) >= start) & upper)


def deviation(x: str | Column, ddof: int = 1) -> Column:
    """Standard deviation, exactly 0 if all values are equal.

    Partial means of equal values may differ in their last digit, and the
    merged deviation is then a little above 0.
    """
    std = F.stddev_samp(x) if ddof else F.stddev_pop(x)
    return F.when(F.min(x) < F.max(x), std).otherwise(std * 0.0)


def drop_constant_columns(train: DataFrame, cols: Sequence[str]) -> list[str]:
    """Names of the columns that vary on the training rows."""
    row = train.agg(*[deviation(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > 0]


def group_median_fill(
    df: DataFrame, keys: Sequence[str], col: str, out: str | None = None, rounded: bool = False
) -> DataFrame:
    """Null cells take the median of their group; a null group key leaves the cell as it is."""
    med = grouped_median(df, keys, col, "_med")
    fill = F.round("_med") if rounded else F.col("_med")
    return lookup(df, med, list(keys)).withColumn(out or col, F.coalesce(F.col(col), fill)).drop("_med")


def hierarchical_median_fill(
    df: DataFrame, levels: Sequence[Sequence[str]], col: str, limit: float = 100.0, out: str | None = None
) -> DataFrame:
    """Null or too large values take the median of good values, level by level, then overall.

    Each level works on the column as the previous level left it.
    """
    out = out or col
    cur = df.withColumn(out, F.col(col))
    for keys in levels:
        good = F.when(F.col(out) <= limit, F.col(out))
        cur = cur.withColumn("_good", good)
        med = grouped_median(cur, keys, "_good", "_med")
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        # a row without a group keeps its value
        filled = F.when(known, F.coalesce(F.col("_good"), F.col("_med"))).otherwise(F.col(out))
        cur = lookup(cur, med, list(keys)).withColumn(out, filled).drop("_good", "_med")
    overall = column_medians(cur, [out]).get(out)
    return cur.withColumn(out, F.coalesce(F.col(out), F.lit(overall)))


def global_median_replace(df: DataFrame, col: str, limit: float | None = None, out: str | None = None) -> DataFrame:
    """Nulls (and values over ``limit``) take the column median, taken with the outliers in place."""
    med = column_medians(df, [col]).get(col)
    bad = F.col(col).isNull() if limit is None else F.col(col).isNull() | (F.col(col) > limit)
    return df.withColumn(out or col, F.when(bad, F.lit(med)).otherwise(F.col(col)))


@dataclass(frozen=True)
class Scale:
    """Centre and spread per column."""

    centre: Mapping[str, float]
    spread: Mapping[str, float]


def fit_standardise(train: DataFrame, cols: Sequence[str], ddof: int = 1) -> Scale:
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[deviation(c, ddof).alias(f"s_{c}") for c in cols]
    ).first()
    return Scale({c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols})


def fit_minmax(train: DataFrame, cols: Sequence[str]) -> Scale:
    row = train.agg(
        *[F.min(c).alias(f"a_{c}") for c in cols], *[F.max(c).alias(f"b_{c}") for c in cols]
    ).first()
    lo = {c: row[f"a_{c}"] for c in cols}
    hi = {c: row[f"b_{c}"] for c in cols}
    return Scale(lo, {c: None if lo[c] is None else hi[c] - lo[c] for c in cols})


def apply_scale(df: DataFrame, model: Scale) -> DataFrame:
    """(x - centre) / spread; a zero spread gives null."""
    return df.withColumns(
        {c: F.try_divide(F.col(c) - F.lit(m), F.lit(model.spread[c])) for c, m in model.centre.items()}
    )


@dataclass(frozen=True)
class CellScale:
    """Centre and spread per position of a vector."""

    centre: tuple[float, ...]
    spread: tuple[float, ...]


def fit_cells(train: DataFrame, vec: str, how: str = "std", ddof: int = 0) -> CellScale:
    """Mean and std, or minimum and range, of every vector position; one row per position is read."""
    cells = train.select(F.posexplode(vec).alias("i", "x"))
    stats = (F.avg("x"), deviation("x", ddof)) if how == "std" else (F.min("x"), F.max("x") - F.min("x"))
    rows = cells.groupBy("i").agg(stats[0].alias("c"), stats[1].alias("s")).orderBy("i").collect()
    return CellScale(tuple(r["c"] for r in rows), tuple(r["s"] for r in rows))


def apply_cells(df: DataFrame, vec: str, model: CellScale) -> DataFrame:
    """(x - centre) / spread per position; a zero spread gives null."""
    centre = F.array(*map(F.lit, model.centre)).cast("array<double>")
    spread = F.array(*map(F.lit, model.spread)).cast("array<double>")
    centred = F.zip_with(vec, centre, lambda x, m: x - m)
    return df.withColumn(vec, F.zip_with(centred, spread, lambda x, s: F.try_divide(x, s)))


def winsorise(df: DataFrame, cols: Sequence[str], factor: float = 3.0) -> DataFrame:
    """Values farther than factor * std (population) from the mean move to that bound."""
    s = fit_standardise(df, cols, ddof=0)

    def bounded(c: str) -> Column:
        m, half = s.centre[c], s.spread[c]
        if m is None:
            return F.col(c)
        lo, hi = m - factor * half, m + factor * half
        return F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))

    return df.withColumns({c: bounded(c) for c in cols})


@dataclass(frozen=True)
class Pool:
    """Quasi-constant columns with their median and the mean and std of the other cells."""

    columns: tuple[str, ...]
    median: Mapping[str, float]
    mean: Mapping[str, float]
    std: Mapping[str, float]


def _rest_stats(df: DataFrame, cols: Sequence[str], med: Mapping[str, float]) -> tuple[dict, dict]:
    rest = {c: F.when(F.col(c) != F.lit(med[c]), F.col(c)) for c in cols}
    row = df.agg(
        *[F.avg(e).alias(f"m_{c}") for c, e in rest.items()],
        *[deviation(e, 0).alias(f"s_{c}") for c, e in rest.items()],
    ).first()
    return {c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols}


def fit_pool(train: DataFrame, cols: Sequence[str]) -> Pool:
    """Pick the columns dominated by one value on the training rows.

    Share of cells equal to the median over 0.9, or over 0.75 with at least 4
    different values, or over 0.6 with at least 8.
    """
    med = column_medians(train, cols)
    counted = train.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg((F.col(c) == F.lit(med[c])).cast("double")).alias(f"share_{c}") for c in cols],
    ).first()
    long = melt(train, cols)
    uniques = {r["feature"]: r["u"] for r in long.distinct().groupBy("feature").agg(F.count("value").alias("u")).collect()}
    chosen = []
    for c in cols:
        share, u = counted[f"share_{c}"], uniques[c]
        if share > 0.9 or (share > 0.75 and u >= 4) or (share > 0.6 and u >= 8):
            chosen.append(c)
    if not chosen:
        return Pool((), {}, {}, {})
    mean, std = _rest_stats(train, chosen, med)
    return Pool(tuple(chosen), {c: med[c] for c in chosen}, mean, std)


def apply_pool(df: DataFrame, pool: Pool, out: str = "sft", refit_stats: bool = False) -> DataFrame:
    """Replace the pooled columns by the mean of their standardised non-median cells.

    ``refit_stats`` takes median, mean and std from ``df`` itself and keeps
    only the column list from the fit.
    """
    med, mean, std = pool.median, pool.mean, pool.std
    if refit_stats and pool.columns:
        med = column_medians(df, pool.columns)
        mean, std = _rest_stats(df, pool.columns, med)
    usable = [c for c in pool.columns if std[c] is not None and std[c] > 0]
    terms = [
        F.when(F.col(c) == F.lit(med[c]), F.lit(0.0)).otherwise((F.col(c) - mean[c]) / std[c]) for c in usable
    ]
    pooled = F.lit(None).cast("double")
    if terms:
        pooled = sum(terms[1:], terms[0]) / len(terms)
    return df.withColumn(out, pooled).drop(*pool.columns)


def frequent_values(df: DataFrame, cols: Sequence[str], threshold: int = 0) -> DataFrame:
    """(feature, value, n) for values seen strictly more often than the threshold."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    long = df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)
