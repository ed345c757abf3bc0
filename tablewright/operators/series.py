"""Date-indexed series: one row per calendar day.

The tables here are already aggregated to one row per date, so their size is
bounded by the calendar (a century has 36,525 days) and does not grow with
the facts. A window over all dates is safe for that reason only; series with
more rows go through ``ewma``, which windows over blocks of bounded length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.lookup import lookup
from tablewright.operators.ranking import positioned


def outer_align(series: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of several series on their date."""
    out = series[0]
    for s in series[1:]:
        out = out.join(s, key, "full_outer")
    return out


def inner_align(series: Sequence[DataFrame], key: str) -> DataFrame:
    out = series[0]
    for s in series[1:]:
        out = out.join(s, key)
    return out


def _order(key: str):
    return Window.orderBy(key)


def lagged(df: DataFrame, key: str, col: str, k: int) -> Column:
    return F.lag(col, k).over(_order(key))


def delay_line(df: DataFrame, key: str, cols: Sequence[str], lags: Sequence[int], fill: float = 0.0) -> DataFrame:
    """One more column per series and lag; where the series has not started yet the fill value."""
    w = _order(key)
    return df.select(
        "*", *[F.coalesce(F.lag(c, k).over(w), F.lit(fill)).alias(f"{c}_lag{k}") for c in cols for k in lags]
    )


def diff(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    w = _order(key)
    return df.select(key, *[(F.col(c) - F.lag(c).over(w)).alias(c) for c in cols])


def rolling_mean(df: DataFrame, key: str, cols: Sequence[str], n: int) -> DataFrame:
    """Trailing mean over n rows, null unless all n are present."""
    w = _order(key).rowsBetween(-(n - 1), 0)
    return df.select(key, *[F.when(F.count(c).over(w) == n, F.avg(c).over(w)).alias(c) for c in cols])


def shift_with_seed(df: DataFrame, key: str, col: str, seed: float, std: float, mean: float) -> DataFrame:
    """Shift down by one, put the seed first, and undo a standardisation."""
    prev = F.lag(F.col(col)).over(_order(key))
    first = F.row_number().over(_order(key)) == 1
    return df.select(key, (F.when(first, F.lit(seed)).otherwise(prev) * std + mean).alias(col))


def ewma(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], span: int, block: int = 512) -> DataFrame:
    """Adjusted exponentially weighted means, whatever the length of one key's series.

    sum((1-a)^i x) / sum((1-a)^i) with a = 2 / (span + 1); the columns are
    replaced. Rows get a position in their series and fall into blocks of
    fixed length. Inside a block the sum is a running total of x * r^-k scaled
    back by r^k, and every block receives the decayed end values of the blocks
    before it, as far back as they matter in double precision. ``order`` must
    be unique within a key, and the values must not be null.
    """
    keys = list(keys)
    r = 1.0 - 2.0 / (span + 1.0)
    if r <= 0:  # only the latest value counts
        return df
    block = max(block, 4 * int(span))  # so that a block is fed by few before it, however long the span
    while block > 1 and r ** (2 * block) < 1e-250:
        block //= 2
    reach = 1
    while r ** (block * reach) > 1e-18:
        reach += 1
    placed = positioned(df, [*keys, order], pos="_p")
    if keys:
        first = placed.groupBy(*keys).agg(F.min("_p").alias("_lo"))
        placed = lookup(placed, first, keys, "inner").withColumn("_p", F.col("_p") - F.col("_lo")).drop("_lo")
    placed = placed.withColumns({"_b": F.floor(F.col("_p") / block), "_k": F.col("_p") % block})
    grow, decay = F.pow(F.lit(1.0 / r), F.col("_k")), F.pow(F.lit(r), F.col("_k"))
    w = Window.partitionBy(*keys, "_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumns({f"_n{i}": F.sum(F.col(c) * grow).over(w) * decay for i, c in enumerate(cols)})
    # end value of a block by itself, decayed to the first row of the next one
    fade = F.pow(F.lit(r), F.lit(float(block)) - F.col("_k"))
    ends = placed.groupBy(*keys, "_b").agg(*[F.sum(F.col(c) * fade).alias(f"_e{i}") for i, c in enumerate(cols)])
    # one row per block with what it receives: each end feeds the next ``reach`` blocks
    fed = ends.withColumn("_s", F.explode(F.sequence(F.lit(1), F.lit(reach))))
    weight = F.pow(F.lit(r**block), F.col("_s") - 1)
    carry = fed.groupBy(*keys, (F.col("_b") + F.col("_s")).alias("_b")).agg(
        *[F.sum(F.col(f"_e{i}") * weight).alias(f"_c{i}") for i in range(len(cols))]
    )
    out = out.join(carry, [*keys, "_b"], "left")
    weights = (1.0 - F.pow(F.lit(r), F.col("_p") + 1)) / (1.0 - r)
    means = {
        c: (F.col(f"_n{i}") + F.coalesce(F.col(f"_c{i}"), F.lit(0.0)) * decay) / weights for i, c in enumerate(cols)
    }
    return out.withColumns(means).select(*df.columns)


def pair_dispersion(wide: DataFrame, stations: Sequence[str]) -> DataFrame:
    """Variance of the difference of two series for each pair of stations.

    ``wide`` has one column per station; the station list is fixed, so every
    pair is one aggregate of a single scan and no rows are paired up.
    """
    names = list(stations)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    row = wide.agg(
        *[
            F.struct(
                F.lit(a).alias("a"),
                F.lit(b).alias("b"),
                F.count(F.col(a) - F.col(b)).alias("n"),
                F.var_pop(F.col(a) - F.col(b)).alias("dispersion"),
            ).alias(f"p{k}")
            for k, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.explode(F.array(*[f"p{k}" for k in range(len(pairs))])).alias("_p")).select("_p.*")


def _pair_sums(block: int):
    """Counts, sums and squared sums of differences for the pairs of two station blocks, from their (date, station) values."""

    def matrices(part: pd.DataFrame, dates: int) -> tuple[np.ndarray, np.ndarray]:
        values, there = np.zeros((dates, block)), np.zeros((dates, block))
        at = part["_date"].to_numpy(), part["_pos"].to_numpy() % block
        values[at], there[at] = part["_x"].to_numpy(), 1.0
        return values, there

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["_i"].iloc[0]), int(rows["_j"].iloc[0])
        rows["_date"], names = pd.factorize(rows["_when"])
        x, p = matrices(rows[rows["_pos"] // block == i], len(names))
        y, q = matrices(rows[rows["_pos"] // block == j], len(names))
        n = p.T @ q
        total = x.T @ q - p.T @ y
        squares = (x * x).T @ q + p.T @ (y * y) - 2.0 * (x.T @ y)
        a, b = np.nonzero(np.triu(n, 1) if i == j else n)
        sums = {"n": n[a, b].astype(np.int64), "total": total[a, b], "squares": squares[a, b]}
        return pd.DataFrame({"_a": a + i * block, "_b": b + j * block, **sums})

    return run


def station_dispersion(
    values: DataFrame,
    when: str,
    station: str,
    value: str,
    places: DataFrame | None = None,
    block: int = 128,
    parts: int = 8,
) -> DataFrame:
    """(a, b, n, distance, dispersion): variance (ddof 0) of the difference of two stations' series over common dates.

    ``values`` are long rows, at most one per date and station; rows with a
    null in any of the three columns say nothing. Stations are numbered by name
    and dealt into blocks of ``block``; each value goes to the block pairs its
    block is in, and matrix products over the dates give the counts and sums of
    all pairs of two blocks at once, in ``parts`` shares of the dates. A group
    is at most 2 * block stations by its share of the calendar, and neither
    stations nor values come to the driver (one number does). Pairs have a < b
    by name; pairs without a common date are left out.

    ``places`` (station, x, y; one row each) adds the Euclidean distance, null
    where a place is not known or not given.
    """
    rows = values.select(F.col(when).alias("_when"), F.col(station).alias("_s"), F.col(value).cast("double").alias("_x")).na.drop()
    # differences are taken of centred values, as large common levels would cost digits
    named = positioned(rows.groupBy("_s").agg(F.avg("_x").alias("_mean")), ["_s"], pos="_pos")
    blocks = (named.count() + block - 1) // block
    own, other = F.floor(F.col("_pos") / block).cast("int"), F.col("_other")
    placed = lookup(rows, named, ["_s"], "inner").select(
        "_when", (F.col("_x") - F.col("_mean")).alias("_x"), "_pos", F.pmod(F.xxhash64("_when"), F.lit(parts)).alias("_part"),
        F.explode(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0)))).alias("_other"),
    )
    dealt = placed.select("_when", "_x", "_pos", "_part", F.least(own, other).alias("_i"), F.greatest(own, other).alias("_j"))
    sums = dealt.groupBy("_i", "_j", "_part").applyInPandas(
        _pair_sums(block), "_a bigint, _b bigint, n bigint, total double, squares double"
    )
    pairs = sums.groupBy("_a", "_b").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    n, mean = F.col("n"), F.col("total") / F.col("n")
    # the station means moved every difference of a pair by the same amount
    pairs = pairs.select("_a", "_b", "n", F.greatest(F.lit(0.0), F.col("squares") / n - mean * mean).alias("dispersion"))
    x, y = F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y")
    sites = named.select("_s", "_pos", x, y)
    if places is not None:
        known = places.select(F.col(station).alias("_s"), F.col("x").cast("double"), F.col("y").cast("double"))
        sites = lookup(named.select("_s", "_pos"), known, ["_s"])
    for end in "ab":
        site = sites.select(F.col("_pos").alias(f"_{end}"), F.col("_s").alias(end), F.col("x").alias(f"_x{end}"), F.col("y").alias(f"_y{end}"))
        pairs = lookup(pairs, site, [f"_{end}"], "inner")
    apart = F.sqrt(F.pow(F.col("_xa") - F.col("_xb"), 2) + F.pow(F.col("_ya") - F.col("_yb"), 2))
    return pairs.select("a", "b", "n", apart.alias("distance"), "dispersion")
