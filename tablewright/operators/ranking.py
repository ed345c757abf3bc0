"""Global order without a single-task window.

``positioned`` range-partitions the rows by a *unique* order key (so no key
can be hot), fixes the result with a checkpoint, and adds the number of rows
in earlier partitions. ``ranked_values`` first folds equal values into one
counted row, which removes skew from repeated values. Medians, ranks, codes
and folds are all built on these two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.lookup import lookup, lookup_codes
from tablewright.session import durable

_LOCAL = (1 << 33) - 1  # row number part of monotonically_increasing_id


def positioned(
    df: DataFrame,
    order: Sequence[str | Column],
    pos: str = "pos",
    weight: str | None = None,
    before: str = "before",
) -> DataFrame:
    """Add the 0-based global position; with ``weight`` also the weight of all earlier rows."""
    placed = durable(df.sort(*order).withColumn("_mid", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_mid", 33))
    w = F.col(weight) if weight else F.lit(1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.sum(w).alias("_weight"))
    # one row per partition of the sorted data, so this window and broadcast stay tiny
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"),
        F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_woff"),
    )
    out = placed.join(F.broadcast(offsets), "_part").withColumn(
        pos, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOCAL))
    )
    if weight:
        local = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(before, F.col("_woff") + F.coalesce(F.sum(weight).over(local), F.lit(0)))
    return out.drop("_mid", "_part", "_off", "_woff")


def ranked_values(df: DataFrame, cols: Sequence[str], *extra: Column) -> DataFrame:
    """Distinct values with n (rows), pos (dense 0-based code) and before (rows that sort earlier)."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"), *extra)
    return positioned(counted, list(cols), weight="n")


def grouped_median(df: DataFrame, keys: Sequence[str], col: str, out: str = "median") -> DataFrame:
    """Exact median of the non-null values per group; rows with a null key belong to no group."""
    keys = list(keys)
    ok = F.col(col).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    ranked = ranked_values(df.where(ok).select(*keys, F.col(col).alias("_x")), [*keys, "_x"])
    spans = ranked.groupBy(*keys).agg(F.min("before").alias("_base"), F.sum("n").alias("_total"))
    lo = F.col("_base") + F.floor((F.col("_total") - 1) / 2)
    hi = F.col("_base") + F.floor(F.col("_total") / 2)
    holds = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
    return (
        lookup(ranked, spans, keys, "inner")
        .where(holds(lo) | holds(hi))
        .groupBy(*keys)
        .agg(((F.max(F.when(holds(lo), F.col("_x"))) + F.max(F.when(holds(hi), F.col("_x")))) / 2).alias(out))
    )


def melt(df: DataFrame, cols: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Long (feature, value) rows of the given numeric columns."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
        ).alias("_c")
    ).select(f"_c.{name}", f"_c.{value}")


def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Medians of whole columns: one number per column reaches the driver."""
    rows = grouped_median(melt(df, cols), ["feature"], "value").collect()
    return {r["feature"]: r["median"] for r in rows}


def rank_fraction(df: DataFrame, col: str, out: str = "rank_fraction") -> DataFrame:
    """Average rank (ties share it) over the number of all rows, nulls included; null stays null."""
    values = ranked_values(df, [col])
    # nulls sort first, so they precede every value without ranking before it
    rows, nulls = values.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col(col).isNull(), F.col("n"))), F.lit(0))
    ).first()
    rank = F.col("before") - F.lit(nulls) + (F.col("n") + 1) / 2
    ranked = values.where(F.col(col).isNotNull()).select(col, (rank / F.lit(float(max(rows, 1)))).alias(out))
    return lookup_codes(df, ranked, col)


def fit_codes(train: DataFrame, col: str) -> DataFrame:
    """Codes by sorted value. Nulls sort as -1, so real codes start at 1 when the column has any."""
    values = ranked_values(train.select(col), [col])
    has_null = train.where(F.col(col).isNull()).limit(1).count() > 0
    # the null row sorts first and takes position 0, which shifts the others by one
    return values.where(F.col(col).isNotNull()).select(
        col, F.col("pos").cast("bigint").alias("code"), F.lit(has_null).alias("had_null")
    )


def apply_codes(df: DataFrame, codes: DataFrame, col: str, out: str = "code", default: int = -1) -> DataFrame:
    """Lookup of fitted codes; null and unseen values give ``default``."""
    model = codes.select(col, F.col("code").alias(out))
    return lookup_codes(df, model, col).withColumn(out, F.coalesce(F.col(out), F.lit(default).cast("bigint")))


def group_ids(df: DataFrame, cols: Sequence[str], out: str = "group_id") -> DataFrame:
    """0-based id of the sorted distinct tuple."""
    ids = ranked_values(df, cols).select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(cols)], F.col("pos").alias(out)
    )
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return lookup(df, ids, same, "inner").drop(*[f"_g{i}" for i in range(len(cols))])


def first_seen_codes(df: DataFrame, row_id: str, combos: dict[str, Sequence[str]], min_occurs: int) -> DataFrame:
    """Long (row_id, combo, code): one shared dictionary over all column combinations.

    Codes count from 1 in the order in which a key first appears (combination
    by combination, rows in row_id order within each); rare keys give -1.
    """
    entries = [
        F.struct(
            F.lit(i).alias("combo_no"),
            F.lit(name).alias("combo"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols]).alias("key"),
        )
        for i, (name, cols) in enumerate(combos.items())
    ]
    long = df.select(row_id, F.explode(F.array(*entries)).alias("_e")).select(row_id, "_e.*")
    seen = long.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("combo_no"), F.col(row_id))).alias("first")
    )
    # the code counts every key in the dictionary, rare ones included
    coded = positioned(seen, [F.col("first")], pos="_pos")
    model = coded.select(
        "key", F.when(F.col("n") >= min_occurs, F.col("_pos") + 1).otherwise(F.lit(-1)).cast("bigint").alias("code")
    )
    return lookup(long, model, "key", "inner").select(row_id, "combo", "code")


def ring_next(df: DataFrame, group: Sequence[str], order: str, carry: Sequence[str], partners: int = 1) -> DataFrame:
    """Each row next to its ``partners`` successors in the group, which is closed to a ring.

    At most ``partners`` output rows per input row, whatever the group size; a
    row is not its own partner. Only group and order, which must be unique, are
    sorted; the carried columns join at the end.
    """
    group = list(group)
    placed = positioned(df.select(*group, order), [*group, order], pos="_p")
    spans = placed.groupBy(*group).agg(F.min("_p").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    placed = lookup(placed, spans, group, "inner")
    steps = F.explode(F.sequence(F.lit(1), F.lit(partners))).alias("_k")
    left = placed.select("*", steps).where(F.col("_k") < F.col("_n"))
    left = left.withColumn("_q", F.col("_lo") + (F.col("_p") - F.col("_lo") + F.col("_k")) % F.col("_n"))
    right = placed.select(F.col("_p").alias("_q"), F.col(order).alias(f"{order}_b"))
    pairs = left.join(right, "_q").select(*group, order, f"{order}_b")
    values = df.select(order, *carry)
    others = df.select(F.col(order).alias(f"{order}_b"), *[F.col(c).alias(f"{c}_b") for c in carry])
    return pairs.join(values, order).join(others, f"{order}_b")
