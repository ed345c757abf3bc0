"""Column expressions over ``array<double>`` cells.

Everything here stays inside one row: no shuffle, no Python workers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A plain alias may be inlined by the optimiser into a lambda and then be
    evaluated once per array element; a lambda variable never is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def doubles(arr: Column | str) -> Column:
    return F.col(arr).cast("array<double>") if isinstance(arr, str) else arr.cast("array<double>")


def total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def mean(arr: Column) -> Column:
    return F.try_divide(total(arr), F.size(arr).cast("double"))


def central_sum(arr: Column, centre: Column, power: int) -> Column:
    def step(acc: Column, x: Column) -> Column:
        d = x - centre
        term = d
        for _ in range(power - 1):
            term = term * d
        return acc + term

    return F.aggregate(arr, F.lit(0.0), step)


def moments(arr: Column) -> Column:
    """Struct(mean, std, skew, kurt): population std, skewness, excess kurtosis."""

    def with_mean(m: Column) -> Column:
        raw = F.struct(
            m.alias("m"),
            (central_sum(arr, m, 2) / F.size(arr)).alias("m2"),
            (central_sum(arr, m, 3) / F.size(arr)).alias("m3"),
            (central_sum(arr, m, 4) / F.size(arr)).alias("m4"),
        )
        return let(
            raw,
            lambda s: F.struct(
                s["m"].alias("mean"),
                F.sqrt(s["m2"]).alias("std"),
                F.try_divide(s["m3"], s["m2"] * F.sqrt(s["m2"])).alias("skew"),
                (F.try_divide(s["m4"], s["m2"] * s["m2"]) - 3.0).alias("kurt"),
            ),
        )

    return let(mean(arr), with_mean)


def mean_std(arr: Column) -> Column:
    """Struct(m, sd) with the population standard deviation."""
    return let(
        mean(arr),
        lambda m: F.struct(m.alias("m"), F.sqrt(central_sum(arr, m, 2) / F.size(arr)).alias("sd")),
    )


def standardise_row(arr: Column) -> Column:
    """(x - mean) / std per cell; a flat row gives nulls."""
    return let(
        mean_std(arr),
        lambda s: F.transform(arr, lambda x: F.try_divide(x - s["m"], s["sd"])),
    )


def minmax_row(arr: Column) -> Column:
    bounds = F.struct(F.array_min(arr).alias("lo"), F.array_max(arr).alias("hi"))
    return let(
        bounds,
        lambda b: F.transform(arr, lambda x: F.try_divide(x - b["lo"], b["hi"] - b["lo"])),
    )


def contrast_normalise(arr: Column, bias: float = 10.0, use_std: bool = True, floor: float = 1e-8) -> Column:
    """Centre a row and divide by sqrt(bias + variance) (or by the norm of the centred row)."""

    def scale(s: Column) -> Column:
        spread = s["sd"] * s["sd"] if use_std else s["sd"] * s["sd"] * F.size(arr)
        norm = F.sqrt(F.lit(bias) + spread)
        norm = F.when(norm < floor, F.lit(1.0)).otherwise(norm)
        return let(norm, lambda d: F.transform(arr, lambda x: (x - s["m"]) / d))

    return let(mean_std(arr), scale)


def trend_removed(arr: Column, window: int) -> Column:
    """x_i minus the mean of the last ``window`` values up to and including x_i."""
    at = lambda i: F.slice(
        arr, F.greatest(i - window + 1, F.lit(0)) + 1, F.least(i + 1, F.lit(window))
    )
    return F.transform(arr, lambda x, i: x - mean(at(i)))


def circular_mean3(arr: Column) -> Column:
    """Three-point mean on a closed ring, all cells smoothed at the same time."""
    n = F.size(arr)
    return F.transform(
        arr,
        lambda x, i: (arr[F.pmod(i - 1, n)] + x + arr[F.pmod(i + 1, n)]) / 3.0,
    )


def fit_length(arr: Column, n: int) -> Column:
    """Longer: centred cut of ``n``; shorter: zeros appended."""
    size = F.size(arr)
    start = F.floor((size - n) / 2).cast("int") + 1
    return F.when(size >= n, F.slice(arr, F.greatest(start, F.lit(1)), n)).otherwise(
        F.concat(arr, F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - size, F.lit(0))))
    )


def frames(arr: Column, block: int, step: int) -> Column:
    """Overlapping blocks, ceil(n / step) of them, the last ones padded with zeros."""
    count = F.ceil(F.size(arr) / step).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: fit_length(F.slice(arr, k * step + 1, block), block),
    )


def pick(arr: Column, index: Sequence[int]) -> Column:
    """Cells at constant positions."""
    return F.transform(F.array(*[F.lit(int(i)) for i in index]), lambda i: F.get(arr, i))


def patch_index(height: int, width: int, top: int, left: int, ph: int, pw: int) -> list[int]:
    """Flat positions of a patch in a row-major page."""
    return [(top + r) * width + left + c for r in range(ph) for c in range(pw)]


def centre_crop(arr: Column, height: int, width: int, side: int) -> Column:
    return pick(arr, patch_index(height, width, (height - side) // 2, (width - side) // 2, side, side))


def argmax(arr: Column) -> Column:
    """0-based position of the largest cell, first one on ties."""
    return F.array_position(arr, F.array_max(arr)).cast("int") - 1


def median(arr: Column) -> Column:
    """Median of the non-null cells of one row."""
    kept = F.array_sort(F.filter(arr, lambda x: x.isNotNull()))
    return let(
        kept,
        lambda s: F.when(
            F.size(s) > 0,
            (
                F.get(s, F.floor((F.size(s) - 1) / 2).cast("int"))
                + F.get(s, F.floor(F.size(s) / 2).cast("int"))
            )
            / 2.0,
        ),
    )


def blend_classes(arr: Column, classes: int) -> Column:
    """Mean per class of several models' outputs laid end to end."""
    own = lambda k: F.filter(arr, lambda x, i: i % classes == k)
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: mean(own(k)))


def affine(arr: Column, shift: float, scale: float) -> Column:
    return F.transform(arr, lambda x: (x - shift) / scale)


def one_hot(cls: Column, n: int, base: int = 0) -> Column:
    """Class number to an n-cell 0/1 array; ``base`` is the smallest class."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.when(i + base == cls, F.lit(1)).otherwise(F.lit(0)),
    )


def peak_trough(arr: Column, level: float = 1.5) -> Column:
    """Alternating peaks and troughs on a standardised ring: the smaller count.

    A trough ends when the curve climbs back over -level, a peak when it falls
    back under +level. They count only when they alternate, a trough first.
    """

    def step(s: Column, x: Column) -> Column:
        left_trough = s["trough"] & (x >= -level) & (s["last"] == 2)
        last = F.when(left_trough, F.lit(1)).otherwise(s["last"])
        left_peak = s["peak"] & (x <= level) & (last == 1)
        return F.struct(
            (x < -level).alias("trough"),
            (x > level).alias("peak"),
            F.when(left_peak, F.lit(2)).otherwise(last).alias("last"),
            (s["nt"] + left_trough.cast("int")).alias("nt"),
            (s["np"] + left_peak.cast("int")).alias("np"),
        )

    start = F.struct(
        F.lit(True).alias("trough"),
        F.lit(False).alias("peak"),
        F.lit(2).alias("last"),
        F.lit(0).alias("nt"),
        F.lit(0).alias("np"),
    )
    return F.aggregate(arr, start, step, lambda s: F.least(s["nt"], s["np"]))
