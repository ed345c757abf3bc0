"""Pages stored as flat row-major arrays: patches, crops, profiles, variants."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.functions.scalar import draw


def _window(arr: Column, width: int, top: Column, left: Column, ph: int, pw: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(ph * pw - 1)),
        lambda k: F.get(arr, ((top + F.floor(k / pw)) * width + left + k % pw).cast("int")),
    )


def grid_patches(
    df: DataFrame, arr: str, shape: tuple[int, int], patch: tuple[int, int], stride: tuple[int, int], channels: int = 1
) -> DataFrame:
    """One row per regular patch, last axis fastest; the other columns repeat.

    Pages and patches have ``channels`` numbers a cell, channel fastest.
    """
    tops = range(0, shape[0] - patch[0] + 1, stride[0])
    lefts = range(0, shape[1] - patch[1] + 1, stride[1])
    spots = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in tops for c in lefts])
    out = df.select("*", F.posexplode(spots).alias("patch_no", "_s"))
    cut = _window(F.col(arr), shape[1] * channels, F.col("_s.r"), F.col("_s.c") * channels, patch[0], patch[1] * channels)
    return out.withColumn("patch", cut).drop("_s")


def random_patches(
    df: DataFrame, key: str, arr: str, shape: tuple[int, int], patch: tuple[int, int], n: int, min_std: float,
    seed: int = 1, channels: int = 1,
) -> DataFrame:
    """n patches whose std over all channels is over the threshold, from every page that has any.

    All positions of the page are put in a drawn order; the first n that pass
    are taken, over again from the first if there are fewer.
    """
    a = F.col(arr)
    places = F.array(
        *[F.struct(F.lit(r).alias("top"), F.lit(c).alias("left"))
          for r in range(shape[0] - patch[0]) for c in range(shape[1] - patch[1])]
    )
    order = F.sort_array(
        F.transform(
            places,
            lambda s: F.struct(
                draw("patch", seed, F.col(key), s["top"], s["left"]).alias("u"), s["top"].alias("top"),
                s["left"].alias("left"),
                _window(a, shape[1] * channels, s["top"], s["left"] * channels, patch[0], patch[1] * channels).alias("patch"),
            ),
        )
    )
    kept = F.filter(order, lambda s: A.mean_std(s["patch"])["sd"] > min_std)
    taken = A.let(
        kept,
        lambda k: F.when(
            F.size(k) > 0,
            F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(k, (i % F.size(k)).cast("int"))),
        ),
    )
    return df.select(key, F.posexplode(taken).alias("draw", "_p")).select(key, "draw", "_p.top", "_p.left", "_p.patch")


def crop_extent(arr: Column, shape: tuple[int, int], threshold: float, margin: int) -> Column:
    """Struct(top, bottom, left, right), inclusive: lines with std over the threshold plus a margin."""
    h, w = shape
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(h - 1)), lambda r: A.mean_std(F.slice(arr, r * w + 1, F.lit(w)))["sd"] > threshold
    )
    line = lambda c: F.transform(F.sequence(F.lit(0), F.lit(h - 1)), lambda r: F.get(arr, r * w + c))
    cols = F.transform(F.sequence(F.lit(0), F.lit(w - 1)), lambda c: A.mean_std(line(c))["sd"] > threshold)

    def ends(flags: Column, size: int) -> tuple[Column, Column]:
        first = F.array_position(flags, True).cast("int") - 1
        last = F.lit(size) - F.array_position(F.reverse(flags), True).cast("int")
        some = first >= 0
        return (
            F.when(some, F.greatest(first - margin, F.lit(0))),
            F.when(some, F.least(last + margin, F.lit(size - 1))),
        )

    def build(s: Column) -> Column:
        top, bottom = ends(s["rows"], h)
        left, right = ends(s["cols"], w)
        return F.struct(top.alias("top"), bottom.alias("bottom"), left.alias("left"), right.alias("right"))

    return A.let(F.struct(rows.alias("rows"), cols.alias("cols")), build)


def crop(arr: Column, shape: tuple[int, int], box: Column) -> Column:
    """Cells inside an inclusive extent."""
    w = shape[1]
    row, col = lambda i: F.floor(i / w), lambda i: i % w
    return F.filter(
        arr,
        lambda x, i: (row(i) >= box["top"]) & (row(i) <= box["bottom"]) & (col(i) >= box["left"]) & (col(i) <= box["right"]),
    )


def channel_offsets(arr: Column, channels: int) -> Column:
    """Mean of each channel minus the mean of all cells (channel is the fastest axis)."""
    own = lambda k: A.mean(F.filter(arr, lambda x, i: i % channels == k))
    return A.let(A.mean(arr), lambda m: F.transform(F.sequence(F.lit(0), F.lit(channels - 1)), lambda k: own(k) - m))


# Where the cross-sections and the two centre squares lie.
SECTIONS = (1 / 3, 2 / 5, 1 / 2, 3 / 5, 2 / 3)
INNER_SQUARE = (2 / 5, 3 / 5)
OUTER_SQUARE = (1 / 4, 3 / 4)
RADII = (5, 10, 15, 20, 30, 40, 50)
MOMENTS = ("mean", "std", "skew", "kurt")


def ring_index(h: int, w: int, r: int) -> list[int]:
    """Cells of a half circle of 5 r points in order of the angle; offsets count from the far edge."""
    theta = np.linspace(0.5 * math.pi, 1.5 * math.pi, 5 * r)
    rows = [int(v) for v in r * np.cos(theta) - w // 2]
    cols = [int(v) for v in r * np.sin(theta) - h // 2]
    return [(y % h) * w + (x % w) for y, x in zip(rows, cols)]


def profile_regions(h: int, w: int) -> dict[str, list[int]]:
    """Flat cell positions of the sections and squares of a page."""
    out = {}
    for k, f in enumerate(SECTIONS):
        out[f"col{k}"] = [r * w + int(w * f) for r in range(h)]
    for k, f in enumerate(SECTIONS):
        out[f"row{k}"] = [int(w * f) * w + c for c in range(w)]
    for name, (a, b) in (("inner", INNER_SQUARE), ("outer", OUTER_SQUARE)):
        lo, hi = int(w * a), int(w * b)
        out[name] = [r * w + c for r in range(lo, hi) for c in range(lo, hi)]
    return out


def profile_vector(arr: Column, h: int, w: int, radii: Sequence[int] = RADII) -> Column:
    """Numbers that describe a grey page.

    For each of mean, std, skewness and kurtosis: the page mean and that
    moment of five columns and five rows; then the four inner/outer square
    ratios in [0, 10]; four moments per ring; peaks per ring.
    """
    regions = profile_regions(h, w)
    names = list(regions)
    sections = [k for k, n in enumerate(names) if n not in ("inner", "outer")]
    inner, outer = names.index("inner"), names.index("outer")
    lists = [*regions.values(), *[ring_index(h, w, r) for r in radii]]
    index = F.array(*[F.array(*map(F.lit, cells)) for cells in lists])
    # one expression for all regions: each is read by position, then summarised
    cells = F.transform(index, lambda at: F.transform(at, lambda i: F.get(arr, i)))
    rings = F.slice(cells, len(names) + 1, len(radii))
    peaks = F.transform(rings, lambda c: A.peak_trough(A.standardise_row(A.circular_mean3(c))).cast("double"))
    parts = F.struct(A.mean(arr).alias("all"), F.transform(cells, A.moments).alias("m"))

    def build(s: Column) -> Column:
        out = []
        for m in MOMENTS:
            out += [s["all"], *[s["m"][k][m] for k in sections]]
        for m in MOMENTS:
            # least skips nulls, so a missing ratio would read as 10: the same value the rule asks for
            ratio = F.try_divide(s["m"][inner][m], s["m"][outer][m])
            out.append(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(10.0), ratio)), F.lit(10.0)))
        for k in range(len(radii)):
            out += [s["m"][len(names) + k][m] for m in MOMENTS]
        return F.array(*out)

    return F.concat(A.let(parts, build), peaks)


# Shares of red, green and blue in grey.
GREY = (0.299, 0.587, 0.114)


def grey_page(arr: Column, h: int, w: int, shares: Sequence[float] = GREY) -> Column:
    """One number per cell of a page whose channels are the fastest axis."""
    n = len(shares)
    cell = lambda k: sum((F.get(arr, k * n + c) * s for c, s in enumerate(shares[1:], 1)), F.get(arr, k * n) * shares[0])
    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)), cell)


def image_features(arr: Column, h: int, w: int, radii: Sequence[int] = RADII) -> Column:
    """Numbers that describe a page of three channels: its colour offsets, then the profile of its grey page.

    With the seven radii these are 86. A null page, or one with a null cell, gives nulls where that cell counts.
    """
    return F.concat(channel_offsets(arr, len(GREY)), A.let(grey_page(arr, h, w), lambda g: profile_vector(g, h, w, radii)))


# ---- training variants


def noise(arr: Column, key: Column, sigma: float = 0.1) -> Column:
    """Add normal noise from seeded draws and clip to [0, 1]."""

    def cell(x: Column, i: Column) -> Column:
        u1, u2 = draw("noise radius", key, i), draw("noise angle", key, i)
        z = F.sqrt(F.lit(-2.0) * F.log(u1 + F.lit(1.0 / 4294967296.0))) * F.cos(u2 * (2 * math.pi))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x + F.lit(sigma) * z))

    return F.transform(arr, cell)


def _bilinear(pages: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    n, h, w = pages.shape
    # outside the page there is nothing; within half a cell of its edge the edge cell holds
    inside = (rows >= -0.5) & (rows < h - 0.5) & (cols >= -0.5) & (cols < w - 0.5)
    rows, cols = np.clip(rows, 0, h - 1), np.clip(cols, 0, w - 1)
    r0, c0 = np.floor(rows).astype(int), np.floor(cols).astype(int)
    r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
    fr, fc = rows - r0, cols - c0
    k = np.arange(n)[:, None, None]
    top = pages[k, r0, c0] * (1 - fc) + pages[k, r0, c1] * fc
    low = pages[k, r1, c0] * (1 - fc) + pages[k, r1, c1] * fc
    return np.where(inside, top * (1 - fr) + low * fr, 0.0)


WARPS = ["angle", "shear_h", "shear_v", "top", "bottom", "left", "right", "azimuth", "elevation", "depth"]


def warp(df: DataFrame, key: str, arr: str, side: int) -> DataFrame:
    """Apply rotation (degrees), shears and cut edges (cells) per row to square pages, or light them from one side.

    ``df`` carries the parameters in the columns WARPS. A shear of 1 moves each
    line by one cell more than the one before, about the middle. Cells from
    outside the page are 0. Where ``depth`` is not 0, the page is a height map
    of values in [0, 1], lit from ``azimuth`` and ``elevation`` (degrees).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mid = (side - 1) / 2.0
        rr, cc = np.meshgrid(np.arange(side) - mid, np.arange(side) - mid, indexing="ij")
        for pdf in batches:
            if not len(pdf):
                continue
            pages = np.stack(pdf[arr].to_numpy()).reshape(-1, side, side).astype("float64")
            col = lambda c: pdf[c].to_numpy(dtype="float64")[:, None, None]
            a = np.radians(col("angle"))
            rows = np.cos(a) * rr + np.sin(a) * cc + col("shear_v") * cc
            cols = -np.sin(a) * rr + np.cos(a) * cc + col("shear_h") * rr
            high, wide = (side - col("top") - col("bottom")) / side, (side - col("left") - col("right")) / side
            rows = rows * high + (col("top") - col("bottom")) / 2
            cols = cols * wide + (col("left") - col("right")) / 2
            out = _bilinear(pages, rows + mid, cols + mid)
            slope = col("depth") * 255 / 100
            down, right = np.gradient(out, axis=1) * slope, np.gradient(out, axis=2) * slope
            e, z = np.radians(col("elevation")), np.radians(col("azimuth"))
            light = np.cos(e) * np.cos(z) * down + np.cos(e) * np.sin(z) * right + np.sin(e)
            lit = np.clip(light / np.sqrt(down**2 + right**2 + 1), 0, 1)
            out = np.where(col("depth") != 0, lit, out)
            yield pd.DataFrame(
                {key: pdf[key], "variant": pdf["variant"], arr: list(out.reshape(len(pdf), -1))}
            )

    return df.select(key, "variant", arr, *WARPS).mapInPandas(
        run, f"{key} bigint, variant string, {arr} array<double>"
    )


# Largest rotation and azimuth in degrees, shear, cells cut per edge, elevation in degrees, depth.
MAX_ANGLE, MAX_SHEAR, MAX_CUT, MAX_ELEVATION, DEPTH = 40, 1.0, 4, 60, 2.0


def augment_affine(df: DataFrame, key: str, arr: str, side: int, seed: int = 1) -> DataFrame:
    """Rotated, sheared, cut and lit copies of pages scaled to [0, 1], with parameters drawn per row and variant."""
    names = ["rotate", "shear_h", "shear_v", "cut", "emboss"]
    scaled = df.select(key, A.minmax_row(F.col(arr)).alias(arr))
    many = scaled.select(key, arr, F.explode(F.array(*map(F.lit, names))).alias("variant"))
    u = lambda what: draw(what, seed, F.col(key), F.col("variant"))
    whole = lambda what, lo, hi: F.floor(u(what) * (hi - lo + 1)) + lo
    only = lambda name, value: F.when(F.col("variant") == name, value.cast("double")).otherwise(F.lit(0.0))
    params = {
        "angle": only("rotate", whole("angle", -MAX_ANGLE, MAX_ANGLE)),
        "shear_h": only("shear_h", (u("shear") * 2 - 1) * MAX_SHEAR),
        "shear_v": only("shear_v", (u("shear") * 2 - 1) * MAX_SHEAR),
        **{edge: only("cut", whole(edge, 0, MAX_CUT)) for edge in ("top", "bottom", "left", "right")},
        "azimuth": only("emboss", whole("azimuth", -MAX_ANGLE, MAX_ANGLE)),
        "elevation": only("emboss", whole("elevation", 0, MAX_ELEVATION)),
        "depth": only("emboss", F.lit(DEPTH)),
    }
    return warp(many.withColumns(params), key, arr, side)


# ---- decision tree votes

# Fixed values: (first vote column, number of answers) of each question.
QUESTIONS = {
    1: (0, 3), 2: (3, 2), 3: (5, 2), 4: (7, 2), 5: (9, 4), 6: (13, 2),
    7: (15, 3), 8: (18, 7), 9: (25, 3), 10: (28, 3), 11: (31, 6),
}


def leaf_probabilities(votes: Column) -> Column:
    """159 leaf products from 37 vote columns.

    Votes of questions 7 and 9 as they are; then for each answer of question
    3: the spiral branch (question 4 yes) over questions 10, 11 and 5, and the
    other branch over question 5; last the third answer of question 1.
    """

    def raw(q: int) -> Column:
        first, n = QUESTIONS[q]
        return F.slice(votes, first + 1, n)

    def share(q: int) -> Column:
        return A.let(
            raw(q),
            lambda v: F.transform(v, lambda x: F.coalesce(F.try_divide(x, A.total(v)), F.lit(0.0))),
        )

    shares = F.struct(*[share(q).alias(f"s{q}") for q in (4, 5, 10, 11)])

    def build(s: Column) -> Column:
        def branch(a: Column) -> Column:
            spiral = F.flatten(
                F.transform(
                    s["s10"],
                    lambda b: F.flatten(
                        F.transform(s["s11"], lambda c: F.transform(s["s5"], lambda d: a * s["s4"][0] * b * c * d))
                    ),
                )
            )
            return F.concat(spiral, F.transform(s["s5"], lambda d: a * s["s4"][1] * d))

        return F.concat(raw(7), raw(9), F.flatten(F.transform(raw(3), branch)), F.array(votes[2]))

    return A.let(shares, build)


def odd_votes(votes: Column) -> Column:
    """The 8-column variant: one answer of question 6 and all of question 8, no products."""
    return F.concat(F.array(votes[14]), F.slice(votes, 19, 7))
