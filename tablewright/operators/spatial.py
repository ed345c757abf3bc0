"""Points, grids and boxes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.lookup import lookup
from tablewright.operators.ranking import positioned
from tablewright.session import durable


@dataclass(frozen=True)
class Extent:
    lo: tuple[float, float]
    hi: tuple[float, float]

    @property
    def diagonal(self) -> float:
        return math.dist(self.lo, self.hi)


def extent(points: DataFrame, x: str = "x", y: str = "y") -> Extent:
    r = points.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    return Extent((r[0], r[1]), (r[2], r[3]))


# ---- variogram

_ROWS = 16


def _pair_histogram(edges: np.ndarray, step: float | None, steps: int):
    """Counts and squared value differences per (distance, direction) bin of two point blocks."""
    bins = len(edges) - 1
    size, small = bins * steps, np.uint8 if max(bins, steps) < 256 else np.uint32
    turns = [(math.cos((m + 0.5) * step), math.sin((m + 0.5) * step)) for m in range(steps)] if step else []

    def directions(dx: np.ndarray, dy: np.ndarray, dist: np.ndarray) -> np.ndarray:
        """Direction bins by the side of each bin's edge; angles only for what lies on an edge."""
        low, out, side, other = np.full(dx.shape, np.inf), np.zeros(dx.shape, small), np.empty_like(dx), np.empty_like(dx)
        for cos, sin in turns:
            np.subtract(np.multiply(dx, cos, out=side), np.multiply(dy, sin, out=other), out=side)
            out += (side >= 0).view(np.uint8)
            np.minimum(low, np.abs(side, out=side), out=low)
        out = np.where(dx < 0, small(steps) - out, out)  # the semicircle only
        out[out == steps] = 0
        edge = np.nonzero(low <= 1e-9 * dist)
        if len(edge[0]):
            theta = np.arctan2(dx[edge], dy[edge])
            theta = np.where(theta < 0, theta + math.pi, theta)
            theta = np.where(theta >= math.pi - step / 2, 0.0, theta)
            out[edge] = np.minimum(np.floor((theta + step / 2) / step).astype(int), steps - 1)
        return out

    def one(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        n, s = np.zeros(size, np.int64), np.zeros(size)
        for at in range(0, len(a), _ROWS):  # so many rows at once stay in the cache
            (ax, ay, az), (bx, by, bz) = a[at : at + _ROWS].T[:, :, None], (b[at:] if same else b).T[:, None, :]
            dx, dy = bx - ax, by - ay
            dist = np.sqrt(dx * dx + dy * dy)
            d = np.zeros(dist.shape, small)
            for edge in edges[1:]:
                d += (dist >= edge).view(np.uint8)
            d[np.isnan(dist)] = bins
            if same:
                d[:, : len(d)][np.tri(len(d), dtype=bool)] = bins
            if step is not None:
                d = d.astype(np.int32) * steps + directions(dx, dy, dist)
            d = d.reshape(-1).astype(np.intp)
            n += np.bincount(d, minlength=size + steps)[:size]
            s += np.bincount(d, weights=((bz - az) ** 2).reshape(-1), minlength=size + steps)[:size]
        return n, s

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s = np.zeros(bins * steps), np.zeros(bins * steps)
        stack = lambda cell: np.asfortranarray([[p["x"], p["y"], p["z"]] for p in cell], float)
        for pdf in batches:
            for left, right, same in zip(pdf["left"], pdf["right"], pdf["same"]):
                a = stack(left)
                # the other copy of a block may hold its points in another order
                cn, cs = one(a, a if same else stack(right), bool(same))
                n, s = n + cn, s + cs
        hit = np.nonzero(n)[0]
        yield pd.DataFrame(
            {"dbin": hit // steps, "tbin": hit % steps, "n": n[hit].astype("int64"), "sq": s[hit]}
        )

    return run


def variogram(
    points: DataFrame,
    bins: int = 10,
    max_frac: float = 0.5,
    theta_step: float | None = None,
    sample: float = 1.0,
    seed: int = 1,
    block: int = 1024,
) -> DataFrame:
    """Semivariance of z by distance bin (and direction bin) of the points (id, x, y, z).

    Bins have equal width up to max_frac of the bounding box diagonal; the last
    one is open and not reported. The pairs are never formed as rows: points
    are cut into spatial cells as wide as the largest reported distance, full
    cells into blocks of about ``block`` points by a hash of the id, and each
    task folds two blocks into one small histogram. Cells too far apart are
    never compared.
    """
    if sample < 1:
        points = points.sample(withReplacement=True, fraction=sample, seed=seed)
    if theta_step and 360 % theta_step:
        raise ValueError("360 must be a multiple of theta_step")
    box = extent(points)
    max_d = box.diagonal * max_frac
    edges = np.linspace(0.0, max_d, bins + 1)[:-1]  # the open last bin is dropped
    cut, tol = float(edges[-1]), box.diagonal / bins
    steps = int(180 / theta_step) if theta_step else 1
    step = math.radians(theta_step) if theta_step else None

    celled = points.select(
        "id", "x", "y", "z",
        F.floor((F.col("x") - box.lo[0]) / cut).alias("cx"),
        F.floor((F.col("y") - box.lo[1]) / cut).alias("cy"),
    )
    cells = celled.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    salted = lookup(celled, cells, ["cx", "cy"], "inner").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("parts")))
    key = ["cx", "cy", "salt"]
    blocks = salted.groupBy(*key).agg(F.collect_list(F.struct("x", "y", "z")).alias("pts"))

    names = cells.select("cx", "cy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)).alias("salt"))
    # each unordered pair of neighbouring cells once
    half = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in [(0, 0), (1, -1), (1, 0), (1, 1), (0, 1)]])
    left = names.select(*[F.col(c).alias(f"l_{c}") for c in key], F.explode(half).alias("_o"))
    right = names.select(*[F.col(c).alias(f"r_{c}") for c in key])
    inside = (F.col("_o.a") != 0) | (F.col("_o.b") != 0) | (F.col("l_salt") <= F.col("r_salt"))
    todo = left.join(
        right,
        (F.col("l_cx") + F.col("_o.a") == F.col("r_cx")) & (F.col("l_cy") + F.col("_o.b") == F.col("r_cy")),
    ).where(inside)
    same = (F.col("l_cx") == F.col("r_cx")) & (F.col("l_cy") == F.col("r_cy")) & (F.col("l_salt") == F.col("r_salt"))
    side = lambda p: blocks.select(*[F.col(c).alias(f"{p}_{c}") for c in key], F.col("pts").alias(p))
    loaded = todo.join(side("l"), [f"l_{c}" for c in key]).join(side("r"), [f"r_{c}" for c in key])
    partial = loaded.select(F.col("l").alias("left"), F.col("r").alias("right"), same.alias("same")).mapInPandas(
        _pair_histogram(edges, step, steps), "dbin bigint, tbin bigint, n bigint, sq double"
    )
    width = max_d / bins
    return (
        partial.groupBy("dbin", "tbin")
        .agg(F.sum("n").alias("n"), F.sum("sq").alias("sq"))
        .select(
            F.col("dbin").cast("int").alias("dbin"),
            F.col("tbin").cast("int").alias("tbin"),
            ((F.col("dbin") + 1) * width + tol / 2).alias("distance"),
            "n",
            (F.col("sq") / (2 * F.col("n"))).alias("gamma"),
        )
    )


# ---- gridded forecasts


def daily_mean_sum(grid: DataFrame, last_hour: int = 24, scale: float = 3600.0 * 3) -> DataFrame:
    """Sum over the hours of a member, then the mean over members, scaled, per date and cell."""
    hours = grid.where(F.col("fhour") <= last_hour)
    members = hours.groupBy("dt", "ens", "lat", "lon").agg(F.sum("value").alias("v"))
    return members.groupBy("dt", "lat", "lon").agg((F.avg("v") * scale).alias("value"))


def grid_to_station(grid: DataFrame, stations: DataFrame, size: float = 1.0) -> DataFrame:
    """Inverse squared distance mean of the enclosing grid cells at each station and date."""
    base = lambda c: F.floor(F.col(c) / size)
    offs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    corners = stations.withColumn("_o", F.explode(offs)).select(
        "stid", F.col("lat").alias("slat"), F.col("lon").alias("slon"),
        (base("lat") + F.col("_o.a")).alias("_i"), (base("lon") + F.col("_o.b")).alias("_j"),
    )
    cells = grid.select("dt", "lat", "lon", "value", base("lat").alias("_i"), base("lon").alias("_j"))
    dlat, dlon = F.col("slat") - F.col("lat"), F.col("slon") - F.col("lon")
    d2 = dlat * dlat + dlon * dlon
    w = F.try_divide(F.lit(1.0), d2)
    near = cells.join(corners, ["_i", "_j"]).withColumns({"_w": w, "_hit": F.when(d2 == 0, F.col("value"))})
    return near.groupBy("dt", "stid").agg(
        F.coalesce(F.max("_hit"), F.sum(F.col("_w") * F.col("value")) / F.sum(F.when(F.col("value").isNotNull(), F.col("_w")))).alias("value")
    )


# ---- height grids


def neighbour_diff(cells: DataFrame, x: str = "x", y: str = "y", h: str = "h") -> DataFrame:
    """Difference to the previous cell along x and along y, by an equi-join on the cell."""
    left = cells.select((F.col(x) + 1).alias(x), y, F.col(h).alias("_hx"))
    below = cells.select(x, (F.col(y) + 1).alias(y), F.col(h).alias("_hy"))
    out = cells.join(left, [x, y], "left").join(below, [x, y], "left")
    return out.withColumns({"dx": F.col(h) - F.col("_hx"), "dy": F.col(h) - F.col("_hy")}).drop("_hx", "_hy")


def fill_rate(cells: DataFrame) -> DataFrame:
    """Share of the enclosing box that is neither gap nor empty space below the top."""
    s = cells.agg(
        F.count(F.lit(1)).alias("n"), F.max("h").alias("top"), F.sum("h").alias("h"), F.sum("gap").alias("g")
    )
    volume = F.col("n") * F.col("top")
    # every height is at most the top, so the absolute gaps to it add up to n * top - sum(h)
    empty = F.col("g") + volume - F.col("h")
    return s.select(F.try_divide((volume - empty).cast("double"), volume.cast("double")).alias("fill_rate"))


def surface_objective(cells: DataFrame, depth: int = 500) -> DataFrame:
    """mean^2 + variance + total neighbour steps + cells + 8 * gaps, heights cut ``depth`` above the lowest."""
    low = cells.agg(F.min("h")).first()[0]
    cut = cells.withColumn("h", F.least(F.lit(0), F.col("h") - F.lit(low + depth)))
    s = neighbour_diff(cut).agg(
        F.avg("h").alias("m"), F.var_samp("h").alias("v"),
        F.sum(F.coalesce(F.abs("dx"), F.lit(0)) + F.coalesce(F.abs("dy"), F.lit(0))).alias("steps"),
        F.count(F.lit(1)).alias("n"), F.sum("gap").alias("g"),
    )
    return s.select(
        (F.col("m") * F.col("m") + F.col("v") + F.col("steps") + F.col("n") + 8 * F.col("g")).alias("objective")
    )


# ---- boxes


def order_score(boxes: DataFrame) -> DataFrame:
    """2 * top + sum |rank - id| when boxes are ranked from the top down, ids ascending on ties."""
    tops = boxes.select("id", F.greatest("z1", "z2").alias("top"))
    ranked = positioned(tops, [F.col("top").desc(), F.col("id")])
    return ranked.agg(
        (2 * F.max("top") + F.sum(F.abs(F.col("pos") + 1 - F.col("id")))).cast("bigint").alias("score")
    )


_ENDS = [f"{a}_{e}" for a in "xyz" for e in ("lo", "hi")]


def _extents(boxes: DataFrame) -> DataFrame:
    """(id, lowest and highest corner); a box with an unknown corner overlaps none and is left out."""
    known = F.lit(True)
    for c in (f"{a}{k}" for a in "xyz" for k in (1, 2)):
        known = known & F.col(c).isNotNull()
    pick = {"lo": F.least, "hi": F.greatest}
    ends = [pick[e](f"{a}1", f"{a}2").cast("double").alias(f"{a}_{e}") for a in "xyz" for e in ("lo", "hi")]
    return boxes.where(known).select("id", *ends)


def _hits(extents: DataFrame) -> DataFrame:
    """Corners of the boxes that overlap another one, several times perhaps.

    Equal boxes are one row with their smallest and largest id. Boxes are
    sorted into levels of a grid by their longest side, so each
    covers at most eight cells of its level. It is put into those, and into
    the cells it touches on every coarser level in use. Two boxes that overlap
    share a cell on the coarser of their levels, whatever their sizes, and
    each only has to find one partner. The cells are many times the boxes,
    which Spark's estimate does not show, so it must not send them round.
    """
    kinds = durable(extents.groupBy(*_ENDS).agg(F.min("id").alias("first"), F.max("id").alias("last")))
    side = F.greatest(*[F.col(f"{a}_hi") - F.col(f"{a}_lo") for a in "xyz"], F.lit(2.0**-30))
    ends = kinds.withColumn("own", F.ceil(F.log2(side)).cast("int"))
    # one number per power of two that occurs as a size
    levels = sorted(r["own"] for r in ends.select("own").distinct().collect() if r["own"] is not None)
    placed = ends.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).where("level >= own")
    for a in "xyz":
        at = lambda e: F.floor(F.col(f"{a}_{e}") / F.pow(F.lit(2.0), F.col("level")))  # noqa: E731, B023
        placed = placed.withColumn(a, F.explode(F.sequence(at("lo"), at("hi"))))
    cell = ["level", "x", "y", "z"]
    names = [*_ENDS, "first", "last", "own"]
    sides = [placed.select(*cell, *[F.col(c).alias(f"{s}_{c}") for c in names]).hint("merge") for s in "ab"]
    a, b = sides[0].where("level = a_own"), sides[1]
    same = F.lit(True)
    for c in cell:
        same = same & (a[c] == b[c])
    apart = F.least("a_first", "b_first") == F.greatest("a_last", "b_last")  # one id only
    for c in "xyz":
        apart = apart | (F.col(f"a_{c}_lo") > F.col(f"b_{c}_hi")) | (F.col(f"b_{c}_lo") > F.col(f"a_{c}_hi"))
    larger, smaller = a.join(b, same & ~apart, "left_semi"), b.join(a, same & ~apart, "left_semi")
    hits = kinds.where("first <> last").select(*_ENDS)
    for s, found in (("a", larger), ("b", smaller)):
        hits = hits.unionByName(found.select(*[F.col(f"{s}_{c}").alias(c) for c in _ENDS]))
    return hits


def overlapping_boxes(boxes: DataFrame) -> DataFrame:
    """(id, overlaps) for closed boxes with any corners."""
    extents = _extents(boxes)
    hit = extents.join(_hits(extents).distinct().hint("merge"), _ENDS, "left_semi").select("id").distinct()
    hit = hit.withColumn("_hit", F.lit(True))
    return boxes.select("id").join(hit.hint("merge"), "id", "left").select("id", F.coalesce("_hit", F.lit(False)).alias("overlaps"))


def any_overlap(boxes: DataFrame) -> DataFrame:
    """One row: does any pair of boxes overlap."""
    return _hits(_extents(boxes)).limit(1).agg((F.count(F.lit(1)) > 0).alias("any_overlap"))


# Which corner (1 or 2) each axis takes in the eight output points.
CORNER_ORDER = ["111", "112", "122", "121", "221", "211", "212", "222"]


def box_corners(boxes: DataFrame) -> DataFrame:
    """Two opposite corners to eight, in the fixed output order."""
    pts = [
        F.struct(
            F.lit(k + 1).alias("corner"),
            *[F.col(f"{axis}{side}").alias(axis) for axis, side in zip("xyz", code)],
        )
        for k, code in enumerate(CORNER_ORDER)
    ]
    return boxes.select("id", F.explode(F.array(*pts)).alias("_p")).select("id", "_p.*")


def orientation_order(height: Column, length: Column, width: Column) -> Column:
    """Orientations 1..6, flattest first.

    Each side owns two orientations (height 1 and 2, length 3 and 4, width 5
    and 6) and the sides go by size. Ties go height, length, width, except
    that length comes before height behind a strictly smallest width.
    """
    width_first = width < F.least(height, length)
    side = lambda size, tie, first: F.struct(
        size.cast("double").alias("size"), tie.alias("tie"), F.lit(first).alias("o")
    )
    sides = F.array_sort(
        F.array(
            side(height, F.when(width_first, F.lit(3)).otherwise(F.lit(0)), 1),
            side(length, F.lit(1), 3),
            side(width, F.lit(2), 5),
        )
    )
    return F.flatten(F.transform(sides, lambda s: F.array(s["o"], s["o"] + 1)))


def shift_to_positive(boxes: DataFrame) -> DataFrame:
    """z becomes z - min z + 1."""
    low = boxes.agg(F.least(F.min("z1"), F.min("z2"))).first()[0]
    return boxes.withColumns({c: F.col(c) - F.lit(low) + 1 for c in ("z1", "z2")})
