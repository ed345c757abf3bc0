"""Exact comparison of 64-bit fingerprints, tile by tile.

Distinct fingerprints are sorted by their population count, then by those of
their quarters, and packed into tiles of bounded size. Population counts that
differ by more than the radius rule out a pair, and so do quarter counts whose
differences add up to more, so a tile pair is skipped if its ranges are too
far apart; the remaining tile pairs are compared inside tasks with numpy's
exclusive-or and bit counts, block by block under the same rule. A task
emits a spanning forest of the links it finds, never all pairs of a dense
group: at most one link per fingerprint and tile pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import staged

TILE = 1 << 15
BLOCK = 256
_QUARTERS = [f"q{i}" for i in range(4)]


def bits(fp: Column) -> Column:
    return F.bit_count(fp)


def quarter_bits(fp: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, lowest first."""
    return np.bitwise_count(np.ascontiguousarray(fp).view(np.uint16).reshape(-1, 4)).astype(np.int16)


class Forest:
    """Union-find over array positions, with lookups for whole arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Joins the pairs (a, b); gives those that were not yet connected."""
        joined = []
        ra, rb = self.root[a], self.root[b]
        fresh = np.flatnonzero(ra != rb)
        if len(fresh):
            _, first = np.unique(np.stack([ra[fresh], rb[fresh]], 1), axis=0, return_index=True)
            for k in fresh[first]:
                x, y = self.find(int(a[k])), self.find(int(b[k]))
                if x != y:
                    self.root[max(x, y)] = min(x, y)
                    joined.append((int(a[k]), int(b[k])))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up
        return joined

    def find(self, i: int) -> int:
        while self.root[i] != i:
            i = int(self.root[i])
        return i


def close(x: np.ndarray, y: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in x, in y) of pairs within ``radius`` bits, block by block."""

    def ranges(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, at = quarter_bits(v), np.arange(0, len(v), BLOCK)
        return np.minimum.reduceat(q, at), np.maximum.reduceat(q, at)

    (xlo, xhi), (ylo, yhi) = ranges(x), ranges(y)
    for i in range(len(xlo)):
        gap = np.maximum(0, np.maximum(xlo[i] - yhi, ylo - xhi[i])).sum(1)
        for j in np.flatnonzero(gap <= radius):
            a, b = x[i * BLOCK : (i + 1) * BLOCK], y[j * BLOCK : (j + 1) * BLOCK]
            hit = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
            if len(hit[0]):
                yield hit[0] + i * BLOCK, hit[1] + j * BLOCK


def spanning(x: np.ndarray, y: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links (fingerprints as signed numbers) that connect what pairs within the radius connect."""
    forest, out, both = Forest(len(x) + (0 if same else len(y))), [], x if same else np.concatenate([x, y])
    for i, j in close(x, y, radius):
        out += forest.link(i, j if same else j + len(x))
    signed = both.view(np.int64)
    return [(int(signed[i]), int(signed[j])) for i, j in out]


def tiles(points: DataFrame, fp: str = "fp", size: int = TILE) -> DataFrame:
    """Staged (tile, pop and quarter ranges, fps) of the distinct fingerprints in ``points``."""
    quarter = lambda i: F.bit_count(F.shiftrightunsigned(F.col(fp), 16 * i).bitwiseAND(F.lit(0xFFFF)))
    ordered = (
        points.select(F.col(fp).alias("fp"))
        .distinct()
        .select("fp", bits(F.col("fp")).alias("pop"), *[quarter(i).alias(c) for i, c in enumerate(_QUARTERS)])
        .sort("pop", *_QUARTERS, "fp")
    )
    ends = ", ".join(f"{c}_lo int, {c}_hi int" for c in ["pop", *_QUARTERS])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            rows = batch.to_pandas()
            left = rows if left is None else _append(left, rows)
            while len(left) >= size:
                yield one(left.iloc[:size])
                left = left.iloc[size:]
        if left is not None and len(left):
            yield one(left)

    def one(rows) -> pa.RecordBatch:
        fps = rows["fp"].to_numpy(np.int64)
        cols = {"tile": [int(fps[0])], "fps": [fps.tobytes()]}
        for c in ["pop", *_QUARTERS]:
            cols[f"{c}_lo"], cols[f"{c}_hi"] = [int(rows[c].min())], [int(rows[c].max())]
        order = ["tile", *[f"{c}_{e}" for c in ["pop", *_QUARTERS] for e in ("lo", "hi")], "fps"]
        types = [pa.int64(), *[pa.int32()] * 10, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(cols[c], t) for c, t in zip(order, types)], order)

    return staged(ordered.mapInArrow(pack, f"tile bigint, {ends}, fps binary"), "tiles")


def _append(a, b):
    import pandas as pd

    return pd.concat([a, b], ignore_index=True)


def near_links(points: DataFrame, radius: int, fp: str = "fp", size: int = TILE) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect all pairs within ``radius`` bits.

    Tile pairs are made from the ranges alone, by an equality join on the
    population counts they can share; the packed fingerprints follow.
    """
    packed = tiles(points, fp, size)
    ends = ["tile", *[f"{c}_{e}" for c in ["pop", *_QUARTERS] for e in ("lo", "hi")]]
    index = packed.select(*ends)
    left = index.select(
        *[F.col(c).alias(f"l_{c}") for c in ends],
        F.explode(F.sequence(F.col("pop_lo") - radius, F.col("pop_hi") + radius)).alias("p"),
    )
    right = index.select(
        *[F.col(c).alias(f"r_{c}") for c in ends], F.explode(F.sequence("pop_lo", "pop_hi")).alias("p")
    )
    gap = lambda c: F.greatest(
        F.lit(0), F.col(f"l_{c}_lo") - F.col(f"r_{c}_hi"), F.col(f"r_{c}_lo") - F.col(f"l_{c}_hi")
    )
    within = (gap("q0") + gap("q1") + gap("q2") + gap("q3")) <= radius
    pairs = (
        left.join(right, "p")
        .where((F.col("l_tile") <= F.col("r_tile")) & (gap("pop") <= radius) & within)
        .select("l_tile", "r_tile")
        .distinct()
    )
    x, y = (packed.select(F.col("tile").alias(f"{s}_tile"), F.col("fps").alias(f"{s}_fps")) for s in "lr")
    return compare_tiles(pairs.join(x, "l_tile").join(y, "r_tile"), radius)


def compare_tiles(work: DataFrame, radius: int) -> DataFrame:
    """(a, b) links found in pairs of packed tiles (l_tile, r_tile, l_fps, r_fps)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                l_fps, r_fps = (np.frombuffer(batch[c][i].as_py(), np.uint64) for c in ("l_fps", "r_fps"))
                found = spanning(l_fps, r_fps, radius, batch["l_tile"][i].as_py() == batch["r_tile"][i].as_py())
                a, b = map(list, zip(*found)) if found else ([], [])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return work.select("l_tile", "r_tile", "l_fps", "r_fps").mapInArrow(compare, "a bigint, b bigint")
