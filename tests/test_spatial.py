import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins, spatial


def cloud(seed, n, same=0):
    rng = random.Random(seed)
    pts = [(i, rng.random(), rng.random(), rng.gauss(0, 1)) for i in range(n)]
    return pts + [(n + i, 0.25, 0.25, rng.gauss(0, 1)) for i in range(same)]


def brute(pts, bins, frac, step=None):
    xs, ys = [p[1] for p in pts], [p[2] for p in pts]
    full = math.hypot(max(xs) - min(xs), max(ys) - min(ys))
    width = full * frac / bins
    out = {}
    for a, b in itertools.combinations(pts, 2):
        d = int(math.hypot(b[1] - a[1], b[2] - a[2]) / width)
        if d >= bins - 1:
            continue
        t = 0
        if step:
            s = math.radians(step)
            th = math.atan2(b[1] - a[1], b[2] - a[2])
            th = th + math.pi if th < 0 else th
            th = 0.0 if th >= math.pi - s / 2 else th
            t = min(int((th + s / 2) / s), int(180 / step) - 1)
        n, q = out.get((d, t), (0, 0.0))
        out[d, t] = (n + 1, q + (b[3] - a[3]) ** 2)
    return {k: (n, q / (2 * n)) for k, (n, q) in out.items()}


@pytest.mark.parametrize("step,same,frac,block", [(None, 0, 0.5, 16), (30, 0, 0.2, 16), (None, 60, 0.1, 8), (45, 60, 0.5, 8)])
def test_variogram_equals_all_pairs(spark, step, same, frac, block):
    """Also with a third of all points on one spot, cut into many blocks."""
    pts = cloud(5, 120, same)
    df = spark.createDataFrame(pts, "id long, x double, y double, z double")
    out = spatial.variogram(df, bins=8, max_frac=frac, theta_step=step, block=block).collect()
    want = brute(pts, 8, frac, step)
    got = {(r["dbin"], r["tbin"]): (r["n"], r["gamma"]) for r in out}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for k in want:
        assert got[k][1] == pytest.approx(want[k][1])


@pytest.mark.parametrize("step", [None, 30])
def test_copies_of_a_block_may_be_in_different_order(step):
    """Each side of the join collects its own copy, in the order the shuffle brings the points."""
    pts = cloud(8, 60)
    width = math.hypot(max(p[1] for p in pts) - min(p[1] for p in pts), max(p[2] for p in pts) - min(p[2] for p in pts)) * 0.5 / 8
    left = [{"x": p[1], "y": p[2], "z": p[3]} for p in pts]
    blocks = pd.DataFrame({"left": [left], "right": [left[::-1]], "same": [True]})
    run = spatial._pair_histogram(np.linspace(0.0, 8 * width, 9)[:-1], math.radians(step) if step else None, 180 // step if step else 1)
    got = {(r.dbin, r.tbin): r.n for part in run(iter([blocks])) for r in part.itertuples()}
    assert got == {k: n for k, (n, _) in brute(pts, 8, 0.5, step).items()}


def test_pair_totals_equal_all_pairs(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.4 else rng.choice("abc"), rng.gauss(1e6, 3)) for _ in range(200)]
    got = {r["k"]: (r["pairs"], r["mean_sq_diff"]) for r in joins.pair_totals(spark.createDataFrame(rows, "k string, x double"), ["k"], "x").collect()}
    for k in {k for k, _ in rows}:
        x = [v for kk, v in rows if kk == k]
        sq = [(a - b) ** 2 for a, b in itertools.permutations(x, 2)]
        assert got[k][0] == len(sq)
        assert got[k][1] == pytest.approx(sum(sq) / len(sq), rel=1e-6)


def test_touching_boxes_overlap(spark):
    rows = [(1, 1, 1, 1, 2, 2, 2), (2, 2, 2, 2, 3, 3, 3), (3, 4, 4, 4, 5, 5, 5)]
    df = spark.createDataFrame(rows, "id long, x1 long, y1 long, z1 long, x2 long, y2 long, z2 long")
    assert {r["id"]: r["overlaps"] for r in spatial.overlapping_boxes(df).collect()} == {1: True, 2: True, 3: False}
    assert spatial.any_overlap(df).first()[0] is True
    assert spatial.any_overlap(df.where("id <> 2")).first()[0] is False
    assert spatial.any_overlap(df.where("id < 0")).first()[0] is False


def test_boxes_of_all_sizes_with_broken_corners(spark):
    rng = np.random.RandomState(5)
    lo = rng.uniform(-50, 50, (150, 3))
    hi = lo + 2.0 ** rng.uniform(-4, 4, (150, 3))
    lo, hi = np.vstack([lo, [[60.0] * 3]]), np.vstack([hi, [[60.0] * 3]])
    rows = [(i, *map(float, lo[i]), *map(float, hi[i])) for i in range(len(lo))]
    df = spark.createDataFrame(rows, "id long, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")
    meets = (lo[:, None] <= hi[None]).all(2) & (lo[None] <= hi[:, None]).all(2) & ~np.eye(len(lo), dtype=bool)
    assert {r["id"]: r["overlaps"] for r in spatial.overlapping_boxes(df).collect()} == dict(enumerate(meets.any(1)))


def test_cells_of_boxes_are_not_broadcast(spark):
    """Spark's estimate knows the boxes only, not the many cells they cover."""
    rows = [(i, 9 * i, 0, 0, 9 * i + 4, 3, 3) for i in range(50)] + [(50, 0, 0, 0, 4, 3, 3), (51, 0, 0, 0, None, 3, 3)]
    df = spark.createDataFrame(rows, "id long, x1 long, y1 long, z1 long, x2 long, y2 long, z2 long")
    out = spatial.overlapping_boxes(df)
    assert {r["id"] for r in out.where("overlaps").collect()} == {0, 50}
    assert out.count() == 52
    for plan in (out, spatial.any_overlap(df)):
        assert "Broadcast" not in plan._jdf.queryExecution().sparkPlan().toString()


def test_copies_of_boxes_are_compared_once(spark):
    """4,000 equal boxes that touch nothing else but one, beside single ones in the same cell."""
    rows = [(i, 0, 0, 0, 1, 1, 1) for i in range(4000)] + [(4000, 1, 1, 1, 1, 1, 1), (4001, 2, 2, 2, 2, 2, 2)]
    df = spark.createDataFrame(rows, "id long, x1 long, y1 long, z1 long, x2 long, y2 long, z2 long")
    got = {r["id"]: r["overlaps"] for r in spatial.overlapping_boxes(df).collect()}
    assert got == {i: i < 4001 for i in range(4002)}


def test_order_score_by_hand(spark):
    rows = [(1, 1, 1, 1, 1, 1, 5), (2, 1, 1, 1, 1, 1, 9), (3, 1, 1, 1, 1, 1, 5)]
    df = spark.createDataFrame(rows, "id long, x1 long, y1 long, z1 long, x2 long, y2 long, z2 long")
    # from the top: 2, 1, 3
    assert spatial.order_score(df).first()[0] == 2 * 9 + 1 + 1 + 0


def test_station_on_a_cell_takes_its_value(spark):
    grid = spark.createDataFrame([(1, float(a), float(b), 10.0 * a + b) for a in (0, 1) for b in (0, 1)], "dt int, lat double, lon double, value double")
    st = spark.createDataFrame([(7, 0.0, 0.0), (8, 0.5, 0.5)], "stid long, lat double, lon double")
    got = {r["stid"]: r["value"] for r in spatial.grid_to_station(grid, st).collect()}
    assert got == {7: 0.0, 8: pytest.approx(5.5)}


def test_orientations_follow_the_table(spark):
    table = {(1, 2, 3): "123456", (1, 3, 2): "125634", (2, 1, 3): "341256", (3, 1, 2): "345612", (3, 2, 1): "563412", (2, 3, 1): "561234", (2, 2, 1): "563412", (1, 1, 1): "123456", (2, 1, 1): "345612"}
    df = spark.createDataFrame([(h, l, w) for h, l, w in table], "h int, l int, w int")
    out = df.select("h", "l", "w", spatial.orientation_order(F.col("h"), F.col("l"), F.col("w")).alias("o")).collect()
    for r in out:
        assert "".join(map(str, r["o"])) == table[r["h"], r["l"], r["w"]]


def test_grid_diff_has_no_left_neighbour_at_the_edge(spark):
    df = spark.createDataFrame([(0, 0, 5, 0), (1, 0, 7, 0), (0, 1, 2, 0)], "x long, y long, h int, gap int")
    got = {(r["x"], r["y"]): (r["dx"], r["dy"]) for r in spatial.neighbour_diff(df).collect()}
    assert got == {(0, 0): (None, None), (1, 0): (2, None), (0, 1): (None, -3)}
