"""Hard negatives against a plain search, with blocks and tiles small enough to meet each other."""

import itertools
import math
import random

import numpy as np
import pytest

from tablewright.llm import hardneg
from tablewright.llm.hardneg import Rule

SCHEMA = "vec_id bigint, embedding array<double>, label int, `id` int, anchor string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)


def plain(rows, positives=5, negatives=3):
    pts = []
    for i, v, k in rows:
        if k is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        pts.append((i, (k + 1) % 10 if i is not None and i % 7 == 0 else k, [math.floor(256 * x) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for n, (i, k, v) in enumerate(pts):
        if i is None or i % 50:
            continue
        own = sorted(((dot(v, w), j) for m, (j, l, w) in enumerate(pts) if l == k and m != n), key=rank)[:positives]
        other = [(dot(v, w), j) for j, l, w in pts if l != k]
        for ps, j in own:
            hits = sorted((x for x in other if 50 * ps <= 100 * x[0] <= 95 * ps), key=rank)[:negatives]
            out += [(i, j, r, x, ps, s) for r, (s, x) in enumerate(hits, 1)]
    return sorted(out, key=str)


def mined(df, **sizes):
    return sorted((tuple(r) for r in hardneg.hard_negatives(hardneg.points_of(df), **sizes).collect()), key=str)


@pytest.mark.parametrize("block,tile", [(16, 3), (4096, 512)])
def test_same_as_plain_search(spark, block, tile):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(600):
        c = rng.randrange(6)
        rows.append((i, [x + rng.gauss(0, 0.15) for x in centres[c]], c if rng.random() < 0.8 else rng.randrange(10)))
    rows += [(50, rows[3][1], 2)] * 3 + [(700 + i, rows[100][1], i % 4) for i in range(40)]
    rng.shuffle(rows)
    got = mined(table(spark, rows), block=block, tile=tile)
    assert got == plain(rows) and len(got) > 100


def test_far_blocks_are_not_read(spark):
    """Clusters far apart: the zone maps leave each anchor a part of the blocks."""
    rng = random.Random(8)
    rows = []
    for i in range(800):
        c = i % 8
        rows.append((i, [(5.0 if d == c else 0.0) + rng.gauss(0, 0.05) for d in range(8)], c))
    points = hardneg.points_of(table(spark, rows))
    space, n = hardneg.space_of(points)
    blocks = hardneg.blocks_of(points, space, n, 20)
    tiles = hardneg.anchor_tiles(blocks, space, Rule(), 4)
    reaches = lambda row, low, high, own, other: own & (high >= np.frombuffer(row["bound"], np.int64)[:, None])
    masks = hardneg.chosen_blocks(tiles, blocks, space, reaches).collect()
    read = sum(int(np.unpackbits(np.frombuffer(r["mask"], np.uint8)).sum()) for r in masks)
    assert 0 < read < 16 * blocks.count() / 3


def test_edges(spark):
    v = [0.5, -0.25]
    rows = [
        (0, v, 1), (50, v, 1), (50, v, 1), (None, v, 1), (100, None, 1), (150, [0.1, None], 1), (200, [float("nan"), 1.0], 1),
        (250, [float("inf"), 1.0], 1), (300, v, None), (350, [], 3), (400, [0.5], 1), (1, [0.4, -0.2], 2), (2, [0.4, -0.2], 3),
        (None, [0.4, -0.2], 2), (3, [0.4, -0.2], 2), (4, [0.0, 0.0], 1), (450, [-0.5, 0.5], 5),
    ]
    assert mined(table(spark, rows)) == plain(rows)
    assert mined(table(spark, [*rows, (5, [1e30, 1.0], 2)])) == plain(rows)
    assert mined(table(spark, rows).limit(0)) == [] and mined(table(spark, [(0, v, 1)])) == []
    big = [(i, [1e5 * x for x in w] if w and None not in w else w, k) for i, w, k in rows]
    assert mined(table(spark, big)) == plain(big)  # scores beyond 2**53


def test_hilbert_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hardneg.hilbert_keys(cells, bits)
        order = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert len(set(keys)) == len(keys)
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()
