import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.functions import scalar as S
from tablewright.operators import images as I
from tablewright.operators.signals import cosine_basis, framewise, mel_bank, spectral_features


def one(spark, values, expr):
    df = spark.createDataFrame([([None if v is None else float(v) for v in values],)], "v array<double>")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def test_moments(spark):
    x = np.array([1.0, 2.0, 4.0, 8.0])
    m = one(spark, x, A.moments)
    z = (x - x.mean()) / x.std()
    assert (m["mean"], m["std"]) == pytest.approx((x.mean(), x.std()))
    assert (m["skew"], m["kurt"]) == pytest.approx(((z**3).mean(), (z**4).mean() - 3))


def test_flat_row_gives_nulls(spark):
    assert one(spark, [2, 2, 2], A.standardise_row) == [None, None, None]
    assert one(spark, [2, 2, 2], A.minmax_row) == [None, None, None]


def test_fit_length_cuts_centre_or_pads(spark):
    assert one(spark, [1, 2, 3, 4, 5], lambda v: A.fit_length(v, 3)) == [2, 3, 4]
    assert one(spark, [1, 2], lambda v: A.fit_length(v, 4)) == [1, 2, 0, 0]


def test_frames_cover_the_signal(spark):
    out = one(spark, range(1, 11), lambda v: A.frames(v, 4, 4))
    assert out == [[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 0, 0]]
    assert len(one(spark, [0] * 4000, lambda v: A.frames(v, 120, 60))) == 67


def test_circular_mean_closes_the_ring(spark):
    assert one(spark, [3, 0, 0, 0], A.circular_mean3) == [1, 1, 0, 1]


def test_trend_removed_uses_partial_windows(spark):
    assert one(spark, [2, 4, 6], lambda v: A.trend_removed(v, 2)) == [0, 1, 1]


def test_peak_trough_alternates(spark):
    assert one(spark, [2, 0, -2, 0, 2, 0, -2, 0], A.peak_trough) > 0
    assert one(spark, [0, 0, 0, 0], A.peak_trough) <= 1


def test_median_ignores_nulls(spark):
    assert one(spark, [None, 4, 1], A.median) == 2.5
    assert one(spark, [None], A.median) is None


def test_argmax_takes_the_first(spark):
    assert one(spark, [1, 3, 3], A.argmax) == 1


def test_crop_extent_and_cells(spark):
    page = np.zeros((6, 6))
    page[2:4, 3] = [1, 5]
    df = spark.createDataFrame([(page.ravel().tolist(),)], "v array<double>")
    box = I.crop_extent(F.col("v"), (6, 6), 0.1, 0)
    out = df.withColumn("b", box).select("b", I.crop(F.col("v"), (6, 6), F.col("b")).alias("c")).first()
    assert tuple(out["b"]) == (2, 3, 3, 3)
    assert out["c"] == [1, 5]


def test_leaf_probabilities_add_up(spark):
    rng = np.random.RandomState(1)
    votes = rng.uniform(0.1, 1.0, 37)
    out = np.array(one(spark, votes, I.leaf_probabilities))
    assert len(out) == 159
    for k, a in enumerate((5, 6)):
        assert out[6 + 76 * k : 6 + 76 * (k + 1)].sum() == pytest.approx(votes[a])
    assert out[-1] == pytest.approx(votes[2])


def test_leaf_probabilities_without_votes_are_zero(spark):
    assert sum(one(spark, [0] * 37, I.leaf_probabilities)) == 0


def test_patches_of_pages_with_channels(spark):
    page = np.arange(5 * 4 * 3, dtype=float).reshape(5, 4, 3)
    df = spark.createDataFrame([(1, page.reshape(-1).tolist())], "id int, v array<double>")
    got = {r["patch_no"]: r["patch"] for r in I.grid_patches(df, "v", (5, 4), (3, 2), (2, 1), channels=3).collect()}
    want = [page[r : r + 3, c : c + 2].reshape(-1).tolist() for r in (0, 2) for c in (0, 1, 2)]
    assert got == dict(enumerate(want))
    drawn = I.random_patches(df, "id", "v", (5, 4), (3, 2), n=3, min_std=0.1, channels=3).collect()
    assert len(drawn) == 3
    assert all(r["patch"] == page[r["top"] : r["top"] + 3, r["left"] : r["left"] + 2].reshape(-1).tolist() for r in drawn)


def test_image_features_are_colour_offsets_and_the_grey_profile(spark):
    rng = np.random.default_rng(8)
    page = rng.uniform(0, 255, (16, 16, 3))
    out = one(spark, page.reshape(-1), lambda v: I.image_features(v, 16, 16))
    assert len(out) == 86
    assert out[:3] == pytest.approx(page.mean(axis=(0, 1)) - page.mean())
    grey = page @ np.array([0.299, 0.587, 0.114])
    assert out[3:] == pytest.approx(one(spark, grey.reshape(-1), lambda v: I.profile_vector(v, 16, 16)))
    assert out[3] == pytest.approx(grey.mean())


def test_profile_vector_has_86_numbers_less_colours(spark):
    rng = np.random.RandomState(2)
    out = one(spark, rng.uniform(0, 255, 128 * 128), lambda v: I.profile_vector(v, 128, 128))
    assert len(out) + 3 == 44 + 4 + 28 + 7 + 3
    assert all(v is not None for v in out)


WARPED = "id long, variant string, v array<double>, " + ", ".join(f"{c} double" for c in I.WARPS)


def test_shear_of_one_moves_a_line_one_cell_per_row(spark):
    page = np.zeros((7, 7))
    page[:, 3] = 1.0
    df = spark.createDataFrame([(1, "h", page.ravel().tolist(), 0.0, 1.0, *[0.0] * 8)], WARPED)
    got = np.array(I.warp(df, "id", "v", 7).first()["v"]).reshape(7, 7)
    assert [int(np.argmax(r)) for r in got] == [6, 5, 4, 3, 2, 1, 0] and np.allclose(got.sum(1), 1)


def test_cut_edges_are_independent(spark):
    page = np.arange(64.0).reshape(8, 8)
    df = spark.createDataFrame([(1, "c", page.ravel().tolist(), 0.0, 0.0, 0.0, 4.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], WARPED)
    got = np.array(I.warp(df, "id", "v", 8).first()["v"]).reshape(8, 8)
    assert np.allclose(got[:, 0], np.interp(4 + (np.arange(8) + 0.5) / 2 - 0.5, np.arange(8), page[:, 0]))


def test_flat_page_is_lit_by_elevation_alone(spark):
    df = spark.createDataFrame([(1, "e", [0.5] * 16, *[0.0] * 7, 20.0, 30.0, 2.0)], WARPED)
    assert I.warp(df, "id", "v", 4).first()["v"] == pytest.approx([0.5] * 16)


def test_draws_are_independent(spark):
    df = spark.range(20_000).select(*[S.draw(p, F.col("id")).alias(p) for p in "ab"], S.draw("a", F.col("id") + 1).alias("next"))
    x = df.toPandas()
    for c in x:
        assert abs(x[c].mean() - 0.5) < 0.01 and abs(x[c].var() - 1 / 12) < 0.003
    assert abs(x.corr().to_numpy() - np.eye(3)).max() < 0.03


def test_noise_is_normal(spark):
    df = spark.range(200).select(I.noise(F.array_repeat(F.lit(0.5), 100), F.col("id"), 0.01).alias("v"))
    z = (np.concatenate(df.toPandas()["v"].to_numpy()) - 0.5) / 0.01
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03 and abs((z**3).mean()) < 0.08 and z.max() > 3


def test_every_page_gives_n_patches_from_all_offsets(spark):
    rng = np.random.RandomState(3)
    rows = [(i, rng.rand(64).tolist()) for i in range(60)] + [(99, [0.0] * 64), (98, [0.0] * 63 + [9.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = I.random_patches(df, "id", "v", (8, 8), (3, 3), 3, 0.01).toPandas()
    assert (out[out.id < 90].groupby("id").size() == 3).all() and 99 not in set(out.id)
    assert len(set(zip(out.top, out.left))) == 25


def test_warp_without_change_keeps_the_page(spark):
    page = np.arange(16.0).tolist()
    df = spark.createDataFrame([(1, "none", page, *[0.0] * 10)], WARPED)
    assert I.warp(df, "id", "v", 4).first()["v"] == pytest.approx(page)


def test_rotation_by_a_quarter_turn(spark):
    page = np.arange(16.0).reshape(4, 4)
    df = spark.createDataFrame([(1, "r", page.ravel().tolist(), 90.0, *[0.0] * 9)], WARPED)
    got = np.array(I.warp(df, "id", "v", 4).first()["v"]).reshape(4, 4)
    assert any(np.allclose(got, np.rot90(page, k)) for k in (1, 3))


def test_noise_stays_in_range_and_repeats(spark):
    a = one(spark, [0.5] * 100, lambda v: I.noise(v, F.lit(7)))
    b = one(spark, [0.5] * 100, lambda v: I.noise(v, F.lit(7)))
    assert a == b and min(a) >= 0 and max(a) <= 1 and 0.05 < np.std(a) < 0.2


def test_spectral_features_find_a_tone(spark):
    rate, n = 2000.0, 4000
    t = np.arange(n) / rate
    tone = np.sin(2 * np.pi * 200 * t)
    df = spark.createDataFrame([(1, tone.tolist())], "id long, s array<double>")
    out = spectral_features(df, "id", "s", 120, 60, rate).orderBy("frame").collect()
    assert len(out) == 67 and len(out[0]["mel"]) == 40 and len(out[0]["feats"]) == 24
    centroid = out[10]["feats"][12 + 4 + 1]
    assert centroid == pytest.approx(200, rel=0.1)
    mel, feats = framewise(np.array([[tone[600:720]]]), rate, mel_bank(40, 30, 600, rate, 120), cosine_basis(40, 12), 4)
    assert mel.shape == (1, 1, 40) and feats.shape == (1, 1, 24)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("O'Brien",), ("Li",), ("9ab",)], "n string")
    got = [r[0] for r in df.select(S.prefix_code(F.col("n"))).collect()]
    assert got == [14 * 900 + 25 * 30 + 25, None, None]
    d = spark.createDataFrame([("2020-02-30",), ("2020-02-28",), ("x",)], "s string")
    got = [r[0] for r in d.select(S.try_dates(F.col("s"), ["yyyy-MM-dd"])).collect()]
    assert got[0] is None and got[1].day == 28 and got[2] is None
    h = spark.createDataFrame([(0.0,), (1.0,), (0.05,), (2.0,)], "x double")
    assert [r[0] for r in h.select(S.equal_width_bin(F.col("x"), 0.0, 1.0, 10)).collect()] == [0, 9, 0, None]


def test_direction_bins_fold_to_a_half_circle(spark):
    pts = [(0.0, 1.0), (0.0, -1.0), (1.0, 0.0), (-1.0, 0.0), (math.sin(math.radians(170)), math.cos(math.radians(170)))]
    df = spark.createDataFrame(pts, "dx double, dy double")
    assert [r[0] for r in df.select(S.direction_bin(F.col("dx"), F.col("dy"), 30)).collect()] == [0, 0, 3, 3, 0]
