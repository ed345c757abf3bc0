import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.operators import clean, cluster, encode, folds, joins, metrics, project
from tablewright.operators import models as M
from tablewright.operators import series as Q
from tablewright.operators.folds import stratified
from tablewright.plans import QUERIES
from tablewright.plans.models import priced
from tablewright.plans.registry import Tables
from tablewright.sources import delimited, files


def days(n):
    return [dt.date(2020, 1, 1) + dt.timedelta(d) for d in range(n)]


@pytest.mark.parametrize("block", [8, 512])
@pytest.mark.parametrize("n", [1, 5, 700])
def test_ewma_equals_pandas(spark, n, block):
    rng = np.random.RandomState(n)
    x = rng.normal(size=n)
    rows = [("hot", i, float(v)) for i, v in enumerate(x)] + [("b", i, float(v)) for i, v in enumerate(x[:3])]
    df = spark.createDataFrame(rows, "k string, t long, x double")
    out = Q.ewma(df, ["k"], "t", ["x"], 12, block=block).toPandas()
    for k, part in out.groupby("k"):
        got = part.sort_values("t")["x"].to_numpy()
        want = pd.Series(x[: len(got)]).ewm(span=12, adjust=True).mean().to_numpy()
        assert np.allclose(got, want, atol=1e-12)


def test_delay_line_shorter_than_the_largest_lag(spark):
    df = spark.createDataFrame(list(zip(days(3), [1.0, 2.0, 3.0])), "d date, x double")
    out = Q.delay_line(df, "d", ["x"], [1, 25]).orderBy("d").collect()
    assert [(r["x_lag1"], r["x_lag25"]) for r in out] == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]


def test_rolling_mean_needs_a_full_window(spark):
    x = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    df = spark.createDataFrame(list(zip(days(6), x)), "d date, x double")
    out = [r["x"] for r in Q.rolling_mean(df, "d", ["x"], 2).orderBy("d").collect()]
    assert out == [None, 1.5, None, None, 4.5, 5.5]


def test_pair_dispersion_uses_common_dates(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 5.0, 1.0), (4.0, 5.0, 7.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): (r["n"], r["dispersion"]) for r in Q.pair_dispersion(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == (3, pytest.approx(np.var([-1, -3, -1])))
    assert got["a", "c"] == (2, pytest.approx(np.var([1, -3])))


def test_station_dispersion_over_blocks_and_gaps(spark):
    """Five stations in blocks of two, gaps, a high common level, a station without a place, one without common dates."""
    rng = np.random.default_rng(3)
    x = 1e6 + rng.normal(size=(30, 5))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:15, 3], x[15:, 4] = np.nan, np.nan
    rows = [(d, f"s{k}", float(v)) for d, day in zip(days(30), x) for k, v in enumerate(day) if v == v]
    values = spark.createDataFrame([*rows, (days(1)[0], None, 1.0), (None, "s0", 1.0), (days(1)[0], "s9", None)], "d date, p string, v double")
    places = spark.createDataFrame([("s0", 0.0, 0.0), ("s1", 3.0, 4.0), ("s2", 3.0, 0.0), ("zz", 1.0, 1.0)], "p string, x double, y double")
    got = {(r["a"], r["b"]): r for r in Q.station_dispersion(values, "d", "p", "v", places, block=2, parts=3).collect()}
    want = {}
    for i in range(5):
        for j in range(i + 1, 5):
            both = (x[:, i] - x[:, j])[~np.isnan(x[:, i] - x[:, j])]
            if len(both):
                want[f"s{i}", f"s{j}"] = (len(both), np.var(both))
    assert ("s3", "s4") not in want
    assert {k: r["n"] for k, r in got.items()} == {k: n for k, (n, _) in want.items()}
    for k, (_, v) in want.items():
        assert got[k]["dispersion"] == pytest.approx(v, rel=1e-8)
    assert [got["s0", "s1"]["distance"], got["s1", "s2"]["distance"], got["s0", "s3"]["distance"]] == [5.0, 4.0, None]
    plain = {(r["a"], r["b"]): r["distance"] for r in Q.station_dispersion(values, "d", "p", "v").collect()}
    assert plain.keys() == want.keys() and not any(plain.values())
    assert Q.station_dispersion(values.limit(0), "d", "p", "v").collect() == []


def test_equal_values_in_several_tasks_are_constant(spark):
    """The mean of 49 ones is a little below 1 once it is merged."""
    df = spark.range(0, 147, 1, 3).select(F.lit(1.0).alias("x"), F.col("id").cast("double").alias("y"), F.array(F.lit(1.0)).alias("v"))
    assert clean.drop_constant_columns(df, ["x", "y"]) == ["y"]
    for ddof in (0, 1):
        assert clean.fit_standardise(df, ["x"], ddof).spread == {"x": 0.0}
        assert clean.fit_cells(df, "v", ddof=ddof).spread == (0.0,)
    assert clean.drop_constant_columns(df.limit(1), ["x", "y"]) == []
    assert clean.drop_constant_columns(df.select(F.lit(None).cast("double").alias("x")), ["x"]) == []


def test_semi_join_null_rules(spark):
    train = spark.createDataFrame([(1, 0), (2, None), (3, 7), (4, 8)], "id long, k int")
    test = spark.createDataFrame([(None,), (7,)], "k int")
    assert {r["id"] for r in joins.semi_join_on_values(train, test, ["k"]).collect()} == {1, 3}


def test_semi_join_with_test_rows_per_column(spark):
    """Rows that are there for one column leave no missing cells in the other."""
    train = spark.createDataFrame([(1, 5, 7), (2, 6, 0), (3, 0, 8), (4, 6, 9)], "id long, a int, b int")
    tests = {"a": spark.createDataFrame([(5,)], "a int"), "b": spark.createDataFrame([(9,)], "b int")}
    assert {r["id"] for r in joins.semi_join_on_values(train, tests, ["a", "b"]).collect()} == {1, 4}


def test_semi_join_query_takes_no_missing_cell_for_key_0(spark, tmp_path):
    """Keys 0 without the segment or an open order; a customer of no nation, of nation 0, and an order without key."""
    customer = [(0, 3, "OTHER", 1.0), (1, 3, "BUILDING", 1.0), (2, None, "BUILDING", 1.0), (3, 3, "OTHER", 1.0)]
    orders = [(0, 3, "F"), (10, 0, "O"), (11, 1, "F"), (12, 2, "F"), (13, 3, "P"), (14, 3, "F"), (None, 3, "P")]
    for extra, want in (([], {11, 12, 13}), ([(4, 0, "BUILDING", 1.0)], {10, 11, 12, 13})):
        folder = str(tmp_path / f"t{len(extra)}")
        c = "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"
        spark.createDataFrame(customer + extra, c).write.parquet(f"{folder}/customer.parquet")
        spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
        assert {r["o_orderkey"] for r in QUERIES["semi_join"](spark, folder).collect()} == want


def test_semi_join_on_several_columns_gives_each_row_once(spark):
    train = spark.createDataFrame([(1, 5, 9), (2, 5, 0), (3, 1, 9), (4, None, 9), (5, 1, 1)], "id long, a int, b int")
    test = spark.createDataFrame([(5, 9)], "a int, b int")
    got = sorted(r["id"] for r in joins.semi_join_on_values(train, test, ["a", "b"]).collect())
    assert got == [1, 2, 3, 4]


def test_mixup_without_negatives_is_empty(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "id long, y int, v array<double>")
    assert joins.mixup(df, F.col("y") == 1, F.col("y") == 0, "id", "v", 5).count() == 0


def test_covariance_zca_and_pca_match_numpy(spark):
    rng = np.random.RandomState(3)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + 100
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").repartition(4)
    n, mean, cov = project.mean_and_covariance(df, "v")
    assert n == 300 and np.allclose(mean, x.mean(0)) and np.allclose(cov, np.cov(x.T, bias=True))
    white = np.stack([r["v"] for r in project.fit_zca(df, "v").apply(df, "v").collect()])
    assert np.allclose(np.cov(white.T, bias=True), np.eye(5), atol=1e-6)
    top = np.stack([r["v"] for r in project.fit_pca(df, "v", 2).apply(df, "v").orderBy("id").collect()])
    val = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1][:2]
    assert np.allclose(top.var(0), val)


def test_random_features_approximate_the_kernel(spark):
    rng = np.random.RandomState(4)
    x = rng.normal(size=(20, 3))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    z = np.stack([r["v"] for r in project.fit_rff(3, 4000, 0.3).apply(df, "v").orderBy("id").collect()])
    want = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - want).max() < 0.1


def test_nmf_factors_are_nonnegative_and_fit(spark):
    rng = np.random.RandomState(5)
    a = rng.uniform(size=(40, 2)) @ rng.uniform(size=(2, 8))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "id long, v array<double>").repartition(3)
    model = project.fit_nmf(df, "v", 2, iterations=20)
    w = np.array([r["v"] for r in model.apply(df, "v").orderBy("id").collect()])
    assert (w >= 0).all() and (model.parts >= 0).all() and np.abs(w @ model.parts - a).mean() < 0.01


def test_kmodes_cost_never_rises_and_empty_cluster_stays(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("ab"), rng.choice("xyz"), rng.choice("pq")) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string")
    _, costs = cluster.kmodes(df, ["a", "b", "c"], 3)
    assert all(b <= a for a, b in zip(costs, costs[1:]))
    far = cluster.Centroids(({"a": "a", "b": "x", "c": "p"}, {"a": "?", "b": "?", "c": "?"}))
    new, _ = cluster.update(df, far)
    assert new.cat[1] == {"a": "?", "b": "?", "c": "?"}


def test_prototypes_move_to_the_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 100.0)], "c string, x double")
    start = cluster.Centroids(({"c": "a"}, {"c": "b"}), ({"x": 0.0}, {"x": 90.0}), 0.5)
    new, cost = cluster.update(df, start)
    assert [m["x"] for m in new.num] == [2.0, 100.0] and cost == pytest.approx(1 + 9 + 100)


def test_one_hot_ignores_unseen(spark):
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, c string")
    test = spark.createDataFrame([(9, "a"), (10, "zz")], "id long, c string")
    vocabulary = encode.fit_one_hot(train, ["c"], threshold=1)
    assert [(r["id"], r["idx"]) for r in encode.one_hot_long(test, "id", vocabulary, ["c"]).collect()] == [(9, 0)]
    wide = encode.one_hot_wide(test, encode.fit_one_hot(train, ["c"]), ["c"]).orderBy("id").collect()
    assert [tuple(r) for r in wide] == [(9, 1, 0), (10, 0, 0)]


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1)], "p double, y int")
    assert metrics.auc(df, "p", "y").first()[0] == pytest.approx(0.875)
    assert metrics.auc(df.where("y = 1"), "p", "y").first()[0] is None


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.RandomState(7)
    y = rng.randint(0, 2, 300)
    rows = [(i, float(c), [float(c * 2 + rng.normal()), float(rng.normal())]) for i, c in enumerate(y)]
    df = spark.createDataFrame(rows, "id long, label double, v array<double>")
    return stratified(df.withColumn("features", array_to_vector("v")), "id", "label", 3).persist()


@pytest.mark.parametrize("build", [lambda: M.logistic(1.0, 300), lambda: M.forest_classifier(10, 3, 5), lambda: M.boosting(5, 3, 5, subset="all")])
def test_models_beat_chance_out_of_fold(separable, build):
    mean, half = M.cv_score(separable, build(), "fold", 3, M.auc_evaluator())
    assert mean > 0.8 and 0 <= half < 0.1


def test_balanced_weights_give_classes_equal_mass(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)], "label double")
    mass = {r["label"]: r["m"] for r in M.balanced_weights(df, "label").groupBy("label").agg(F.sum("weight").alias("m")).collect()}
    assert mass[0.0] == pytest.approx(mass[1.0])


def test_out_of_fold_covers_every_row_once(separable):
    out = M.out_of_fold(separable, {"p": M.logistic(1.0, 300)}, "fold", 3, ["id", "label"])
    assert out.count() == out.select("id").distinct().count() == 300


def test_forward_selection_stops_and_drops_the_last():
    gain = {"a": 0.3, "b": 0.2, "c": -0.1}
    score = lambda s: 0.5 + sum(gain[f] for f in s)
    assert [f for f, _ in M.forward_selection(score, list(gain))] == ["a", "b"]


def test_approximate_selection_prunes():
    calls = []
    gain = {"a": 0.3, "b": 0.2, "bad": -0.4, "c": 0.05}

    def score(s):
        calls.append(tuple(s))
        return 0.5 + sum(gain[f] for f in s)

    chosen = [f for f, _ in M.approximate_selection(score, list(gain), seed=1)]
    assert "bad" not in chosen[1:] and len(calls) <= 10


def test_best_c_prefers_the_larger_on_ties():
    assert M.best_c([(1.0, 0.8), (4.0, 0.8), (2.0, 0.7)]) == (4.0, 0.8)
    grid = M.c_grid(1.0)
    assert len(grid) == 21 and grid[1] == 0.125 and grid[-1] == 16.0


def test_files_round_trip(spark, tmp_path):
    pcm = np.array([1, -2, 300], ">i2").tobytes()
    (tmp_path / "clip7.raw").write_bytes(pcm)
    (tmp_path / "other.txt").write_text("x")
    found = files.scan_files(spark, str(tmp_path), "raw", content=True)
    assert [(r["key"], r["length"]) for r in found.collect()] == [("clip7", 6)]
    decoded = files.decode_pcm16be(found.withColumn("id", F.lit(7).cast("long")), "id", "content").first()
    assert decoded["samples"] == [1.0, -2.0, 300.0]
    out = tmp_path / "pred"
    df = spark.createDataFrame([(2, 0.5), (1, 0.25)], "id long, p double")
    delimited.write_predictions(df, str(out), "id", ["id", "p"], single_file=True)
    parts = list(out.glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text() == "id,p\n1,0.25\n2,0.5\n"


def test_numeric_read_without_fill_gives_nulls(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,x\n,2.5\n")
    assert [tuple(r) for r in delimited.read_numeric(spark, str(tmp_path), ["a", "b"], fill=None).collect()] == [(1.0, None), (None, 2.5)]


def test_logloss_of_a_certain_mistake_is_infinite(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.5)], "y int, p double")
    assert df.agg(metrics.logloss(F.col("y"), F.col("p"))).first()[0] == float("inf")
    sure = spark.createDataFrame([(1, 1.0), (0, 0.0)], "y int, p double")
    assert sure.agg(metrics.logloss(F.col("y"), F.col("p"))).first()[0] == 0


def test_seeds_share_few_folds(spark):
    df = spark.range(2000).withColumn("c", F.col("id") % 2)
    a, b = (folds.kfold(df, "id", 5, shuffle=True, seed=s).select("id", F.col("fold").alias(f"f{s}")) for s in (1, 2))
    same = a.join(b, "id").where("f1 = f2").count() / 2000
    shifted = a.join(b.withColumn("id", F.col("id") + 1), "id").where("f1 = f2").count() / 2000
    assert abs(same - 0.2) < 0.04 and abs(shifted - 0.2) < 0.04


def test_approximate_selection_goes_on_after_a_tie():
    gain = {"a": 1.0, "b": 0.0, "c": 0.5}
    for seed in range(8):
        chosen = [f for f, _ in M.approximate_selection(lambda fs: sum(gain[f] for f in fs), list(gain), seed=seed)]
        assert {"a", "c"} <= set(chosen) or "a" in chosen


def test_ewma_of_span_one_and_of_long_spans(spark):
    x = [float(i * i % 17) for i in range(900)]
    df = spark.createDataFrame(list(enumerate(x)), "t int, x double")
    for span in (1, 700):
        got = [r["x"] for r in Q.ewma(df, [], "t", ["x"], span).orderBy("t").collect()]
        assert got == pytest.approx(pd.Series(x).ewm(span=span, adjust=True).mean().tolist())


def test_covariance_of_wide_vectors(spark):
    rng = np.random.RandomState(4)
    x = rng.rand(12, 2680)
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(5)
    n, mean, cov = project.mean_and_covariance(df, "v")
    assert n == 12 and np.allclose(mean, x.mean(0)) and np.allclose(cov, np.cov(x.T, bias=True))


def test_tasks_of_a_forest_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "TASK_ROWS", 100)
    data = priced(Tables(spark, "/root/testdata/sf0.001"))
    sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 200
    assert {"features", "y", "held", "l_returnflag", "l_linestatus"} <= set(data.columns)
    assert "l_orderkey" not in data.columns


def test_rounds_over_equal_rows_are_those_over_all(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.choice([0.0, 1.0, 2.5])) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    kinds = cluster.equal_rows(df, ["a", "b", "v"])
    assert kinds.count() <= 18 and kinds.agg(F.sum("weight")).first()[0] == 400
    start = cluster.start_prototypes(df, ["a", "b"], ["v"], 3, 0.7)
    same = cluster.start_prototypes(kinds, ["a", "b"], ["v"], 3, 0.7, "weight")
    assert start.cat == same.cat and [m["v"] for m in same.num] == pytest.approx([m["v"] for m in start.num])
    (want, costs), (got, weighed) = cluster.fit(df, start, 5), cluster.fit(kinds, start, 5, "weight")
    assert got.cat == want.cat and weighed == pytest.approx(costs)
    assert [m["v"] for m in got.num] == pytest.approx([m["v"] for m in want.num])


def test_word_counts_are_neither_sorted_nor_kept_as_rows(spark):
    docs = spark.createDataFrame([(i, f"common word{i % 3} common") for i in range(9)] + [(9, None), (10, "rare")], "doc_id long, text string")
    out = encode.bag_of_words(docs, "doc_id", "text", 3)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "Scan parquet" in plan
    got = sorted((r["doc_id"], r["term"], r["n"]) for r in out.collect())
    assert got == sorted([(i, "common", 2) for i in range(9)] + [(i, f"word{i % 3}", 1) for i in range(9)])


def mixed_rows(n, seed):
    rng = random.Random(seed)
    return [(rng.choice("abcdefgh"), rng.choice(["x", "y", "z", None]), rng.gauss(0, 1), rng.gauss(2, 3)) for _ in range(n)]


def test_several_starts_are_fitted_as_each_alone(spark):
    df = spark.createDataFrame(mixed_rows(300, 3), "a string, b string, u double, v double").repartition(3)
    starts = cluster.huang_starts(df, ["a", "b"], ["u", "v"], [4, 4, 7], 0.7)
    assert [s.k for s in starts] == [4, 4, 7] and starts[0] != starts[1]
    for s in starts:
        assert len({(m["a"], m["b"]) for m in s.cat}) == s.k
    for start, (got, cost) in zip(starts, cluster.fit_many(df, starts, 3)):
        want, costs = cluster.fit(df, start, 3)
        assert got.cat == want.cat and cost == pytest.approx(min(costs))
        for x, y in zip(got.num, want.num):
            assert x == pytest.approx(y)


def test_kprototypes_query_makes_5_10_and_50_clusters_and_settles(spark, tmp_path):
    import __spark_entry__ as entry

    rng = random.Random(9)
    rows = [(i, f"b{rng.randrange(9)}", f"t{rng.randrange(12)}", 900 + rng.random() * 200, rng.randrange(50)) for i in range(400)]
    schema = "p_partkey long, p_brand string, p_type string, p_retailprice double, p_size int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "part.parquet"))
    out = entry.queries()["kprototypes"](spark, str(tmp_path)).toPandas()
    assert list(out.columns) == ["p_partkey", "c5", "c10", "c50"] and len(out) == 400
    assert out["c5"].nunique() == 5 and out["c10"].nunique() > 8 and out["c50"].nunique() > 35
    # settled: every row is nearest to the means and modes of its own cluster, but for ties of modes
    df = pd.DataFrame(rows, columns=["p_partkey", "b", "t", "p", "s"]).merge(out, on="p_partkey")
    x = ((df[["p", "s"]] - df[["p", "s"]].mean()) / df[["p", "s"]].std()).to_numpy()
    means = np.stack([x[df["c5"] == k].mean(0) for k in range(5)])
    mode = [[df.loc[df["c5"] == k, c].value_counts().sort_index().idxmax() for c in "bt"] for k in range(5)]
    far = ((x[:, None] - means) ** 2).sum(2) + 0.7 * np.stack([sum((df[c] != v).to_numpy() for c, v in zip("bt", m)) for m in mode], 1)
    assert (far.argmin(1) == df["c5"]).mean() > 0.97
