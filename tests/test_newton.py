"""Joint logistic fits against single ones, and models in sessions that have observed."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tablewright.operators import models as M
from tablewright.operators import newton
from tablewright.operators.newton import Fit


def made(spark, n=600, width=3, seed=1, k=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ np.arange(1, width + 1) - 0.7)))).astype(float)
    rows = [(i, [float(v) for v in x[i]], float(y[i]), float(1 + i % 3), i % k) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, features array<double>, label double, weight double, fold int").repartition(5).persist()


def plain_auc(scores, labels, weights):
    pos = [(s, w) for s, y, w in zip(scores, labels, weights) if y]
    neg = [(s, w) for s, y, w in zip(scores, labels, weights) if not y]
    over = sum(a * b * ((s > t) + 0.5 * (s == t)) for s, a in pos for t, b in neg)
    return over / (sum(a for _, a in pos) * sum(b for _, b in neg))


def test_joint_fits_are_the_single_fits(spark):
    df = made(spark)
    fits = [Fit(c, columns, fold) for c in (0.1, 4.0) for columns in (None, (0, 2)) for fold in (0, 3, None)]
    beta = newton.fit_logistic(df, fits)
    for f, b in zip(fits, beta):
        part = df if f.fold is None else df.where(F.col("fold") != f.fold)
        cols = f.columns or (0, 1, 2)
        part = part.select("label", "weight", array_to_vector(F.array(*[F.col("features")[i] for i in cols])).alias("features"))
        mass = part.agg(F.sum("weight")).first()[0]
        single = M.logistic(f.c, mass, weight="weight", iterations=200).setTol(1e-10).fit(part)
        assert b[0] == pytest.approx(single.intercept, abs=1e-4)
        assert [b[1 + i] for i in cols] == pytest.approx(list(single.coefficients), abs=1e-4)
        assert all(b[1 + i] == 0 for i in range(3) if i not in cols)


def test_held_out_auc_is_exact_with_ties_and_weights(spark):
    df = made(spark).withColumn("features", F.transform("features", lambda v: F.round(v)))
    fits = [Fit(1.0, None, i) for i in range(4)]
    beta = newton.fit_logistic(df, fits)
    rows = df.collect()
    for j, got in enumerate(newton.held_out_auc(df, fits, beta)):
        mine = [r for r in rows if r["fold"] == j]
        scores = [round(float(beta[j][0] + np.dot(beta[j][1:], r["features"])), 9) for r in mine]
        assert got == pytest.approx(plain_auc(scores, [r["label"] for r in mine], [r["weight"] for r in mine]))


def test_sweep_finds_the_best_of_single_sweeps(spark):
    df = made(spark, n=400, width=5, seed=3)
    values = [0.01, 0.3, 10.0]
    joint = M.sweep_c(df, 4, values)
    ready = df.withColumn("v", array_to_vector("features")).drop("features").withColumnRenamed("v", "features")
    for c, score in joint:
        single = []
        for i in range(4):
            train, test = ready.where(F.col("fold") != i), ready.where(F.col("fold") == i)
            mass = train.agg(F.sum("weight")).first()[0]
            model = M.fitted(M.logistic(c, mass, weight="weight", iterations=200).setTol(1e-10), train)
            rows = model.transform(test).select(vector_to_array("rawPrediction")[1], "label", "weight").collect()
            single.append(plain_auc(*zip(*rows)))
        assert score == pytest.approx(np.mean(single), abs=2e-3)
    assert M.best_c(joint)[0] in values


def test_selection_on_counted_rows(spark):
    """Counted combinations give the scores of the rows they stand for; sets asked together or alone agree."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        a, b, noise = rng.integers(3), rng.integers(4), rng.integers(5)
        rows.append((f"a{a}", f"b{b}" if b else None, int(noise), float(rng.random() < (0.2, 0.5, 0.8)[a] + 0.04 * b), i % 5))
    df = spark.createDataFrame(rows, "a string, b string, noise int, label double, fold int")
    counted = newton.counted_rows(df, ["a", "b", "noise"], "label", "fold")
    found = newton.levels(counted, ["a", "b", "noise"])
    assert found["b"][-1] is None and len(found["noise"]) == 5
    counted = newton.one_hot_rows(counted, found).persist()
    assert counted.count() < 700 and counted.agg(F.sum("weight")).first()[0] == 900
    together = newton.Selection(counted, found, 5)
    chosen = M.forward_selection(together, list(found), together.ahead)
    assert [f for f, _ in chosen][:1] == ["a"] and chosen == M.forward_selection(newton.Selection(counted, found, 5), list(found))
    assert newton.Selection(counted, found, 5)(["b", "a"]) == pytest.approx(together(["a", "b"]), abs=1e-6)


def test_edge_rows(spark):
    df = made(spark, n=40, width=2, k=2)
    one_class = df.withColumn("label", F.lit(1.0))
    means, beta = newton.cross_validated(one_class, [(1.0, None)], 2)
    assert math.isnan(means[0]) and np.isfinite(beta).all()
    empty = df.limit(0)
    assert newton.fit_logistic(empty, [Fit(1.0)]).tolist() == [[0.0]]
    wide = df.withColumn("features", F.array_repeat(F.lit(1.0), 2001))
    with pytest.raises(ValueError, match="2000"):
        newton.fit_logistic(wide, [Fit(1.0)])


@pytest.mark.parametrize("build", [lambda: M.logistic(1.0, 300), lambda: M.forest_classifier(5, 3, 5), lambda: M.boosting(3, 2, 5)])
def test_models_work_after_an_observation(spark, build):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3
    df = made(spark).withColumn("v", array_to_vector("features")).drop("features").withColumnRenamed("v", "features")
    assert M.fitted(build(), df).transform(df).select(M.positive().alias("p")).where("p between 0 and 1").count() == 600


def test_rows_of_other_groups_get_the_pooled_model(spark):
    df = made(spark).withColumn("v", array_to_vector("features")).drop("features").withColumnRenamed("v", "features")
    df = df.withColumn("g", F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y"))
    model = lambda: M.logistic(1.0, 600)
    out = M.per_group(df, df, "g", ["x"], model, ["id", "g"])
    assert out.count() == 600 and out.where("p is null").count() == 0
    pooled = M.fitted(model(), df).transform(df).select("id", M.positive().alias("q"))
    both = out.where("g is distinct from 'x'").join(pooled, "id")
    assert both.count() == 400 and both.where("abs(p - q) > 1e-9").count() == 0


def test_dummies_are_bounded(spark, monkeypatch):
    from tablewright.operators import encode

    monkeypatch.setattr(encode, "MOST_DUMMIES", 2)
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    two = encode.one_hot_wide(df, encode.fit_one_hot(df.where("c < 'c'"), ["c"]), ["c"])
    assert sorted(map(tuple, two.collect())) == [(0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError, match="one_hot_long"):
        encode.one_hot_wide(df, encode.fit_one_hot(df, ["c"]), ["c"])
