import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import clean, folds, ranking


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_positioned_is_dense_and_ordered(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(7)
    out = ranking.positioned(df, ["k"]).orderBy("pos").collect()
    assert [r["pos"] for r in out] == list(range(1000))
    assert [r["k"] for r in out] == sorted(r["k"] for r in out)


def test_ranked_values_counts_rows_before(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 1, 1, 2, 5]),) for _ in range(500)]
    out = ranking.ranked_values(frame(spark, data, "x int"), ["x"]).collect()
    for r in out:
        before = sum(1 for (v,) in data if (v is None and r["x"] is not None) or (v is not None and r["x"] is not None and v < r["x"]))
        assert r["before"] == before
        assert r["n"] == sum(1 for (v,) in data if v == r["x"])


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_grouped_median_matches_statistics(spark, hot):
    rng = random.Random(2)
    data = []
    for i in range(2000):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        data.append((key, rng.choice([None, rng.randint(0, 30), rng.random()])))
    data = [(k, None if v is None else float(v)) for k, v in data]
    got = {r["k"]: r["m"] for r in ranking.grouped_median(frame(spark, data, "k string, x double"), ["k"], "x", "m").collect()}
    want = {}
    for k in {k for k, _ in data if k is not None}:
        want[k] = statistics.median(v for kk, v in data if kk == k and v is not None)
    assert got == pytest.approx(want)


def test_group_without_values_stays_null_and_null_group_is_left(spark):
    df = frame(spark, [("a", None), ("a", None), (None, None), ("b", 1.0), ("b", None)], "k string, x double")
    out = sorted(clean.group_median_fill(df, ["k"], "x").collect(), key=str)
    assert [(r["k"], r["x"]) for r in out] == [("a", None), ("a", None), ("b", 1.0), ("b", 1.0), (None, None)]


def test_median_of_empty_table(spark):
    df = frame(spark, [], "k string, x double")
    assert ranking.grouped_median(df, ["k"], "x").count() == 0


def test_rank_fraction_matches_pandas(spark):
    rng = random.Random(3)
    x = [rng.choice([None, 1.0, 2.0, 2.0, 3.5]) for _ in range(300)]
    df = frame(spark, list(enumerate(x)), "id long, x double")
    got = [r["rank_fraction"] for r in ranking.rank_fraction(df, "x").orderBy("id").collect()]
    want = (pd.Series(x, dtype="float64").rank() / len(x)).tolist()
    assert [g is None for g in got] == [v is None for v in x]
    assert [g for g in got if g is not None] == pytest.approx([w for w in want if w == w])


def test_codes_start_at_one_only_when_training_has_nulls(spark):
    with_null = frame(spark, [("b",), ("a",), (None,)], "c string")
    without = frame(spark, [("b",), ("a",)], "c string")
    test = frame(spark, [("a",), ("b",), ("zz",), (None,)], "c string")
    get = lambda m: {r["c"]: r["code"] for r in ranking.apply_codes(test, m, "c").collect()}
    assert get(ranking.fit_codes(with_null, "c")) == {"a": 1, "b": 2, "zz": -1, None: -1}
    assert get(ranking.fit_codes(without, "c")) == {"a": 0, "b": 1, "zz": -1, None: -1}


def test_group_ids_keep_null_tuples(spark):
    df = frame(spark, [(1, "x"), (1, None), (0, "x"), (1, "x")], "a int, b string")
    out = sorted((r["a"], str(r["b"]), r["group_id"]) for r in ranking.group_ids(df, ["a", "b"]).collect())
    assert out == [(0, "x", 0), (1, "None", 1), (1, "x", 2), (1, "x", 2)]


def test_first_seen_codes_share_one_dictionary(spark):
    df = frame(spark, [(0, "p", "q"), (1, "r", "p"), (2, "p", "q")], "id long, a string, b string")
    out = ranking.first_seen_codes(df, "id", {"a": ["a"], "b": ["b"]}, 2)
    got = {(r["id"], r["combo"]): r["code"] for r in out.collect()}
    # first pass over a: p=1, r=2; then over b: q=3; r is seen once only
    assert got == {(0, "a"): 1, (1, "a"): -1, (2, "a"): 1, (0, "b"): 3, (1, "b"): 1, (2, "b"): 3}


def test_ring_next_pairs_all_of_a_group_of_two(spark):
    df = frame(spark, [(1, "g", 1.0), (2, "g", 2.0), (3, "h", 3.0), (4, "i", 4.0), (5, "i", 5.0), (6, "i", 6.0)], "id long, k string, v double")
    out = {(r["id"], r["id_b"]) for r in ranking.ring_next(df, ["k"], "id", ["v"]).collect()}
    assert out == {(1, 2), (2, 1), (4, 5), (5, 6), (6, 4)}


def test_kfold_sizes_and_stratified_shares(spark):
    df = spark.range(23).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    sizes = sorted(r["count"] for r in folds.kfold(df, "id", 5).groupBy("fold").count().collect())
    assert sizes == [4, 4, 5, 5, 5]
    per = folds.stratified(df, "id", "y", 4).groupBy("fold", "y").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in per if r["y"] == y]
        assert max(counts) - min(counts) <= 1


def test_hierarchical_fill_by_hand(spark):
    rows = [("a", "x", 10.0), ("a", "x", None), ("b", "x", 999.0), ("b", "x", None), ("c", "y", None), (None, "x", 20.0)]
    df = frame(spark, [(i, *r) for i, r in enumerate(rows)], "id long, k string, g string, age double")
    out = clean.hierarchical_median_fill(df, [["k"], ["g"]], "age").orderBy("id").collect()
    # b has no good value, so its rows take the median of group x: 10, 10, 20
    assert [r["age"] for r in out] == [10.0, 10.0, 10.0, 10.0, 10.0, 20.0]


def test_fitted_models_use_training_rows_only(spark):
    train = frame(spark, [(1.0,), (3.0,)], "x double")
    test = frame(spark, [(100.0,), (2.0,), (None,)], "x double")
    out = [r["x"] for r in clean.apply_scale(test, clean.fit_standardise(train, ["x"], ddof=0)).collect()]
    assert out == [98.0, 0.0, None]


def test_winsorise_keeps_nulls(spark):
    df = frame(spark, [(float(v),) for v in [0] * 20 + [100]] + [(None,)], "x double")
    x = pd.Series([0.0] * 20 + [100.0])
    bound = x.mean() + 3 * x.std(ddof=0)
    out = [r["x"] for r in clean.winsorise(df, ["x"]).collect()]
    assert out[-1] is None and out[20] == pytest.approx(bound) and out[0] == 0.0


def test_pool_skips_flat_columns_and_refits(spark):
    rows = [(i, 1.0 if i % 10 else float(i), float(i)) for i in range(40)]
    df = frame(spark, rows, "id long, q double, free double")
    pool = clean.fit_pool(df, ["q", "free"])
    assert pool.columns == ("q",)
    out = clean.apply_pool(df, pool)
    assert set(out.columns) == {"id", "free", "sft"}
    total = out.agg(F.sum("sft")).first()[0]
    assert total == pytest.approx(0.0, abs=1e-9)
    again = clean.apply_pool(df, pool, refit_stats=True).agg(F.sum("sft")).first()[0]
    assert again == pytest.approx(0.0, abs=1e-9)


def test_codes_of_few_values_leave_the_rows_where_they_are(spark):
    """A plain join would bring all rows of a value into one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("k"))
        for out in (ranking.apply_codes(df, ranking.fit_codes(df, "k"), "k"), ranking.rank_fraction(df, "k")):
            assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
        codes = {(r["k"], r["code"]) for r in ranking.apply_codes(df, ranking.fit_codes(df, "k"), "k").collect()}
        assert codes == {(None, -1), ("v1", 1), ("v2", 2)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
