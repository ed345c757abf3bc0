"""Model jobs on Spark ML: settings, cross-validation, selection, stacking."""

from __future__ import annotations

import math
import random
import statistics
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.newton import cross_validated


def auc_evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (2 * n_class) per row: one number per class is read to the driver."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    n, k = sum(counts.values()), len(counts)
    w = F.lit(1.0)
    for value, c in counts.items():
        w = F.when(F.col(label) == value, F.lit(n / (k * c))).otherwise(w)
    return df.withColumn(out, w)


def logistic(c: float, n: int, penalty: str = "l2", intercept: bool = True, weight: str | None = None, label: str = "label", iterations: int = 25) -> LogisticRegression:
    """The inverse-strength setting C becomes regParam = 1 / (C n)."""
    lr = LogisticRegression(
        labelCol=label, regParam=1.0 / (c * n), elasticNetParam=1.0 if penalty == "l1" else 0.0,
        fitIntercept=intercept, standardization=False, maxIter=iterations,
    )
    return lr.setWeightCol(weight) if weight else lr


def forest_classifier(trees: int, depth: int, min_leaf: int, label: str = "label", seed: int = 1) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt", seed=seed,
    )


#: Rows of a task of a forest, which holds all of its share as bins at once.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by their keys into parts of about ``TASK_ROWS`` rows, as many as there are cores at least."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-rows // TASK_ROWS)), *keys)


def forest_regressor(trees: int, depth: int, min_leaf: int, subset: str, label: str, seed: int = 1) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset, seed=seed,
    )


def boosting(stages: int, depth: int, min_leaf: int, subset: str = "0.25", subsample: float = 0.5, label: str = "label", seed: int = 1) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label, maxIter=stages, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset, subsamplingRate=subsample, seed=seed,
    )


def positive(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def importances(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance), largest first."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def fitted(estimator: Estimator, df: DataFrame) -> Model:
    """The fitted model without its training summary.

    A summary holds the session, and a session that has served an Observation cannot be sent to tasks.
    """
    model = estimator.fit(df)
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
    return model


def fold_scores(df: DataFrame, model: Estimator, fold: str, k: int, evaluator: Evaluator, parallelism: int = 4) -> list[float]:
    """Score on each fold of a model fitted on the others; folds are plain filters on a column."""

    def one(i: int) -> float:
        trained = fitted(model.copy(), df.where(F.col(fold) != i))
        return evaluator.evaluate(trained.transform(df.where(F.col(fold) == i)))

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(one, range(k)))


def cv_score(df: DataFrame, model: Estimator, fold: str, k: int, evaluator: Evaluator, parallelism: int = 4) -> tuple[float, float]:
    """Mean and half the standard deviation of the fold scores."""
    scores = fold_scores(df, model, fold, k, evaluator, parallelism)
    return statistics.fmean(scores), statistics.pstdev(scores) / 2


def forward_selection(
    score: Callable[[Sequence[str]], float], features: Sequence[str], ahead: Callable[[list[list[str]]], None] | None = None
) -> list[tuple[str, float]]:
    """Add the best feature until the score stops rising; the one that did not help is dropped.

    ``ahead`` is told the sets of a round before they are scored one by one.
    """
    chosen: list[tuple[str, float]] = []
    while len(chosen) < len(features):
        have = [f for f, _ in chosen]
        rest = [f for f in features if f not in have]
        if ahead:
            ahead([[*have, f] for f in rest])
        best, name = max((score([*have, f]), f) for f in rest)
        if chosen and best <= chosen[-1][1]:
            break
        chosen.append((name, best))
    return chosen


EARLY_SHARE = 0.3679  # 1 / e


def approximate_selection(
    score: Callable[[Sequence[str]], float], features: Sequence[str], seed: int = 1,
    ahead: Callable[[list[list[str]]], None] | None = None,
) -> list[tuple[str, float]]:
    """Forward selection in shuffled order with pruning.

    A candidate worse than the best score so far is out for good; once 1/e of
    a round has been tried, the first improvement ends the round. ``ahead`` is
    told what a round may score.
    """
    rng = random.Random(seed)
    remain = list(features)
    chosen: list[tuple[str, float]] = []
    best_so_far = -math.inf
    while remain:
        order = rng.sample(remain, len(remain))
        enough = EARLY_SHARE * len(remain)
        kept: list[tuple[float, str]] = []
        if ahead:
            ahead([[*(c for c, _ in chosen), f] for f in order])
        for tried, f in enumerate(order, 1):
            s = score([*(c for c, _ in chosen), f])
            if s < best_so_far:
                remain.remove(f)
                continue
            is_new_best = not kept or s > max(kept)[0]
            kept.append((s, f))
            if is_new_best and tried > enough and s > best_so_far:
                break
        if not kept:
            break
        s, f = max(kept)
        remain.remove(f)
        # a tie drops the feature and goes on with the others
        if s > best_so_far:
            chosen.append((f, s))
            best_so_far = s
    return chosen


def c_grid(current: float, low: float = -3.0, high: float = 4.0, steps: int = 20) -> list[float]:
    """The current value and a base-2 logarithmic range."""
    return [current, *[2.0 ** (low + (high - low) * i / (steps - 1)) for i in range(steps)]]


def sweep_c(rows: DataFrame, k: int, values: Sequence[float]) -> list[tuple[float, float]]:
    """(C, cross-validated AUC) per value; all values and folds are fitted from the same passes over ``rows``."""
    scores, _ = cross_validated(rows, [(c, None) for c in values], k)
    return list(zip(values, scores))


def best_c(scores: Sequence[tuple[float, float]]) -> tuple[float, float]:
    """Best (C, score), ties to the larger C."""
    s, c = max((s, c) for c, s in scores)
    return c, s


def out_of_fold(df: DataFrame, models: Mapping[str, Estimator], fold: str, k: int, keep: Sequence[str]) -> DataFrame:
    """Level-one probabilities of every row from models that have not seen its fold."""
    parts = []
    jobs = [(i, m) for i in range(k) for m in models.values()]
    with ThreadPoolExecutor(4) as pool:
        trained = iter(list(pool.map(lambda j: fitted(j[1], df.where(F.col(fold) != j[0])), jobs)))
    for i in range(k):
        held = df.where(F.col(fold) == i)
        for name in models:
            held = next(trained).transform(held).withColumn(name, positive()).drop("rawPrediction", "probability", "prediction")
        parts.append(held.select(*keep, *models))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def per_group(
    train: DataFrame, df: DataFrame, group: str, values: Sequence[str], model: Callable[[], Estimator],
    keep: Sequence[str], parallel: int = 4,
) -> DataFrame:
    """One model for each of the named groups, fitted side by side; rows of all other groups, or none, get a pooled one."""
    parts = [F.col(group) == v for v in values]
    with ThreadPoolExecutor(parallel) as pool:
        pooled = pool.submit(lambda: fitted(model(), train))
        trained = list(pool.map(lambda part: fitted(model(), train.where(part)), parts))
    others = F.col(group).isNull() | ~F.col(group).isin(list(values))
    out = pooled.result().transform(df.where(others)).select(*keep, positive().alias("p"))
    for part, m in zip(parts, trained):
        out = out.unionByName(m.transform(df.where(part)).select(*keep, positive().alias("p")))
    return out


def rbf_regression(df: DataFrame, label: str, features: str, reg: float = 0.01) -> Model:
    """Linear regression on already lifted (random rbf) features."""
    return LinearRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=0.0, solver="normal" if reg else "auto").fit(df)
