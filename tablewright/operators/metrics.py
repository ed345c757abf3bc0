"""Scores of predictions, as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranking import ranked_values


def logloss(y: Column, p: Column) -> Column:
    """Mean of -log of the probability given to the true class; infinite if that is 0 anywhere."""
    right = F.when(y == 1, p).otherwise(1 - p)
    # log(0) is null in SQL, and a null would drop the row from the mean
    return F.avg(F.when(right == 0, F.lit(float("inf"))).otherwise(-F.log(right)))


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def r2(y: Column, p: Column) -> Column:
    return 1 - F.avg((y - p) * (y - p)) / F.var_pop(y)


def accuracy(y: Column, p: Column) -> Column:
    return F.avg((y == p).cast("double"))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve; tied scores share their average rank."""
    ranked = ranked_values(
        df.select(F.col(score).alias("_s"), F.col(label).cast("bigint").alias("_y")), ["_s"], F.sum("_y").alias("positives")
    )
    rank = F.col("before") + (F.col("n") + 1) / 2
    s = ranked.agg(
        F.sum(F.col("positives") * rank).alias("r"), F.sum("positives").cast("double").alias("p"), F.sum("n").cast("double").alias("n")
    )
    neg = F.col("n") - F.col("p")
    return s.select(F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * neg).alias("auc"))
