"""Linear maps of vectors: covariance, whitening, principal components, factors.

Fitting reduces the rows to a d x d matrix of sums; d is the vector width, so
what reaches the driver does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _stack(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype("float64")


def width_of(df: DataFrame, vec: str) -> int:
    d = df.agg(F.max(F.size(vec))).first()[0]
    if d is None:
        raise ValueError("no vector to fit on")
    return d


def mean_and_covariance(df: DataFrame, vec: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and covariance (divisor n) from one partial sum per partition."""
    d = width_of(df, vec)
    shift = np.array(df.select(vec).first()[0], dtype="float64")

    def fold(x: np.ndarray) -> np.ndarray:
        x = x - shift
        return np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])

    total = _partial_sums(df, vec, 1 + d + d * d, fold)
    n, s, g = total[0], total[1 : d + 1], total[d + 1 :].reshape(d, d)
    m = s / n
    return int(n), m + shift, g / n - np.outer(m, m)


@dataclass(frozen=True)
class Linear:
    """x -> (x - mean) @ weights, then an optional cosine feature map."""

    mean: np.ndarray
    weights: np.ndarray
    phase: np.ndarray | None = None

    def apply(self, df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
        mean, weights, phase = self.mean, self.weights, self.phase

        @F.pandas_udf("array<double>")
        def run(col: pd.Series) -> pd.Series:
            if not len(col):
                return pd.Series([], dtype=object)
            y = (_stack(col) - mean) @ weights
            if phase is not None:
                y = np.sqrt(2.0 / len(phase)) * np.cos(y + phase)
            return pd.Series(list(y))

        return df.withColumn(out or vec, run(F.col(vec)))


def fit_zca(train: DataFrame, vec: str, bias: float = 1e-12) -> Linear:
    """Decorrelate and keep the orientation."""
    _, mean, cov = mean_and_covariance(train, vec)
    val, rot = np.linalg.eigh(cov)
    return Linear(mean, rot @ np.diag(1.0 / np.sqrt(np.clip(val, 0, None) + bias)) @ rot.T)


def fit_pca(train: DataFrame, vec: str, k: int, whiten: bool = False) -> Linear:
    """Top-k components; the largest loading of each is positive."""
    _, mean, cov = mean_and_covariance(train, vec)
    val, rot = np.linalg.eigh(cov)
    order = np.argsort(val)[::-1][:k]
    val, rot = val[order], rot[:, order]
    rot = rot * np.sign(rot[np.abs(rot).argmax(0), np.arange(rot.shape[1])])
    return Linear(mean, rot / np.sqrt(val) if whiten else rot)


def fit_rff(width: int, k: int, gamma: float, seed: int = 1) -> Linear:
    """Random features whose inner products approximate exp(-gamma |x - y|^2)."""
    rng = np.random.RandomState(seed)
    weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (width, k))
    return Linear(np.zeros(width), weights, rng.uniform(0.0, 2.0 * np.pi, k))


def covariance_rows(df: DataFrame, vec: str) -> DataFrame:
    """(i, j, cov) rows of the covariance matrix, summed on the cluster."""
    n, _, cov = mean_and_covariance(df, vec)
    d = len(cov)
    frame = pd.DataFrame({"i": np.repeat(np.arange(d), d), "j": np.tile(np.arange(d), d), "cov": cov.ravel()})
    return df.sparkSession.createDataFrame(frame, "i int, j int, cov double")


BLOCK = 1 << 16  # cells of a partial sum per row


def _partial_sums(df: DataFrame, vec: str, size: int, fold: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all batches of ``fold(rows)``, a flat array of fixed size.

    Every task gives its sum in blocks; blocks are added in two steps, so no
    task adds more than a share of the partitions, and the driver gets one row
    per block.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc, seen = np.zeros(size), False
        for pdf in batches:
            if len(pdf):
                acc, seen = acc + fold(_stack(pdf[vec])), True
        if seen:
            for block, at in enumerate(range(0, size, BLOCK)):
                yield pd.DataFrame(
                    {
                        "share": [TaskContext.get().partitionId() % 32], "block": [block],
                        "cells": [acc[at : at + BLOCK].tobytes()],
                    }
                )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["cells"].iloc[0]).copy()
        for cells in pdf["cells"].iloc[1:]:
            total += np.frombuffer(cells)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "cells": [total.tobytes()]})

    sums = df.select(vec).mapInPandas(partial, "share int, block int, cells binary")
    for keys in (["share", "block"], ["block"]):
        sums = sums.groupBy(*keys).applyInPandas(add, "block int, cells binary")
    total = np.zeros(size)
    for r in sums.collect():
        total[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["cells"])
    return total


def _nonnegative_rows(x: np.ndarray, h: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Nonnegative least squares weights of rows x on the parts h, by coordinate descent."""
    gram, proj = h @ h.T, x @ h.T
    w = np.clip(proj / (gram.sum(1) + 1e-12), 0.0, None)
    for _ in range(rounds):
        for j in range(len(h)):
            w[:, j] = np.clip(w[:, j] + (proj[:, j] - w @ gram[:, j]) / (gram[j, j] + 1e-12), 0.0, None)
    return w


@dataclass(frozen=True)
class Parts:
    """Nonnegative parts: a row is close to weights @ parts."""

    parts: np.ndarray

    def apply(self, df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
        h = self.parts

        @F.pandas_udf("array<double>")
        def run(col: pd.Series) -> pd.Series:
            return pd.Series(list(_nonnegative_rows(_stack(col), h)) if len(col) else [], dtype=object)

        return df.withColumn(out or vec, run(F.col(vec)))


def fit_nmf(train: DataFrame, vec: str, k: int, iterations: int = 10, seed: int = 1) -> Parts:
    """Nonnegative factors of nonnegative rows.

    Given the parts, every row's weights follow from that row alone, so one
    pass yields the k x k and k x d sums from which the driver improves the
    parts. The weights are never stored between passes.
    """
    d = width_of(train, vec)
    h = np.random.RandomState(seed).uniform(0.1, 1.0, (k, d))
    for _ in range(iterations):
        fixed = h

        def fold(x: np.ndarray) -> np.ndarray:
            w = _nonnegative_rows(x, fixed)
            return np.concatenate([(w.T @ w).ravel(), (w.T @ x).ravel()])

        sums = _partial_sums(train, vec, k * k + k * d, fold)
        gram, proj = sums[: k * k].reshape(k, k), sums[k * k :].reshape(k, d)
        h = h.copy()
        for _ in range(20):
            for j in range(k):
                h[j] = np.clip(h[j] + (proj[j] - gram[j] @ h) / (gram[j, j] + 1e-12), 1e-9, None)
    return Parts(h)
