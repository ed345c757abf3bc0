"""Many logistic regressions at once from shared sums.

A fit is a setting C, a choice of columns and a fold that is held out. All fits
read the same rows, so one pass gives the loss, gradient and Gram matrix of
every fit; a Newton step for all of them follows on the driver. Tasks send on
one row per fit, which are added up by fit before anything is collected, so the
driver sees (columns + 1) squared numbers per fit, whatever the number of rows.
Fits are warm-started from those given, if any.

Loss: weighted log loss, plus the squared coefficients over 2 C; the intercept is free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranking import positioned

#: Columns a fit may have: its Gram matrix is held in memory.
MOST_COLUMNS = 2000
_STEPS = 40


@dataclass(frozen=True)
class Fit:
    """``columns`` are positions in the features (None: all); ``fold`` is left out (None: no rows are)."""

    c: float
    columns: tuple[int, ...] | None = None
    fold: int | None = None


def spread(df: DataFrame, row_id: str) -> DataFrame:
    """Rows dealt by a hash of their id over the session's shuffle partitions, however few files they came from."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), row_id)


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Features with a leading 1, label, weight and fold."""
    x = batch["features"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    return x, *(batch[c].to_numpy(zero_copy_only=False) for c in ("label", "weight", "fold"))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _sums(rows: DataFrame, fits: Sequence[Fit], beta: np.ndarray) -> np.ndarray:
    """(fits, 1 + p + p * p): loss, gradient and Gram matrix of each fit at its coefficients, penalties left out."""
    folds = [f.fold for f in fits]
    width = beta.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(folds), 1 + width + width * width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, w, fold = _matrices(batch)
            z = x @ beta.T
            p = _sigmoid(z)
            for j, held in enumerate(folds):
                used = w if held is None else np.where(fold == held, 0.0, w)
                total[j, 0] += (used * (np.logaddexp(0, z[:, j]) - y * z[:, j])).sum()
                total[j, 1 : 1 + width] += x.T @ (used * (p[:, j] - y))
                total[j, 1 + width :] += ((x.T * (used * p[:, j] * (1 - p[:, j]))) @ x).reshape(-1)
        yield record(np.arange(len(folds)), total)

    def record(fit: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(fit.astype(np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["fit", "sums"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for fit, sums in zip(batch["fit"].to_pylist(), batch["sums"]):
                values = sums.values.to_numpy(zero_copy_only=False)
                total[fit] = total[fit] + values if fit in total else values
        if total:
            yield record(np.array(list(total)), np.stack(list(total.values())))

    schema = "fit int, sums array<double>"
    partial = rows.select("features", "label", "weight", "fold").mapInArrow(part, schema)
    out = np.zeros((len(folds), 1 + width + width * width))
    for r in partial.repartition("fit").mapInArrow(added, schema).collect():
        out[r["fit"]] += np.array(r["sums"])
    return out


def fit_logistic(rows: DataFrame, fits: Sequence[Fit], start: np.ndarray | None = None, tolerance: float = 1e-5) -> np.ndarray:
    """(fits, 1 + columns) coefficients, intercept first; 0 for columns that a fit does not use.

    ``rows`` has features (array of double, all of one length), label (0 or 1),
    weight and fold; they are read once per Newton step.
    """
    first = rows.select(F.size("features").alias("n")).first()
    if first is None:
        return np.zeros((len(fits), 1))
    width = 1 + first["n"]
    if width > MOST_COLUMNS:
        raise ValueError(f"{width - 1} columns; a Gram matrix is held for at most {MOST_COLUMNS}")
    used = np.zeros((len(fits), width), bool)
    used[:, 0] = True
    for j, f in enumerate(fits):
        used[j, 1:] = True if f.columns is None else np.isin(np.arange(width - 1), f.columns)
    penalty = np.array([[0.0] + [1 / f.c] * (width - 1) for f in fits])
    beta = np.where(used, 0.0 if start is None else start, 0.0)
    step, before = np.zeros_like(beta), np.full(len(fits), np.inf)
    open_fits = np.arange(len(fits))
    for _ in range(_STEPS):
        sums = _sums(rows, [fits[j] for j in open_fits], beta[open_fits])
        still = []
        for j, s in zip(open_fits, sums):
            loss = s[0] + (penalty[j] * beta[j] ** 2).sum() / 2
            if loss > before[j] + 1e-9 * abs(before[j]):  # too far: go half of the way back
                step[j] /= 2
                beta[j] -= step[j]
                still.append(j)
                continue
            before[j] = loss
            at = np.flatnonzero(used[j])
            gradient = s[1 : 1 + width][at] + penalty[j][at] * beta[j][at]
            gram = s[1 + width :].reshape(width, width)[np.ix_(at, at)] + np.diag(penalty[j][at])
            step[j] = 0.0
            step[j][at] = -np.linalg.lstsq(gram, gradient, rcond=None)[0]
            beta[j] += step[j]
            if np.abs(step[j]).max() > tolerance:
                still.append(j)
        open_fits = np.array(still, int)
        if not len(open_fits):
            break
    return beta


def held_out_auc(rows: DataFrame, fits: Sequence[Fit], beta: np.ndarray) -> list[float]:
    """Exact AUC of each fit on the fold it left out (nan if that has one class), all from one global order.

    Equal scores are counted first, so few distinct ones mean few rows to sort.
    """
    held = [f.fold for f in fits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, w, fold = _matrices(batch)
            for j, f in enumerate(held):
                at = np.flatnonzero(fold == f)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), j, np.int32)), pa.array(x[at] @ beta[j]), pa.array(w[at] * y[at]), pa.array(w[at] * (1 - y[at]))],
                        ["fit", "score", "pos", "neg"],
                    )

    scored = rows.select("features", "label", "weight", "fold").mapInArrow(run, "fit int, score double, pos double, neg double")
    counted = scored.groupBy("fit", F.round("score", 12).alias("score")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    placed = positioned(counted, ["fit", "score"], pos="at", weight="neg")
    sums = placed.groupBy("fit").agg(
        F.sum(F.col("pos") * (F.col("before") + F.col("neg") / 2)).alias("over"),
        F.min("before").alias("base"), F.sum("pos").alias("p"), F.sum("neg").alias("n"),
    )
    out = [float("nan")] * len(fits)
    for r in sums.collect():
        if r["p"] and r["n"]:
            out[r["fit"]] = (r["over"] - r["base"] * r["p"]) / (r["p"] * r["n"])
    return out


def cross_validated(
    rows: DataFrame, settings: Sequence[tuple[float, tuple[int, ...] | None]], k: int, start: np.ndarray | None = None
) -> tuple[list[float], np.ndarray]:
    """Mean AUC over ``k`` folds of each (C, columns), all fitted side by side, and the coefficients of all fits.

    Coefficients, and those to ``start`` from, are (settings * k, 1 + columns), fold by fold.
    """
    fits = [Fit(c, columns, i) for c, columns in settings for i in range(k)]
    beta = fit_logistic(rows, fits, start)
    scores = np.array(held_out_auc(rows, fits, beta)).reshape(len(settings), k)
    means = [float(np.nanmean(s)) if not np.isnan(s).all() else float("nan") for s in scores]
    return means, beta


def counted_rows(df: DataFrame, cols: Sequence[str], label: str, fold: str) -> DataFrame:
    """(cols as text, label, weight, fold): one row per combination, weighted by its rows.

    Fits read these, so the large table is passed over once, and that is a sum.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols], F.col(label).alias("label"), F.col(fold).alias("fold"))
    return texts.groupBy(*cols, "label", "fold").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def levels(counted: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values of each column; one-hot columns in all, so at most ``MOST_COLUMNS``."""
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).alias("value")) for i, c in enumerate(cols)])
    rows = counted.select(F.explode(cells).alias("c")).select("c.*").distinct().limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} categories")
    order = lambda v: (v is None, v)
    return {c: sorted((r["value"] for r in rows if r["at"] == i), key=order) for i, c in enumerate(cols)}


def one_hot_rows(counted: DataFrame, found: dict[str, list[str]]) -> DataFrame:
    """(features, label, weight, fold) of counted rows."""
    hot = [F.col(c).eqNullSafe(F.lit(v)).cast("double") for c, values in found.items() for v in values]
    return counted.select(F.array(*hot).alias("features"), "label", "weight", "fold")


class Selection:
    """Cross-validated scores of sets of categorical features.

    Sets named to ``ahead`` are fitted together, each starting where the
    largest known part of it ended; a set asked for alone is fitted alone.
    """

    def __init__(self, rows: DataFrame, found: dict[str, list[str]], k: int, c: float = 4.0) -> None:
        self.rows, self.k, self.c = rows, k, c
        self.columns, at = {}, 0
        for name, values in found.items():
            self.columns[name] = tuple(range(at, at + len(values)))
            at += len(values)
        self.width = 1 + at
        self.known: dict[frozenset, tuple[float, np.ndarray]] = {}

    def __call__(self, subset: Sequence[str]) -> float:
        self.ahead([subset])
        return self.known[frozenset(subset)][0]

    def ahead(self, subsets: Sequence[Sequence[str]]) -> None:
        new = [s for s in dict.fromkeys(map(frozenset, subsets)) if s not in self.known]
        if not new:
            return
        settings = [(self.c, tuple(sorted(i for f in s for i in self.columns[f]))) for s in new]
        start = np.zeros((len(new) * self.k, self.width))
        for i, s in enumerate(new):
            parts = [p for p in self.known if p < s]
            if parts:
                start[i * self.k : (i + 1) * self.k] = self.known[max(parts, key=len)][1]
        scores, beta = cross_validated(self.rows, settings, self.k, start)
        for i, s in enumerate(new):
            self.known[s] = scores[i], beta[i * self.k : (i + 1) * self.k]
