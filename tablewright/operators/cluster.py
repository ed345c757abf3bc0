"""Clustering of categorical and mixed rows.

The k centroids are small and travel as literals, so assigning is a
projection and updating is one aggregation. Nothing carries over between
rounds but the centroids: lineage does not grow.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Centroids:
    """One dict of column values per cluster."""

    cat: tuple[Mapping[str, str], ...]
    num: tuple[Mapping[str, float], ...] = ()
    gamma: float = 1.0

    @property
    def k(self) -> int:
        return len(self.cat)


def equal_rows(df: DataFrame, cols: Sequence[str], weight: str = "weight") -> DataFrame:
    """The different rows and how often each occurs: what rounds and starts read instead of all rows."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(weight))


def frequent_rows(df: DataFrame, cols: Sequence[str], k: int, weight: str | None = None) -> list[dict[str, str]]:
    """The k most frequent tuples, sorted values on ties."""
    texts = [F.col(c).cast("string").alias(c) for c in cols]
    n = F.sum("_w") if weight else F.count(F.lit(1))
    top = df.select(*texts, (F.col(weight) if weight else F.lit(1)).alias("_w")).groupBy(*cols).agg(n.alias("n")).orderBy(F.col("n").desc(), *cols).limit(k)
    return [{c: r[c] for c in cols} for r in top.collect()]


def distance(c: Centroids, k: int) -> Column:
    """Squared numeric distance plus gamma per mismatch to one centroid."""
    d = F.lit(0.0)
    for col, v in c.cat[k].items():
        d = d + F.when(F.col(col).cast("string").eqNullSafe(F.lit(v).cast("string")), F.lit(0.0)).otherwise(F.lit(c.gamma))
    for col, v in c.num[k].items() if c.num else ():
        x = F.col(col) - F.lit(v).cast("double")
        d = d + x * x
    return d


def assign(df: DataFrame, c: Centroids, cluster: str = "cluster", cost: str = "cost") -> DataFrame:
    """Nearest centroid, the first one on ties."""
    nearest = F.array_min(F.array(*[F.struct(distance(c, k).alias("d"), F.lit(k).alias("k")) for k in range(c.k)]))
    return df.withColumn("_near", nearest).withColumns(
        {cluster: F.col("_near.k"), cost: F.col("_near.d")}
    ).drop("_near")


def modes(assigned: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(cluster, feature, value, n): most frequent value per cluster and column, smallest on ties."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    long = assigned.select("cluster", F.explode(F.array(*entries)).alias("_e")).select("cluster", "_e.*")
    counted = long.groupBy("cluster", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("cluster", "feature").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"))
    return best.select("cluster", "feature", F.col("b.value").alias("value"), (-F.col("b.m")).alias("n"))


def update(df: DataFrame, c: Centroids, weight: str | None = None) -> tuple[Centroids, float]:
    """One round in one job: new centroids and the cost under the old ones.

    An empty cluster stays where it is. A row counts ``weight`` times.
    """
    w = F.col(weight) if weight else F.lit(1)
    cats, nums = list(c.cat[0]), list(c.num[0]) if c.num else []
    entry = lambda f, v, x: F.struct(
        F.lit(f).alias("feature"), v.cast("string").alias("value"), x.cast("double").alias("x")
    )
    none = F.lit(None)
    entries = [entry(f, F.col(f), F.lit(0.0)) for f in cats] + [entry(f, none, F.col(f)) for f in nums]
    entries.append(entry("\0cost", none, F.col("cost")))
    long = assign(df, c).select("cluster", w.alias("_w"), F.explode(F.array(*entries)).alias("_e")).select("cluster", "_w", "_e.*")
    counted = long.groupBy("cluster", "feature", "value").agg(F.sum("_w").alias("n"), F.sum(F.col("x") * F.col("_w")).alias("x"))
    rows = counted.groupBy("cluster", "feature").agg(
        F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"), F.sum("n").alias("n"), F.sum("x").alias("x")
    ).collect()  # clusters x columns rows
    cat, num, cost = [dict(m) for m in c.cat], [dict(m) for m in c.num], 0.0
    for r in rows:
        if r["feature"] == "\0cost":
            cost += r["x"]
        elif r["feature"] in nums:
            num[r["cluster"]][r["feature"]] = r["x"] / r["n"]
        else:
            cat[r["cluster"]][r["feature"]] = r["b"]["value"]
    return Centroids(tuple(cat), tuple(num), c.gamma), cost


def fit(df: DataFrame, start: Centroids, max_iters: int = 20, weight: str | None = None) -> tuple[Centroids, list[float]]:
    """Repeat until the cost stops falling."""
    costs: list[float] = []
    best = start
    for _ in range(max_iters):
        new, cost = update(df, best, weight)
        costs.append(cost)
        if new == best or (len(costs) > 1 and costs[-1] >= costs[-2]):
            break
        best = new
    return best, costs


#: Counted cells (value, cluster) a task of ``update_many`` holds before it hands them on.
_CELLS = 1 << 22


def update_many(df: DataFrame, sets: Sequence[Centroids], weight: str | None = None) -> list[tuple[Centroids, float]]:
    """``update`` of several sets over the same columns in one job; a missing number does not count in a mean.

    Tasks add up weights by value for all clusters at once; those of a value
    meet in one task, which keeps the most frequent value per cluster.
    """
    cats, nums = list(sets[0].cat[0]), list(sets[0].num[0]) if sets[0].num else []
    begin = np.cumsum([0, *(c.k for c in sets)])
    total = int(begin[-1])
    values = {f: [m[f] for c in sets for m in c.cat] for f in cats}
    means = {f: np.array([m[f] for c in sets for m in c.num], float) for f in nums}
    gammas = [c.gamma for c in sets]

    def frame(sums: Mapping[tuple[str, str | None], np.ndarray]) -> pd.DataFrame:
        feature, value = zip(*sums) if sums else ((), ())
        return pd.DataFrame({"feature": feature, "value": pd.Series(value, dtype=object), "n": [row.tobytes() for row in sums.values()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[str, str | None], np.ndarray] = {}
        sums = {(f, x): np.zeros(total) for f in nums for x in "nx"}
        cost = np.zeros(len(sets))
        for pdf in batches:
            w = pdf["_w"].to_numpy(float)
            number = {f: pdf[f].to_numpy(float) for f in nums}
            codes, codes_of, tables = {}, {}, {}
            for f in cats:
                codes[f], found = pd.factorize(pdf[f], use_na_sentinel=False)
                known = {None if pd.isna(v) else v: i for i, v in enumerate(found)}
                codes_of[f] = np.array([known.get(v, -1) for v in values[f]])
                tables[f] = list(known), np.zeros((len(known), total))
            for s, (lo, hi) in enumerate(zip(begin[:-1], begin[1:])):
                d = np.zeros((len(pdf), hi - lo))
                for f in cats:
                    d += np.where(codes[f][:, None] == codes_of[f][lo:hi], 0.0, gammas[s])
                for f in nums:
                    d += (number[f][:, None] - means[f][lo:hi]) ** 2
                near = d.argmin(1)
                cost[s] += np.nansum(d[np.arange(len(pdf)), near] * w)
                for f in cats:
                    kinds, table = tables[f]
                    table[:, lo:hi] = np.bincount(codes[f] * (hi - lo) + near, w, len(kinds) * (hi - lo)).reshape(-1, hi - lo)
                for f in nums:
                    known = ~np.isnan(number[f])
                    sums[f, "n"][lo:hi] += np.bincount(near[known], w[known], hi - lo)
                    sums[f, "x"][lo:hi] += np.bincount(near[known], (number[f] * w)[known], hi - lo)
            for f, (kinds, table) in tables.items():
                for value, row in zip(kinds, table):
                    counts[f, value] = counts[f, value] + row if (f, value) in counts else row
            if len(counts) * total > _CELLS:
                yield frame(counts)
                counts = {}
        yield frame({**counts, **sums, ("\0cost", None): cost})

    def most(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str | None], np.ndarray] = {}
        for pdf in batches:
            for f, v, n in zip(pdf["feature"], pdf["value"], pdf["n"]):
                key, row = (f, None if pd.isna(v) else v), np.frombuffer(n)
                held[key] = held[key] + row if key in held else row
        out = {k: row for k, row in held.items() if k[0] not in cats}
        pdf = frame(out).assign(values=None)
        for f in cats:
            some = sorted((k[1] for k in held if k[0] == f), key=lambda v: (v is not None, v or ""))
            if some:
                table = np.stack([held[f, v] for v in some])
                best = [some[i] for i in table.argmax(0)]
                pdf = pd.concat([pdf, pd.DataFrame({"feature": [f], "value": [None], "n": [table.max(0).tobytes()], "values": [best]})])
        yield pdf

    texts = [F.col(c).cast("string").alias(c) for c in cats]
    rows = df.select(*texts, *[F.col(c).cast("double").alias(c) for c in nums], (F.col(weight) if weight else F.lit(1)).alias("_w"))
    parts = rows.mapInPandas(add, "feature string, value string, n binary").repartition("feature", "value")
    # per task of the second step clusters x columns numbers
    found = parts.mapInPandas(most, "feature string, value string, n binary, values array<string>").collect()
    cat, num = [dict(m) for c in sets for m in c.cat], [dict(m) for c in sets for m in c.num]
    sums, top = {}, {f: [(0.0, None)] * total for f in cats}
    for r in found:
        row = np.frombuffer(r["n"])
        if r["feature"] not in cats:
            sums[r["feature"], r["value"]] = row
            continue
        for at in np.flatnonzero(row):
            value, (n, best) = r["values"][at], top[r["feature"]][at]
            if (-row[at], value is not None, value or "") < (-n, best is not None, best or ""):
                top[r["feature"]][at] = row[at], value
    for f in cats:
        for at, (n, value) in enumerate(top[f]):
            if n > 0:
                cat[at][f] = value
    for f in nums:
        for at in np.flatnonzero(sums[f, "n"]) if sums else ():
            num[at][f] = float(sums[f, "x"][at] / sums[f, "n"][at])
    costs = sums["\0cost", None] if sums else np.zeros(len(sets))
    return [
        (Centroids(tuple(cat[lo:hi]), tuple(num[lo:hi]), c.gamma), float(cost))
        for c, lo, hi, cost in zip(sets, begin[:-1], begin[1:], costs)
    ]


def fit_many(
    df: DataFrame, starts: Sequence[Centroids], max_iters: int = 100, weight: str | None = None
) -> list[tuple[Centroids, float]]:
    """(centroids, cost) of ``fit`` from several starts; a round is one job for all that still move."""
    best, costs, moving = list(starts), [float("inf")] * len(starts), list(range(len(starts)))
    for _ in range(max_iters):
        still = []
        for i, (new, cost) in zip(moving, update_many(df, [best[i] for i in moving], weight)):
            if new != best[i] and cost < costs[i]:
                best[i] = new
                still.append(i)
            costs[i] = min(cost, costs[i])
        if not (moving := still):
            break
    return list(zip(best, costs))


def huang_starts(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], ks: Sequence[int], gamma: float, weight: str | None = None, seed: int = 1
) -> list[Centroids]:
    """Starts after Huang (1998), one per entry of ``ks``.

    Every category of a centroid is drawn by its frequency; the centroid then
    becomes the nearest tuple that occurs and that its start does not have yet
    (the smallest on ties). Numbers are drawn around the mean.
    """
    total = sum(ks)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cat], (F.col(weight) if weight else F.lit(1)).alias("_w"))
    tuples = texts.groupBy(*cat).agg(F.sum("_w").alias("_w")).persist()
    long = tuples.select("_w", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in cat])).alias("e"))
    values = long.groupBy("e.feature", "e.value").agg(F.sum("_w").alias("n"))
    # the least of exponential times is that of a value as often as its rate asks for
    even = (F.pmod(F.xxhash64(F.lit(f"huang {seed}"), "feature", F.coalesce("value", F.lit("\0")), "j"), F.lit(1 << 52)) + 0.5) / (1 << 52)
    each = values.select("feature", "value", "n", F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("j"))
    drawn = each.groupBy("feature", "j").agg(F.min(F.struct((-F.log(even) / F.col("n")).alias("t"), "value")).alias("d")).collect()
    wish = [{} for _ in range(total)]
    for r in drawn:
        wish[r["j"]][r["feature"]] = r["d"]["value"]
    size = np.repeat(ks, ks)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each task, as many tuples per centroid as its start has centroids."""
        for pdf in batches:
            pdf = pdf.sort_values(list(cat), na_position="first", kind="stable")
            columns = {c: pdf[c].where(pdf[c].notna(), None).to_numpy(object) for c in cat}
            far = [sum((columns[c] != want[c]).astype(int) for c in cat) for want in wish]
            at = [np.argsort(d, kind="stable")[:k] for d, k in zip(far, size)]
            rows = np.concatenate(at)
            yield pd.DataFrame(
                {"j": np.repeat(np.arange(len(at)), [len(a) for a in at]), "d": np.concatenate([d[a] for d, a in zip(far, at)]),
                 **{c: columns[c][rows] for c in cat}}
            )

    kind = ", ".join(f"`{c}` string" for c in cat)
    near = tuples.select(*cat).mapInPandas(nearest, f"j int, d int, {kind}")
    limit = F.element_at(F.array(*[F.lit(int(k)) for k in size]), F.col("j") + 1)
    some = near.groupBy("j").agg(F.array_sort(F.collect_list(F.struct("d", *cat))).alias("t"))
    lists = {r["j"]: r["t"] for r in some.select("j", F.slice("t", F.lit(1), limit).alias("t")).collect()}
    tuples.unpersist()
    w = F.col(weight) if weight else F.lit(1)
    moments = df.select(w.alias("_w"), *[F.col(c).cast("double").alias(c) for c in num]).agg(
        F.lit(0).alias("_none"),
        *[F.sum(F.when(F.col(c).isNotNull(), F.col("_w"))).alias(f"n_{c}") for c in num],
        *[F.sum(F.col(c) * F.col("_w")).alias(f"s_{c}") for c in num],
    ).first()
    mean = {c: (moments[f"s_{c}"] or 0.0) / (moments[f"n_{c}"] or 1) for c in num}
    spread = df.agg(F.lit(0).alias("_none"), *[F.sum((F.col(c) - mean[c]) * (F.col(c) - mean[c]) * w).alias(c) for c in num]).first()
    std = {c: float(np.sqrt((spread[c] or 0.0) / (moments[f"n_{c}"] or 1))) for c in num}
    rng, out, j = np.random.default_rng(seed), [], 0
    for k in ks:
        used: list[dict[str, str]] = []
        for t in (lists.get(i, []) for i in range(j, j + k)):
            found = [{c: r[c] for c in cat} for r in t]
            used += [m for m in found if m not in used][:1] or found[:1]
        numbers = tuple({c: mean[c] + std[c] * float(rng.standard_normal()) for c in num} for _ in used) if num else ()
        out.append(Centroids(tuple(used), numbers, gamma))
        j += k
    return out


def kprototypes(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], ks: Sequence[int], gamma: float,
    weight: str | None = None, pre_runs: int = 5, percentile: float = 50, max_iters: int = 100, seed: int = 1,
) -> dict[int, Centroids]:
    """Centroids per k, of the first run whose cost is at most the percentile of the costs of preliminary runs.

    All preliminary runs of all k go together, and so do further ones, ``pre_runs`` more for every k still open.
    """
    limit: dict[int, float] = {}
    out: dict[int, Centroids] = {}
    while len(out) < len(set(ks)):
        todo = [k for k in dict.fromkeys(ks) if k not in out for _ in range(pre_runs)]
        found = fit_many(df, huang_starts(df, cat, num, todo, gamma, weight, seed), max_iters, weight)
        for k in dict.fromkeys(todo):
            runs = [r for r, of in zip(found, todo) if of == k]
            if k not in limit:
                limit[k] = float(np.percentile([cost for _, cost in runs], percentile))
            else:
                good = [c for c, cost in runs if cost <= limit[k]]
                if good:
                    out[k] = good[0]
        seed += 1
    return out


def kmodes(df: DataFrame, cols: Sequence[str], k: int, max_iters: int = 20) -> tuple[Centroids, list[float]]:
    return fit(df, Centroids(tuple(frequent_rows(df, cols, k))), max_iters)


def start_prototypes(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], k: int, gamma: float, weight: str | None = None
) -> Centroids:
    """Frequent tuples with the mean numbers of their rows."""
    tuples = frequent_rows(df, cat, k, weight)
    if not num:
        return Centroids(tuple(tuples), (), gamma)
    w = F.col(weight) if weight else F.lit(1)
    mean = lambda x: F.sum(x * w) / F.sum(F.when(x.isNotNull(), w)) if weight else F.avg(x)
    row = df.agg(
        *[
            mean(F.when(_same(t), F.col(c))).alias(f"{i}_{c}")
            for i, t in enumerate(tuples)
            for c in num
        ]
    ).first()
    return Centroids(
        tuple(tuples), tuple({c: row[f"{i}_{c}"] for c in num} for i in range(len(tuples))), gamma
    )


def _same(t: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for c, v in t.items():
        cond = cond & F.col(c).cast("string").eqNullSafe(F.lit(v))
    return cond
