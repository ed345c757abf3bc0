"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of each whole text are one projection of built-in functions, and
are written once. A small random forest is grown on labelled rows; every path
from a root to a node is a conjunction of thresholds and becomes a 0/1 rule.
A logistic regression with an L1 penalty weighs the rules and drops most of
them. What is left is compiled to one column expression, so scoring is a
projection.

The model is fitted on at most ``max_rows`` labelled rows, chosen by the hash
of their id; everything else covers all rows.

Defined results: a null text counts as empty; its statistics are 0 and it is
scored like any other. Several labels of one id count as their mean, rounded
to the nearer class, ties as 1; null labels do not count. Without both classes,
or any split between them, the score is the share of class 1 (0.5 without any
label). A null id counts as
the empty text. Labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SPACE, WORD, discard, documents, staged, whole
from tablewright.llm.registry import query

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, at most?, threshold) and ...


@dataclass(frozen=True)
class Settings:
    trees: int = 12
    depth: int = 3
    penalty: float = 0.001
    max_rows: int = 200_000
    seed: int = 11
    threshold: float = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Counts over the whole text, as shares where length should not matter."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    n = F.col("n_words").cast("double")
    share = lambda c: F.when(n > 0, c / n).otherwise(0.0)
    return {
        "log_words": F.log1p(n),
        "word_length": share(F.length(F.regexp_replace(text, SPACE, "")).cast("double")),
        "distinct_words": share(F.size(F.array_distinct("words")).cast("double")),
        "symbols": share(count(r"[#*$%&|<>]")),
        "bangs": share(count(r"[!?]{2,}")),
        "separators": share(count(r"(?:^|[\x20\x09-\x0D])[|›»•·]")),
        "capitals": share(count(r"\p{Lu}")),
        "digits": share(count(r"[0-9]")),
        "sentence_ends": share(count(r"[.!?…][\x20\x09-\x0D]")),
        "commas": share(count(r"[,;:]")),
        "lines": share(F.size("lines").cast("double")),
        "repeated_lines": F.when(
            F.size("lines") > 0, 1 - F.size(F.array_distinct("lines")) / F.size("lines")
        ).otherwise(0.0),
    }


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[str]]:
    """(doc_id, statistics) of every row, and the statistics' names."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE, -1), "")).withColumn(
        "lines", F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    )
    rows = rows.withColumn("n_words", F.size("words"))
    named = statistics(F.col("text"))
    return rows.select("doc_id", *[c.alias(k) for k, c in named.items()]), list(named)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def tree_rules(model, names: list[str]) -> list[Rule]:
    """All paths from a root to a node of the forest, once each, with thresholds of one side merged."""
    rules: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            rules[tuple(sorted((s, low, t) for (s, low), t in path.items()))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = names[split.featureIndex()], split.threshold()
        low, high = path.get((name, True)), path.get((name, False))
        walk(node.leftChild(), path | {(name, True): at if low is None else min(low, at)})
        walk(node.rightChild(), path | {(name, False): at if high is None else max(high, at)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(rules)


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for name, low, at in rule:
        out = out & (F.col(name) <= at if low else F.col(name) > at)
    return out


@dataclass(frozen=True)
class Ensemble:
    """Intercept and weighted rules; ``score`` is the compiled expression."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(rows: DataFrame, names: list[str], settings: Settings = Settings()) -> Ensemble:
    """Ensemble for ``rows`` (statistics, label 0.0 or 1.0)."""
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    rate = 0.5 if not n else min(max(ones / n, 1e-6), 1 - 1e-6)
    prior = Ensemble(math.log(rate / (1 - rate)), ())
    if not n or ones in (0, n):
        return prior
    data = VectorAssembler(inputCols=names, outputCol="x").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed,
        minInstancesPerNode=5,
    ).fit(data)
    rules = tree_rules(forest, names)
    if not rules:
        return prior
    fired = rows.select("label", *[F.when(holds(r), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)])
    fired = staged(fired, "fired")
    data = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(fired)
    lasso = LogisticRegression(
        featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=settings.penalty, maxIter=60
    ).fit(data)
    weights = lasso.coefficients.toArray().tolist()
    discard(fired)
    return Ensemble(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows, names = with_statistics(docs)
    rows = staged(rows, "statistics")
    label = F.when(F.avg("quality") >= 0.5, 1.0).otherwise(0.0)
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(label.alias("label"))
    share = min(1.0, settings.max_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    training = staged(rows.join(chosen, "doc_id").select("label", *names), "training")
    model = fit(training, names, settings)
    discard(training)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= settings.threshold, 1).otherwise(0))


@query("op7_quality_model")
def op7_quality_model(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_scores(documents(spark, sf_dir, "doc_id", "text"), labels)
