"""Mixing sources to target weights by weighted fair queueing.

The words of each source are queued in a shuffled order, the whole source
again for every repeat. A copy of a document gets a virtual finish time: the
words of its source up to and including it, divided by the source's weight.
All copies are sorted by that time, and the queue is cut where the words
served reach the budget. A source whose copies run out leaves its share to the
others, in proportion to their weights, so the cut serves each source the
words of its target, up to a document. Rows equal in id, text and source are
copies of one document: they are counted first, queued one by one under running
numbers, and taken one by one.

Two global orders are needed, and both hold narrow rows only (source, size,
key): positions come from a range sort whose runs are added up per partition,
so a source with a third of all rows spreads over many tasks. What the cut
leaves of a source is a prefix of its queue. It is kept as one row per
source, the last key and number served, and joined to the documents, so that texts are
neither sorted nor joined by row. Targets are found by lowering the common
level until it holds, one sum over the source rows a round.

Order within a source is that of md5(seed|doc_id|md5(text)), so reruns agree.

Defined results: a null text has size 0; documents of size 0 are never taken.
The null source comes last. Which of several equal rows is taken once more than
the others is left open. Without any words all targets are 0. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WORD, discard, documents, staged, whole
from tablewright.llm.registry import query
from tablewright.operators.ranking import positioned


@dataclass(frozen=True)
class Mix:
    """Weights are dealt to the sources in order of their names, over and over."""

    weights: Sequence[int] = (5, 2, 1)
    budget_percent: int = 150
    repeats: int = 2
    seed: int = 17


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    return F.md5(
        F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(whole(text)))
        .cast("binary")
    )


def _level(sources: DataFrame, budget: float) -> float:
    """Words per unit of weight when every source stops at its cap and the rest share what is over."""
    level = float("inf")
    while True:
        capped = F.col("cap") <= F.lit(level) * F.col("weight") if level != float("inf") else F.lit(False)
        full, weight = sources.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))
        ).first()
        if not weight:
            return level if level != float("inf") else 0.0
        after = (budget - full) / weight
        if after == level:
            return level
        level = after


def plan_mix(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Staged: one row per source for staged ``rows`` (source, size, key).

    Gives source_size, weight, target and how far the mix reads it: ``served``
    whole passes over it and then every key up to ``last_key`` (null: none), of
    whose equal rows the first ``last_no``; ``divided`` if that is not all of them.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = positioned(sources, [F.col("source").asc_nulls_last()], pos="rank")
    dealt = F.array(*[F.lit(int(w)) for w in mix.weights])
    sources = staged(
        ranked.withColumn("weight", F.get(dealt, (F.col("rank") % len(mix.weights)).cast("int")))
        .withColumn("cap", F.col("source_size") * mix.repeats)
        .select("source", "rank", "source_size", "weight", "cap"),
        "sources",
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = total * mix.budget_percent / 100
    level = _level(sources, budget)

    counted = rows.where("size > 0").groupBy("source", "key").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("n"))
    known = counted.join(sources, counted["source"].eqNullSafe(sources["source"]), "inner").select(
        "rank", "weight", "source_size", "key", "size", "n", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("no")
    )
    queue = positioned(known, ["rank", "key", "no"], pos="at", weight="size")
    first = queue.groupBy("rank").agg(F.min("before").alias("base"))
    queue = queue.join(first, "rank").withColumn("upto", F.col("before") - F.col("base") + F.col("size"))
    copies = queue.select(
        "rank", "weight", "source_size", "key", "size", "n", "no", "upto",
        F.explode(F.sequence(F.lit(0), F.lit(mix.repeats - 1))).alias("pass"),
    ).withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("upto")) / F.col("weight"))
    line = positioned(copies.select("finish", "rank", "pass", "key", "no", "n", "size"), ["finish", "rank", "pass", "key", "no"],
                      pos="at", weight="size")
    last = (
        line.where(F.col("before") + F.col("size") <= F.lit(budget))
        .groupBy("rank")
        .agg(F.max(F.struct("pass", "key", "no", "n")).alias("last"))
    )
    plan = sources.join(last, "rank", "left").select(
        "source", "source_size", "weight",
        F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"),
        F.coalesce(F.col("last.pass"), F.lit(0)).alias("served"), F.col("last.key").alias("last_key"),
        F.col("last.no").alias("last_no"), (F.col("last.no") < F.col("last.n")).alias("divided"),
    )
    # written, so that the planner knows its size before it decides how to join the documents to it
    plan = staged(plan, "plan")
    discard(sources)
    return plan


def with_times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (name of the source, key) with the columns of ``plan`` and ``times``, how often each is taken."""
    joined = rows.join(plan, F.col("name").eqNullSafe(F.col("source")))
    within = F.coalesce(F.col("key") <= F.col("last_key"), F.lit(False))
    out = joined.withColumn("times", F.col("served") + F.when(within, 1).otherwise(0))
    if not plan.where("divided").limit(1).count():
        return out
    # of each source, one group of equal rows at most is divided: only these are numbered, in a global order
    cut = F.coalesce(F.col("divided") & (F.col("key") == F.col("last_key")), F.lit(False))
    numbered = positioned(joined.where(cut).withColumn("row_id", F.monotonically_increasing_id()), ["name", "row_id"], pos="at")
    first = numbered.groupBy(F.col("name").alias("of")).agg(F.min("at").alias("base"))
    numbered = numbered.join(first, F.col("name").eqNullSafe(F.col("of")))
    more = F.when(F.col("at") - F.col("base") < F.col("last_no"), 1).otherwise(0)
    return out.where(~cut).unionByName(numbered.withColumn("times", F.col("served") + more).select(*out.columns))


def narrow(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        size_of(F.col(text)).alias("size"),
        order_key(F.col(doc_id), F.col(text), mix.seed).alias("key"),
    )


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, source, size, source_size, weight, target, taken) of every document."""
    rows = staged(narrow(docs, mix), "mix")
    plan = plan_mix(rows, mix)
    return with_times(rows.withColumnRenamed("source", "name"), plan).select(
        "doc_id", "source", "size", "source_size", "weight", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns it came with."""
    narrowed = staged(narrow(docs, mix).select("source", "size", "key"), "mix")
    plan = plan_mix(narrowed, mix)
    discard(narrowed)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("name"),
        order_key(F.col("doc_id"), F.col("text"), mix.seed).alias("key"),
        size_of(F.col("text")).alias("words"),
    ).where("words > 0")
    taken = with_times(rows, plan).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times").cast("bigint")))).select("row.*")


@query(
    "op1_mix_sources",
    r"""
    WITH RECURSIVE d AS (
        SELECT *, row_number() OVER (PARTITION BY source, key) AS no FROM (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS key
            FROM documents
        )
    ),
    s AS (
        SELECT source, source_size, 2 * source_size AS cap,
            [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
            row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
    ),
    b AS (SELECT sum(source_size) * 150 / 100 AS budget FROM s),
    r AS (
        SELECT cap / w AS ratio, row_number() OVER (ORDER BY cap / w, rank) AS n,
            coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
            sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
        FROM s
    ),
    lv AS (SELECT arg_min((budget - spent) / left_w, n) FILTER (WHERE (budget - spent) / left_w <= ratio) AS level FROM r, b),
    q AS (
        SELECT d.doc_id, d.source, d.key, d.no, d.size, s.rank, s.w, s.source_size,
            sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.key, d.no) AS upto
        FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source WHERE d.size > 0
    ),
    c AS (SELECT q.*, p, (p * source_size + upto) / w AS finish FROM q, (VALUES (0), (1)) AS v(p)),
    served AS (
        SELECT rank, key, no FROM (
            SELECT rank, key, no, sum(size) OVER (ORDER BY finish, rank, p, key, no ROWS UNBOUNDED PRECEDING) AS total FROM c
        ), b WHERE total <= budget
    ),
    n AS (SELECT rank, key, no, count(*) AS times FROM served GROUP BY ALL)
    SELECT d.doc_id, d.size, s.source_size, d.source, s.w::INTEGER AS weight,
        least(s.cap::DOUBLE, level * s.w) AS target, (d.size * coalesce(n.times, 0))::BIGINT AS taken
    FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source CROSS JOIN lv
    LEFT JOIN n ON n.rank = s.rank AND n.key = d.key AND n.no = d.no
    """,
)
def op1_mix_sources(spark, sf_dir):
    return mix_report(documents(spark, sf_dir, "doc_id", "text", "source"))
