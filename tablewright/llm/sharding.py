"""Sharding by longest processing time: the largest groups first, each to the least loaded shard.

Rows with equal texts form a group and stay together. Groups of equal size
are interchangeable, so the rule needs only the number of groups per size:
sizes are read to eleven significant bits (at most 1,024 lots per doubling,
however many groups there are), and that table of lots is all the driver
sees. A heap deals each lot; whole rounds, in which every shard gets up to
the same level, are taken at once. A group finds its shard by its number
within its lot, its rank in the order of text digests, which spreads what
little the sizes within a lot differ.

Ranks and slots come from range sorts of narrow rows, so neither a lot, nor a
group with a third of all rows, nor a shard is ever in one task.

Defined results: a null text counts as empty and shares its group; its size
is 1. The law is ``bytes``: shards' sizes are as near as the largest group
lets them be, and lots by one part in a thousand. Slots follow (text digest,
doc_id), null ids first; rows equal in both may swap theirs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import documents, staged, whole
from tablewright.llm.registry import query
from tablewright.operators.ranking import positioned

_BITS = 10


def lot_of(size: Column) -> Column:
    """Number of the size class: grows with the size, exact below 2^11."""
    cut = F.greatest(F.length(F.bin(size)) - 1 - _BITS, F.lit(0)).cast("int")
    return cut.cast("bigint") * (1 << _BITS) + F.call_function("shiftright", size, cut)


def deal(lots: Iterable[tuple[int, float]], shards: int) -> list[list[int]]:
    """Groups per shard for each lot (number of groups, size of one), largest first.

    Same result as giving one group at a time to the least loaded shard: those
    groups that fit below the level a lot reaches are counted, the rest go
    through the heap.
    """
    heap = [(0.0, s) for s in range(shards)]
    out = []
    for count, size in lots:
        quota, left = [0] * shards, count
        if count > shards:
            loads = sorted(heap)
            level, below = 0.0, 0.0
            for n, (load, _) in enumerate(loads, 1):
                below += load
                level = (count * size + below) / n
                if n == shards or level <= loads[n][0]:
                    break
            heap = []
            for load, s in loads:
                quota[s] = min(left, max(0, int((level - load) / size)))
                left -= quota[s]
                heap.append((load + quota[s] * size, s))
            heapq.heapify(heap)
        for _ in range(left):
            load, s = heapq.heappop(heap)
            quota[s] += 1
            heapq.heappush(heap, (load + size, s))
        out.append(quota)
    return out


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    text = whole(F.col("text"))
    rows = staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes")).withColumn("lot", lot_of(F.col("bytes")))
    ranked = staged(positioned(groups, [F.col("lot").desc(), "digest"], pos="rank").select("digest", "lot", "bytes", "rank"),
                    "groups")
    lots = ranked.groupBy("lot").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    table = sorted(lots.collect(), reverse=True)  # bounded by the number format, see above
    quotas, start, plan = deal([(r["n"], r["bytes"] / r["n"]) for r in table], shards), 0, []
    for r, quota in zip(table, quotas):
        ends = [start := start + q for q in quota]
        plan.append((r["lot"], ends))
    ends = docs.sparkSession.createDataFrame(plan, "lot bigint, ends array<bigint>")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank")))
    placed = rows.join(ranked.join(ends, "lot").select("digest", shard.alias("shard")), "digest")
    tied = placed.withColumn("tie", F.monotonically_increasing_id())
    line = positioned(staged(tied, "placed"), ["shard", "digest", "doc_id", "tie"], pos="at")
    first = line.groupBy("shard").agg(F.min("at").alias("first"))
    return line.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") - F.col("first")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_shard_groups")
def op2_shard_groups(spark, sf_dir):
    return sharded(documents(spark, sf_dir, "doc_id", "text"))
