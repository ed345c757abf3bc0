"""Exact deduplication by polynomial fingerprints and a comparison of what they call equal.

A text's fingerprint is its length with the value of its bytes as a polynomial
modulo two primes. The value of a whole is that of its pieces, each shifted by
the bytes that follow it, so pieces are hashed independently and their shares
summed: the pieces of a huge document are dealt out over all tasks, others are
hashed where they are read. Rows with equal fingerprints are then compared
with one row of the group, piece against piece, as a join on (fingerprint,
piece number) that Spark can split for large groups. Rows that turn out
different are compared among themselves, round by round, so colliding
fingerprints cost time and never a wrong result.

Only rows that share a fingerprint have their texts written and compared.

Defined results: a null text counts as empty. Of equal texts the row with the
largest doc_id stays, any id before null. Rows equal in id and text are one
row repeated, of which one stays. Extra columns stay where rows are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import discard, documents, row_key, staged, whole
from tablewright.llm.registry import query

#: Two primes below 2^31 and a base for each, drawn once.
PRIMES = (2147483647, 2147483629)
BASES = (1150362733, 893150923)
PIECE = 1 << 20
_CHUNK = 1 << 16


class Polynomial:
    """Value of bytes as a polynomial; values of neighbours combine by shifting the left one."""

    def __init__(self, primes=PRIMES, bases=BASES, chunk: int = _CHUNK) -> None:
        self.primes, self.bases, self.chunk = primes, bases, chunk
        self.powers = []
        for p, b in zip(primes, bases):
            power = np.ones(chunk, np.uint64)
            for i in range(1, chunk):
                power[i] = int(power[i - 1]) * b % p
            self.powers.append(power[::-1].copy())

    def shift(self, values: tuple[int, ...], n: int) -> tuple[int, ...]:
        """Values after ``n`` more bytes of zero."""
        return tuple(v * pow(b, n, p) % p for v, b, p in zip(values, self.bases, self.primes))

    def of(self, data: bytes) -> tuple[int, ...]:
        values = (0,) * len(self.primes)
        for at in range(0, len(data), self.chunk):
            part = np.frombuffer(data, np.uint8, min(self.chunk, len(data) - at), at).astype(np.uint64) + np.uint64(1)
            moved = self.shift(values, len(part))
            # 2^8 * 2^31 * 2^16 stays below 2^64
            values = tuple(
                (v + int(part @ w[-len(part) :])) % p for v, w, p in zip(moved, self.powers, self.primes)
            )
        return values


def pieces(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """(keep, at, piece): the bytes of ``data`` in parts of ``size``; an empty text is one empty part."""
    count = F.greatest(F.ceil(F.length("data") / size), F.lit(1)).cast("int")
    return rows.select(*keep, "data", F.explode(F.sequence(F.lit(0), count - 1)).alias("at")).select(
        *keep, "at", F.substring("data", F.col("at") * size + 1, F.lit(size)).alias("piece")
    )


def fingerprints(docs: DataFrame, primes=PRIMES, bases=BASES, size: int = PIECE) -> DataFrame:
    """(key, doc_id, text_sha256, n_bytes, fp, copies): one row per distinct pair of id and text."""
    data = whole(F.col("text")).cast("binary")
    rows = docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id"), F.sha2(data, 256).alias("text_sha256"),
        data.alias("data"), F.length(data).cast("bigint").alias("n_bytes"),
    )
    keep = ("key", "doc_id", "text_sha256", "n_bytes")
    small = pieces(rows.where(F.length("data") <= size), size, *keep)
    huge = pieces(rows.where(F.length("data") > size), size, *keep).repartition("key", "at")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(primes, bases)
        for batch in batches:
            values = []
            for total, at, part in zip(batch["n_bytes"], batch["at"], batch["piece"]):
                part = part.as_py()
                after = total.as_py() - at.as_py() * size - len(part)
                values.append(poly.shift(poly.of(part), after))
            cols = [pa.array([v[i] for v in values], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], batch["at"], *cols], [*keep, "at", "v0", "v1"])

    schema = ", ".join(f"{c} {kind[c]}" for c in keep) + ", at int, v0 bigint, v1 bigint"
    shares = small.mapInArrow(share, schema).unionByName(huge.mapInArrow(share, schema))
    copies = F.sum(F.when(F.col("at") == 0, 1).otherwise(0))
    summed = shares.groupBy(*keep).agg(copies.alias("copies"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(2)])
    value = lambda i: F.hex(F.pmod(F.expr(f"v{i} div copies"), F.lit(primes[i])))
    return summed.select(*keep, F.concat_ws("-", value(0), value(1), F.hex("n_bytes")).alias("fp"), "copies")


def differing(members: DataFrame, size: int) -> DataFrame:
    """Rows of ``members`` (key, doc_id, fp, data) whose bytes differ from those of their group's first row."""
    first = members.groupBy("fp").agg(F.max(F.struct("doc_id", "key"))["key"].alias("key"))
    model = pieces(members.join(first, ["fp", "key"], "left_semi"), size, "fp").withColumnRenamed("piece", "model")
    parts = pieces(members.select("fp", "key", "data"), size, "fp", "key")
    odd = parts.join(model, ["fp", "at"]).where(F.col("piece") != F.col("model")).select("key").distinct()
    return members.join(odd, "key", "left_semi")


def classes(docs: DataFrame, primes=PRIMES, bases=BASES, size: int = PIECE) -> DataFrame:
    """Staged (key, doc_id, text_sha256, copies, fp, round): rows with equal (fp, round) have equal texts."""
    marks = staged(fingerprints(docs, primes, bases, size), "marks")
    shared = marks.groupBy("fp").count().where("count > 1").select("fp")
    wanted = marks.join(shared, "fp", "left_semi").select("key", "fp")
    rows = docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", whole(F.col("text")).cast("binary").alias("data")
    )
    # a row repeated in full is compared once
    members = staged(rows.join(wanted, "key").groupBy("key", "fp").agg(
        F.first("doc_id").alias("doc_id"), F.first("data").alias("data")), "members")
    number, decided = 0, []
    while True:
        odd = staged(differing(members, size), "members")
        discard(members)
        if odd.isEmpty():
            break
        number, members = number + 1, odd
        decided.append(staged(members.select("key", F.lit(number).alias("round")), "odd"))
    out = marks.withColumn("round", F.lit(0))
    if decided:
        later = decided[0]
        for more in decided[1:]:
            later = later.unionByName(more)
        later = later.groupBy("key").agg(F.max("round").alias("later"))
        out = out.join(later, "key", "left").withColumn("round", F.coalesce("later", "round")).drop("later")
    return out


def exact_duplicates(docs: DataFrame, primes=PRIMES, bases=BASES, size: int = PIECE) -> DataFrame:
    """(key, doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    rows = classes(docs, primes, bases, size)
    groups = rows.groupBy("fp", "round").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").cast("bigint").alias("group_size")
    )
    named = rows.join(groups, ["fp", "round"])
    each = named.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select("key", "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    keep = exact_duplicates(docs.select("doc_id", "text")).where("kept").select("key")
    rows = docs.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    stay = rows.join(keep, "key", "left_semi")
    return stay.groupBy("key").agg(F.first("row").alias("row")).select("row.*")


@query(
    "op5_exact_dedup",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
        doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t)
    """,
)
def op5_exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir, "doc_id", "text")).drop("key")
