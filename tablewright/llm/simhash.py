"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

One pass over the texts gives a 64-bit fingerprint per row; everything after
works on narrow rows. Equal fingerprints are one point, so a group of copies
costs one comparison. Links come from ``tiles``, groups from ``components``.

Defined results: a null text counts as empty. A text without words has
fingerprint 0, linked like any other; one with fewer words than a shingle is
one shingle. A group is named by its smallest doc_id that is not null (null
if there is none). ``representatives`` keeps the row with the smallest doc_id
of each group, null last, and of rows equal in id and text any one. Texts are
read in segments, so very long ones take little memory beside themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import components, documents, row_key, staged, whole
from tablewright.llm.registry import query
from tablewright.llm.tiles import near_links

SEED = 42
_SEGMENT = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set: sums of byte lanes, 255 hashes at a time."""
    if not len(hashes):
        return np.zeros(64, np.int64)
    lanes = np.add.reduceat((hashes[None, :] >> _SHIFTS) & _LANES, np.arange(0, len(hashes), 255), axis=1)
    counts = lanes.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)  # bit of the byte, byte
    return counts.T.reshape(64)


def _segments(data: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words (bytes.lower and split know just A-Z and the six white space signs)."""
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + _SEGMENT)
        stop = gap.start() if gap else len(data)
        yield data[start:stop].lower().split()
        start = stop


def fingerprint(data: bytes, width: int) -> int:
    """SimHash of all ``width``-word shingles, repeats included."""
    counts, n, carry = np.zeros(64, np.int64), 0, []
    for words in _segments(data):
        words = carry + words
        if len(words) >= width:
            hashes = _hashes(words, width)
            counts, n = counts + bit_counts(hashes), n + len(hashes)
        carry = words[len(words) - width + 1 :] if len(words) >= width else words
        if width == 1:
            carry = []
    if n == 0 and carry:
        counts, n = bit_counts(_hashes(carry, len(carry))), 1
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0]) if n else 0


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    hash64 = xxhash.xxh64_intdigest
    return np.fromiter(
        (hash64(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist())), np.uint64, len(starts)
    )


def fingerprints(docs: DataFrame, width: int = 4, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint as a signed number) of every row."""
    rows = docs.select(F.struct(*keep).alias("row"), whole(F.col(text)).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(fps.view(np.int64))], ["row", "fp"])

    return rows.mapInArrow(run, schema).select("row.*", "fp")


def grouped(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root): of staged rows with ``fp``, the name of the group each distinct fingerprint is in."""
    stars = components(near_links(fps, radius))
    points = fps.select("fp").distinct()
    return points.join(stars, points["fp"] == stars["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    fps = staged(fingerprints(docs, width), "simhash")
    roots = staged(grouped(fps, radius), "roots")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, with the columns it came with."""
    marks = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    fps = staged(fingerprints(marks, width, keep=("doc_id", "key")), "simhash")
    roots = grouped(fps, radius)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    least = fps.groupBy("fp").agg(F.min(rank).alias("first")).join(roots, "fp")
    kept = staged(least.groupBy("root").agg(F.min("first").alias("first")), "kept")
    rows = docs.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    stay = rows.join(kept.select("first.key"), "key", "left_semi")
    return stay.groupBy("key").agg(F.first("row").alias("row")).select("row.*")


@query("op9_simhash")
def op9_simhash(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
