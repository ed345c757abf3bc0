"""Spelling variants: words one edit apart, found by dense comparison of code-point matrices.

1. Texts are cut into runs of letters and counted per task, so a word that
   fills a third of the corpus is a row per task.
2. Two words, the longer of n letters, differ by one insertion, deletion or
   replacement exactly if the lengths of their common prefix and suffix reach
   n - 1 together. So one of both is at least half of n: words are dealt out by
   their first and by their last half, once for either length they may meet,
   and only words in one such bucket are compared. A bucket too large for one
   task is split into parts, and each pair of parts is a task's work.
3. In a bucket, words are a matrix of code points, padded to one width. Common
   prefixes and suffixes of all pairs of two blocks are counted column by
   column. A pair that meets on both halves counts for the first one.
4. A task sends on one row per word it found any partner for: how many, and
   the best of them. Partial results are added up by word.
5. A word's form is its commonest partner if at least twice as common. Forms
   grow at least twofold at each step, so the last one is reached by doubling.

Defined results: null and empty texts have no words. A null id is an empty
string where words are drawn. Rows are counted as often as they occur.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import discard, documents, staged, whole
from tablewright.llm.registry import query

RUN = re.compile(r"[a-zÀ-ÿ]+")
#: Words of a bucket that one task compares with as many others.
PART = 4096
#: Words of a bucket that are compared row against shifted row, for all such buckets at once.
SMALL = 24
BLOCK = 512
_CHUNK = 16_384
_HELD = 200_000
_SEGMENT = 1 << 20


def runs(text: str) -> Iterator[list[str]]:
    """Maximal runs of letters, A-Z lower-cased, of a stretch of the text at a time."""
    # bytes.lower knows just A-Z; it changes no length, so a cut before a sign that is no letter cuts no run
    start = 0
    while start < len(text):
        stop = min(start + _SEGMENT, len(text))
        while stop < len(text) and (text[stop].isascii() and text[stop].isalpha() or "À" <= text[stop] <= "ÿ"):
            stop += 1
        yield RUN.findall(text[start:stop].encode().lower().decode())
        start = stop


def misspelt(doc_id: str, run: str, every: int = 97) -> str:
    """Drops one letter of the run if ``every`` divides the checksum of document and run."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, spell: Callable[[str, str], str] | None = None, least: int = 5, seen: int = 3) -> DataFrame:
    """(word, n): words of at least ``least`` letters with at least ``seen`` occurrences, each as ``spell`` writes it."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), whole(F.col("text")).alias("text"))

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                for found in runs(text.as_py()):
                    for word, n in Counter(found).items():
                        counts[spell(doc_id, word) if spell else word] += n
                    if len(counts) > _HELD:
                        yield out(counts)
                        counts = Counter()
        if counts:
            yield out(counts)

    counted = rows.mapInArrow(run, "word string, n bigint").where(F.length("word") >= least)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


def matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each word, padded with zeros on the right, the same from the last letter on, and the lengths."""
    length = np.array([len(w) for w in words], np.int32)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    place = np.arange(int(length.max(initial=0)))
    inside = place < length[:, None]
    left = np.zeros(inside.shape, np.uint32)
    left[inside] = points
    mirrored = np.maximum(length[:, None] - 1 - place, 0)
    return left, np.where(inside, np.take_along_axis(left, mirrored, 1), 0), length


def shared(a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
    """Length of the common beginning of every row of ``a`` and every row of ``b``, the first ``known`` being equal."""
    same = np.ones((len(a), len(b)), bool)
    count = np.full((len(a), len(b)), known, np.int32)
    for k in range(known, a.shape[1]):
        same &= (a[:, k, None] == b[None, :, k]) & (a[:, k] > 0)[:, None]  # padding never agrees
        if not same.any():
            break
        count += same
    return count


def row_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of ``a`` and the same row of ``b``."""
    differ = np.ones((len(a), a.shape[1] + 1), bool)
    differ[:, :-1] = (a != b) | (a == 0)
    return differ.argmax(1)


class Chunk:
    """Whole buckets of words, one after another, compared within each."""

    def __init__(self, level: list[int], first: list[bool], words: list[str]) -> None:
        self.level, self.first = np.array(level, np.int32), np.array(first, bool)
        self.left, self.right, self.length = matrix(words)

    def one_edit(self, prefix, suffix, level, first, a_length, b_length):
        """Whether pairs are one edit apart and belong to the bucket they met in."""
        apart = (prefix + suffix >= level - 1) & (np.maximum(a_length, b_length) == level)
        return apart & (first | (prefix < level // 2))

    def small(self, bucket: np.ndarray, small: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for step in range(1, SMALL):
            a = np.flatnonzero((bucket[step:] == bucket[:-step]) & small[step:])
            if not len(a):
                break
            b = a + step
            prefix, suffix = row_shared(self.left[a], self.left[b]), row_shared(self.right[a], self.right[b])
            hit = self.one_edit(prefix, suffix, self.level[a], self.first[a], self.length[a], self.length[b])
            yield a[hit], b[hit]

    def large(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows ``x`` and ``y`` of one bucket, block by block; of ``x`` alone if they are the same."""
        level, first = int(self.level[x[0]]), bool(self.first[x[0]])
        half, same = level // 2, x is y
        for s in range(0, len(x), BLOCK):
            p = x[s : s + BLOCK]
            for t in range(s if same else 0, len(y), BLOCK):
                q = y[t : t + BLOCK]
                prefix = shared(self.left[p, :level], self.left[q, :level], half if first else 0)
                suffix = shared(self.right[p, :level], self.right[q, :level], 0 if first else half)
                hit = self.one_edit(prefix, suffix, level, first, self.length[p, None], self.length[None, q])
                i, j = np.nonzero(np.triu(hit, 1) if same and s == t else hit)
                if len(i):
                    yield p[i], q[j]


def pairs(chunk: Chunk, bucket: np.ndarray, part: np.ndarray, across: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows one edit apart in each run of equal ``bucket``; where ``across``, of different parts only."""
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    size = np.diff(cut)
    is_small = (size <= SMALL) & ~across[cut[:-1]]
    yield from chunk.small(bucket, np.repeat(is_small, size))
    for k in np.flatnonzero(~is_small):
        rows = np.arange(cut[k], cut[k + 1])
        if across[cut[k]]:
            low = part[rows] == part[rows].min()
            if not low.all():
                yield from chunk.large(rows[low], rows[~low])
        else:
            yield from chunk.large(rows, rows)


def dealt(words: DataFrame, size: int) -> DataFrame:
    """(level, first, half, i, j, part, word, n), sorted: words by the halves they can share with others.

    ``level`` is the length of the longer word of a pair. Buckets of one word
    are left out, those of more than ``size`` are dealt out by pairs of parts.
    """
    length = F.length("word")
    keys = []
    for more in (0, 1):
        half = F.floor((length + more) / 2).cast("int")
        keys.append(F.struct((length + more).alias("level"), F.lit(True).alias("first"), F.left("word", half).alias("half")))
        keys.append(F.struct((length + more).alias("level"), F.lit(False).alias("first"), F.right("word", half).alias("half")))
    rows = words.select("word", "n", F.explode(F.array(*keys)).alias("key")).select("key.*", "word", "n")
    bucket = ["level", "first", "half"]
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    parts = F.ceil(F.col("rows") / size).cast("int")
    split = rows.join(sizes, bucket).withColumn("parts", parts)
    split = split.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    out = split.select(*bucket, "part", "word", "n", other).select(
        *bucket, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "word", "n"
    )
    return out.repartition(*bucket, "i", "j").sortWithinPartitions(*bucket, "i", "j")


def partners(words: DataFrame, size: int = PART) -> DataFrame:
    """(word, n_near, best, best_n) of words that have any partner, from ``words`` (word, n)."""
    names = ["level", "first", "half", "i", "j", "part", "word", "n"]

    def found(rows: list[tuple]) -> pa.RecordBatch | None:
        level, first, half, i, j, part, word, n = map(list, zip(*rows))
        keys = list(zip(level, first, half, i, j))
        new = np.array([a != b for a, b in zip(keys, [None, *keys])])
        chunk, n = Chunk(level, first, word), np.array(n, np.int64)
        met = pairs(chunk, np.cumsum(new), np.array(part), np.array(i) != np.array(j))
        got = [hit for hit in met if len(hit[0])]
        if not got:
            return None
        a, b = (np.concatenate(c) for c in zip(*got))
        own, other = np.concatenate([a, b]), np.concatenate([b, a])
        # rows of one word in several buckets are one owner; ranks follow the order of code points
        names = {w: k for k, w in enumerate(sorted(set(word)))}
        rank = np.array([names[w] for w in word])
        order = np.lexsort((rank[other], -n[other], rank[own]))
        _, at, count = np.unique(rank[own][order], return_index=True, return_counts=True)
        mine, best = own[order][at], other[order][at]
        return pa.RecordBatch.from_arrays(
            [pa.array([word[k] for k in mine]), pa.array(count, pa.int64()), pa.array([word[k] for k in best]), pa.array(n[best])],
            ["word", "n_near", "best", "best_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            waiting += zip(*(batch[c].to_pylist() for c in names))
            if len(waiting) >= _CHUNK:
                end = len(waiting) - 1
                while end and waiting[end - 1][:5] == waiting[-1][:5]:
                    end -= 1
                if end:  # the last bucket may go on
                    if (out := found(waiting[:end])) is not None:
                        yield out
                    waiting = waiting[end:]
        if waiting and (out := found(waiting)) is not None:
            yield out

    near = dealt(words, size).mapInArrow(run, "word string, n_near bigint, best string, best_n bigint")
    first = F.struct((-F.col("best_n")).alias("less"), "best")
    summed = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(first).alias("first"))
    return summed.select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def variants(words: DataFrame, size: int = PART) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word in ``words`` (word, n)."""
    words = staged(words.select("word", "n"), "words")
    near = words.join(partners(words, size), "word", "left")
    takes = F.col("best_n") >= 2 * F.col("n")
    forms = staged(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    up = staged(forms.where("form is not null").select("word", F.col("form").alias("root")), "up")
    while True:
        # a root that has a form itself is no last one: jump as far again as it leads
        next_up = up.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = staged(up.join(next_up, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "up")
        more = after.where("moved").limit(1).count()
        discard(up)
        up = after.select("word", "root")
        if not more:
            break
    out = forms.join(up, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    return variants(word_counts(documents(spark, sf_dir, "doc_id", "text"), misspelt))
