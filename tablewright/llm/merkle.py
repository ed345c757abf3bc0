"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A text is cut into sections (at blank lines), these into paragraphs (lines)
and these into pieces of a few words (64 bytes at most). Each piece is hashed, a paragraph's
digest is that of its pieces' hashes, a section's that of its paragraphs'
digests, and the root that of the sections'. Cuts depend on the signs around
them alone, so an edit changes the pieces it touches and the digests above
them, and nothing else.

The fingerprint is the tree as text, `root/section:paragraph[piece...]...`, so two
fingerprints can be compared without their texts: equal roots mean equal
texts, equal digests end the descent, and differing branches lead to the edit.
Pieces keep 32 bits of their hash, inner nodes 64 and the root 128; digests are
taken over full hashes, with separators, so texts that differ in any sign differ
in their roots.

Likeness is the share of pieces in common, 2 * common / (pieces of both). Equal
sections and paragraphs are matched first, wherever they stand, then the
pieces of what is left. Two empty texts are alike (1).

The query compares each text with an edited one that borrows from the next
document. Rows are range-partitioned by id, with cuts taken from the ids
alone; the first row of each range is sent to the range before as well, so
each text is moved once.

Defined results: null texts count as empty. Null ids come last; rows with one
id are in the order of a hash of their texts.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import documents, whole
from tablewright.llm.registry import query

#: A piece ends behind a word if this divides a hash of the word's last bytes: about every fourth word.
STEP = 4
LONGEST = 64
SPREAD = 8
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FACTORS = (2654435761, 2246822519, 3266489917, 668265263)


@dataclass(frozen=True)
class Paragraph:
    digest: str
    pieces: tuple[str, ...]


@dataclass(frozen=True)
class Section:
    digest: str
    paragraphs: tuple[Paragraph, ...]


@dataclass(frozen=True)
class Tree:
    root: str
    sections: tuple[Section, ...]

    def __str__(self) -> str:
        return "/".join(
            [self.root, *[f"{s.digest}:" + "".join(f"{p.digest}[{''.join(p.pieces)}]" for p in s.paragraphs) for s in self.sections]]
        )

    @staticmethod
    def parse(text: str) -> Tree:
        root, *parts = text.split("/")
        sections = []
        for part in parts:
            digest, _, rest = part.partition(":")
            found = (p.split("[") for p in rest.split("]")[:-1])
            sections.append(Section(digest, tuple(Paragraph(d, tuple(x[i : i + 8] for i in range(0, len(x), 8))) for d, x in found)))
        return Tree(root, tuple(sections))


def cuts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces and where lines begin, and the end. Stretches without a cut are dealt out evenly from their start."""
    signs = np.frombuffer(data, np.uint8)
    blank = _BLANK[signs]
    ends = np.flatnonzero(blank[1:] & ~blank[:-1])  # the last bytes of words
    lines = np.flatnonzero(signs == 0x0A) + 1
    lines = np.concatenate([[0], lines[lines < len(data)], [len(data)]])
    first = lines[np.searchsorted(lines, ends, "right") - 1]
    hashed = np.zeros(len(ends), np.uint32)
    for back, factor in enumerate(_FACTORS):
        hashed += signs[np.maximum(ends - back, first)] * np.uint32(factor)
    at = np.union1d(ends[(hashed >> np.uint32(16)) % STEP == 0] + 1, lines)
    size = np.diff(at)
    if (size > LONGEST).any():
        more = (size - 1) // LONGEST
        within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        at = np.union1d(at, np.repeat(at[:-1], more) + LONGEST * within)
    return at, lines


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def tree(text: str) -> Tree:
    """The fingerprint of a text. Paragraphs and sections hold the line ends and blank lines behind them."""
    data = text.encode()
    if not data:
        return Tree(_digest(b"").hex(), ())
    at, lines = cuts(data)
    spots = at.tolist()
    hashes = b"".join([xxhash.xxh3_128_digest(data[s:e]) for s, e in zip(spots, spots[1:])])
    short = np.frombuffer(hashes, np.uint8).reshape(-1, 16)[:, :4].tobytes().hex()
    bounds = np.searchsorted(at, lines).tolist()
    sections: list[Section] = []
    paragraphs: list[Paragraph] = []
    full: list[bytes] = []
    roots: list[bytes] = []

    def close() -> None:
        roots.append(_digest(b"".join(full)))
        sections.append(Section(roots[-1][:8].hex(), tuple(paragraphs)))
        paragraphs.clear()
        full.clear()

    after_blank, places = False, lines.tolist()
    for i, j, s, e in zip(bounds, bounds[1:], places, places[1:]):
        empty = not data[s:e].strip()
        if after_blank and not empty:
            close()
        after_blank = empty
        full.append(_digest(hashes[16 * i : 16 * j]))
        paragraphs.append(Paragraph(full[-1][:8].hex(), tuple([short[8 * k : 8 * k + 8] for k in range(i, j)])))
    close()
    return Tree(_digest(b"".join(roots)).hex(), tuple(sections))


def _leftover(a: list, b: list, weight) -> tuple[int, list, list]:
    """Weight of what both hold, and what only one of them holds."""
    left, right = Counter(x.digest for x in a), Counter(x.digest for x in b)
    both, common = left & right, 0
    out = []
    for side in (a, b):
        free, rest = Counter(both), []
        for x in side:
            if free[x.digest]:
                free[x.digest] -= 1
                common += weight(x) if side is a else 0
            else:
                rest.append(x)
        out.append(rest)
    return common, *out


def likeness(a: Tree, b: Tree) -> float:
    """Share of pieces in common, from 0 to 1."""
    if a.root == b.root:
        return 1.0
    n_paragraph = lambda p: len(p.pieces)
    n_section = lambda s: sum(map(n_paragraph, s.paragraphs))
    total = sum(map(n_section, a.sections)) + sum(map(n_section, b.sections))
    common, left, right = _leftover(list(a.sections), list(b.sections), n_section)
    more, left, right = _leftover([p for s in left for p in s.paragraphs], [p for s in right for p in s.paragraphs], n_paragraph)
    pieces = Counter(h for p in left for h in p.pieces) & Counter(h for p in right for h in p.pieces)
    return 2 * (common + more + pieces.total()) / total


def edits(a: Tree, b: Tree) -> list[tuple[str, int, int, int]]:
    """Where two texts differ: (side, section, paragraph, piece), numbers from 0, of what the other lacks.

    Equal branches are passed over whole; sides are ``a`` and ``b``.
    """
    out = []
    if a.root == b.root:
        return out
    for side, one, other in (("a", a, b), ("b", b, a)):
        sections = Counter(s.digest for s in other.sections)
        paragraphs = Counter(p.digest for s in other.sections for p in s.paragraphs)
        pieces = Counter(h for s in other.sections for p in s.paragraphs for h in p.pieces)
        for i, s in enumerate(one.sections):
            if sections[s.digest]:
                continue
            for j, p in enumerate(s.paragraphs):
                if not paragraphs[p.digest]:
                    out += [(side, i, j, k) for k, h in enumerate(p.pieces) if not pieces[h]]
    return out


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``fingerprint`` of every row."""
    rows = docs.select(F.struct(*keep).alias("row"), whole(F.col(text)).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([str(tree(t.as_py())) for t in batch["text"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["row"], made], ["row", "fingerprint"])

    return rows.mapInArrow(run, schema).select("row.*", "fingerprint")


def _place() -> Column:
    """Order of the rows: null ids last, rows of one id by a hash of their texts."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"))


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, text, place, range, extra), sorted by range and place, extra rows last.

    The first row of a range is the extra one of the range before, the first of
    all that of the last range. At most ``SPREAD`` places per range reach the
    driver on average, drawn by hash, whatever the number of rows.
    """
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn("place", _place())
    n, first = rows.agg(F.count(F.lit(1)), F.min("place")).first()
    drawn = F.pmod(F.xxhash64("place"), F.lit(max(n // (SPREAD * ranges), 1))) == 0
    places = sorted({(r[0]["none"], r[0]["doc_id"], r[0]["hash"]) for r in rows.where(drawn).select("place").collect()}, key=_key)
    start = [(first["none"], first["doc_id"], first["hash"])] if n else []
    cuts = [start[0], *[p for p in places[SPREAD - 1 :: SPREAD] if p != start[0]]] if n else []
    kind = T.ArrayType(rows.schema["place"].dataType)
    # one constant, so the plan does not grow with the number of ranges
    table = F.from_json(F.lit(json.dumps([dict(zip(("none", "doc_id", "hash"), c)) for c in cuts], default=str)), kind)
    below = F.size(F.filter(table, lambda c: c <= F.col("place")))
    last = max(len(cuts) - 1, 0)
    before = F.when(F.col("range") == 0, last).otherwise(F.col("range") - 1)
    target = lambda number, extra: F.struct(number.alias("range"), F.lit(extra).alias("extra"))
    once = target(F.col("range"), False)
    to = F.when(F.array_contains(table, F.col("place")), F.array(once, target(before, True))).otherwise(F.array(once))
    dealt = rows.withColumn("range", below - 1).withColumn("to", F.explode(to)).select("doc_id", "text", "place", "to.*")
    return dealt.repartitionById(max(len(cuts), 1), "range").sortWithinPartitions("range", "extra", "place")


def _key(place: tuple) -> tuple:
    none, doc_id, hash = place
    return none, 0 if doc_id is None else doc_id, hash


def borrowed(text: str, after: str) -> str:
    """The text with its last half replaced by as many signs of the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compared_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    ``ranges`` is the number of parts the documents are sorted in (default: two per shuffle partition).
    """
    spark = docs.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(docs, ranges)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(c, t) for c, t in zip(names, [rows.schema["doc_id"].dataType, *types])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, ids, held, before = [], [], 0, None

        def record() -> pa.RecordBatch:
            cols = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *cols], names)

        for batch in batches:
            for i in range(batch.num_rows):
                where, extra = batch["range"][i].as_py(), batch["extra"][i].as_py()
                if extra and before is None:
                    continue
                text = batch["text"][i].as_py()
                # every range ends with its extra row, so a row is compared with the one that comes next
                mine = tree(text)
                if before is not None:
                    doc_id, old, one = before
                    edited = borrowed(old, text)
                    changed = tree(edited)
                    out.append((
                        len(old), hashlib.sha256(edited.encode()).hexdigest(), str(one), str(changed),
                        likeness(one, changed), likeness(one, mine),
                    ))
                    ids.append(doc_id)
                    held += len(out[-1][2]) + len(out[-1][3])
                    if held > 1 << 23:
                        yield record()
                        out, ids, held = [], [], 0
                before = None if extra else (batch["doc_id"].slice(i, 1), text, mine)
        if out:
            yield record()

    return rows.select("doc_id", "text", "range", "extra").mapInArrow(run, schema)


@query("op11_merkle_fingerprints")
def op11_merkle_fingerprints(spark, sf_dir):
    return compared_with_next(documents(spark, sf_dir, "doc_id", "text"))
