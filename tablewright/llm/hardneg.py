"""Hard negatives from vectors: Hilbert-ordered blocks with zone maps, chosen by interval bounds.

For each anchor the best rows of its own label are its positives. For each
positive a window of scores is set, and the best rows of other labels whose
score lies in it are the hard negatives.

1. Rows are sorted along a Hilbert curve through all dimensions and packed
   into blocks, one Parquet row each, with the least and greatest value per
   dimension and the labels in the block (its zone map).
2. Anchors are taken from the blocks, packed into tiles of bounded size. What
   an anchor finds in its own block sets a first bound on its last positive.
3. Tiles meet the zone maps alone: an inner product with any vector between a
   block's least and greatest values lies in an interval that two small matrix
   products give. A block is read for an anchor only if its interval reaches the
   anchor's bound (positives) or one of its windows (negatives).
4. Chosen pairs of tile and block are scored by matrix products inside tasks.
   A task keeps the best of each anchor over the blocks it sees, so what it
   sends on does not grow with them. The last step ranks those few rows.

Bounds and scores are exact: whole numbers in doubles below 2**53, else in 64
bits. Nothing is cut: a block that is not read cannot hold a result.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part, nor do those with a component so large that a score
might not fit 64 bits. Shorter vectors count as padded with zeros. A null id
comes after all others in ties and is no anchor (ids of 2**63 - 1 count as
null). Equal rows are rows of their own: a copy of an anchor is its positive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import discard, staged
from tablewright.llm.registry import query

NO_ID = 2**63 - 1
_LEAST = np.int64(-(2**63))
_BITS = 3
_ZONES = 512


@dataclass(frozen=True)
class Rule:
    """``positives`` per anchor, ``negatives`` per positive, scores within low to high percent of the positive's."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


@dataclass(frozen=True)
class Space:
    """What all vectors of a table share: dimensions, range of components, and how they are held and multiplied."""

    dims: int
    least: int
    most: int

    @property
    def held(self) -> str:
        size = max(-self.least, self.most)
        return "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"

    @property
    def exact(self) -> type:
        return np.float64 if self.dims * max(-self.least, self.most, 1) ** 2 < 1 << 53 else np.int64

    def vectors(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.held).reshape(-1, self.dims).astype(self.exact)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row (whole numbers of ``bits`` bits per dimension) on the Hilbert curve, as sortable bytes."""
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    # undo the turns and mirrorings of each level of the curve, coarse to fine
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(n):
            upper = (x[i] & bit) != 0
            swap = np.where(upper, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(upper, below, swap)
            x[i] ^= swap
    # Gray code over the dimensions
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint32(level)) & 1 == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    planes = [((x >> np.uint32(level)) & 1).astype(np.uint8).T for level in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(planes, axis=1), axis=1)]


def space_of(points: DataFrame) -> tuple[Space, int] | None:
    """Dimensions and range of ``points`` (id, label, vec), and their number; four numbers reach the driver."""
    row = points.agg(
        F.max(F.size("vec")), F.min(F.array_min("vec")), F.max(F.array_max("vec")), F.count(F.lit(1))
    ).first()
    if not row[3]:
        return None
    return Space(max(row[0], 1), min(int(row[1] or 0), 0), max(int(row[2] or 0), 0)), row[3]


def blocks_of(points: DataFrame, space: Space, rows: int, size: int) -> DataFrame:
    """Staged blocks: (block, ids, labels, anchors, vecs, least, most, kinds), rows in the order of their ids."""
    span = max(space.most - space.least, 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.zeros((batch.num_rows, space.dims), np.int64)
            ends = batch["vec"].offsets.to_numpy()
            flat = batch["vec"].values.to_numpy(zero_copy_only=False)
            for i, (s, e) in enumerate(zip(ends[:-1], ends[1:])):
                whole[i, : e - s] = flat[s:e]
            cells = ((whole - space.least).astype(np.float64) / span * ((1 << _BITS) - 1) + 0.5).astype(np.uint32)
            held = [v.tobytes() for v in whole.astype(space.held)]
            keys = hilbert_keys(cells, _BITS) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), *[batch[c] for c in ("id", "label", "anchor")], pa.array(held, pa.binary())],
                ["key", "id", "label", "anchor", "vec"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            waiting += zip(*(batch[c].to_pylist() for c in ("id", "label", "anchor", "vec", "part")))
            while len(waiting) >= size:
                yield one(waiting[:size])
                waiting = waiting[size:]
        if waiting:
            yield one(waiting)

    made = 0

    def one(rows: list[tuple]) -> pa.RecordBatch:
        nonlocal made
        rows.sort(key=lambda r: r[0])
        ids, labels, anchors, vecs, part = zip(*rows)
        made += 1
        v = np.frombuffer(b"".join(vecs), space.held).reshape(len(rows), space.dims)
        cols = {
            "block": ([(part[0] << 32) + made], pa.int64()),
            "ids": ([np.array(ids, np.int64).tobytes()], pa.binary()),
            "labels": ([np.array(labels, np.int64).tobytes()], pa.binary()),
            "anchors": ([np.array(anchors, bool).tobytes()], pa.binary()),
            "vecs": ([v.tobytes()], pa.binary()),
            "least": ([v.min(0).tobytes()], pa.binary()),
            "most": ([v.max(0).tobytes()], pa.binary()),
            "kinds": ([np.unique(np.array(labels, np.int64)).tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols.values()], list(cols))

    keyed = points.mapInArrow(placed, "key binary, id bigint, label bigint, anchor boolean, vec binary")
    parts = min(max(math.ceil(rows / size), 1), 4000)
    ordered = keyed.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")
    schema = "block bigint, " + ", ".join(f"{c} binary" for c in "ids labels anchors vecs least most kinds".split())
    return staged(ordered.withColumn("part", F.spark_partition_id().cast("bigint")).mapInArrow(pack, schema), "blocks")


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the ``k`` largest of each row, earlier columns first on ties; overwrites ``scores``."""
    at, value, rows = [], [], np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        top = scores.argmax(1)
        at.append(top)
        value.append(scores[rows, top])
        scores[rows, top] = _LEAST
    return np.stack(at, 1), np.stack(value, 1)


def own_label(a: np.ndarray, kind: np.ndarray, me: np.ndarray, block: dict) -> np.ndarray:
    """Scores of anchors against a block: only rows of the same label other than the anchor itself (at ``me``) count."""
    scores = (a @ block["vecs"].T).astype(np.int64)
    scores[kind[:, None] != block["labels"][None, :]] = _LEAST
    rows = np.flatnonzero(me >= 0)
    scores[rows, me[rows]] = _LEAST
    return scores


def _arrays(space: Space, batch: pa.RecordBatch, i: int) -> dict:
    out = {c: np.frombuffer(batch[c][i].as_py(), np.int64) for c in ("ids", "labels")}
    return out | {"vecs": space.vectors(batch["vecs"][i].as_py())}


def anchor_tiles(blocks: DataFrame, space: Space, rule: Rule, size: int) -> DataFrame:
    """Staged tiles of anchors: (tile, home, place, a_ids, a_labels, a_vecs, bound).

    ``home`` and ``place`` are block and position of each, ``bound`` the score
    of the last positive its own block would give.
    """

    def tile(parts: list[tuple]) -> pa.RecordBatch:
        home, place, ids, labels, vecs, bound = (np.concatenate(c) for c in zip(*parts))
        cols = [home, place, ids, labels, vecs.astype(space.held), bound]
        name = int(home[0]) * (1 << 16) + int(place[0])
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in cols]],
            ["tile", "home", "place", "a_ids", "a_labels", "a_vecs", "bound"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                block = _arrays(space, batch, i)
                chosen = np.flatnonzero(np.frombuffer(batch["anchors"][i].as_py(), bool))
                name = batch["block"][i].as_py()
                for at in (chosen[s : s + size] for s in range(0, len(chosen), size)):
                    a, kind = block["vecs"][at], block["labels"][at]
                    _, value = best(own_label(a, kind, at, block), rule.positives)
                    bound = value[:, -1] if value.shape[1] == rule.positives else np.full(len(at), _LEAST)
                    if held + len(at) > size:
                        yield tile(parts)
                        parts, held = [], 0
                    parts.append((np.full(len(at), name), at, block["ids"][at], kind, a, bound))
                    held += len(at)
        if parts:
            yield tile(parts)

    binary = ", ".join(f"{c} binary" for c in "home place a_ids a_labels a_vecs bound".split())
    columns = blocks.select("block", "ids", "labels", "anchors", "vecs")
    return staged(columns.mapInArrow(run, f"tile bigint, {binary}"), "tiles")


def chosen_blocks(tiles: DataFrame, blocks: DataFrame, space: Space, wanted: Callable) -> DataFrame:
    """(tile, block, mask): which anchors of a tile must read a block, by the zone maps alone.

    ``wanted`` gets a row of ``tiles`` with the bounds below and above each
    anchor's scores per block, and whether a block holds the anchor's own label and others.
    """
    packs = max(math.ceil(blocks.count() / _ZONES), 1)
    zone = F.struct("block", "least", "most", "kinds")
    zones = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(packs)).alias("pack")).agg(F.collect_list(zone).alias("zones"))
    met = tiles.withColumn("pack", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(packs - 1).cast("bigint")))).join(zones, "pack")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in batch.schema.names}
                a, kind = space.vectors(row["a_vecs"]), np.frombuffer(row["a_labels"], np.int64)
                low = space.vectors(b"".join(z["least"] for z in row["zones"]))
                high = space.vectors(b"".join(z["most"] for z in row["zones"]))
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                kinds = [np.frombuffer(z["kinds"], np.int64) for z in row["zones"]]
                own = np.stack([np.isin(kind, k) for k in kinds], 1)
                other = ~own | (np.array([len(k) for k in kinds]) > 1)[None, :]
                need = wanted(row, up @ low.T + down @ high.T, up @ high.T + down @ low.T, own, other)
                hit = np.flatnonzero(need.any(0))
                if len(hit):
                    masks = [np.packbits(need[:, j]).tobytes() for j in hit]
                    names = [row["zones"][j]["block"] for j in hit]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tile"]] * len(hit), pa.int64()), pa.array(names, pa.int64()), pa.array(masks, pa.binary())],
                        ["tile", "block", "mask"],
                    )

    return met.drop("pack").mapInArrow(run, "tile bigint, block bigint, mask binary")


def found(pairs: DataFrame, tiles: DataFrame, blocks: DataFrame, space: Space, windows: Callable, k: int) -> DataFrame:
    """(tile, i, w, score, id): the best ``k`` per anchor i and window w of the blocks each task sees.

    ``windows`` gives, for a row, the anchors in question, a block and their scores, one masked score table per window.
    """
    work = pairs.join(tiles, "tile").join(blocks.select("block", "ids", "labels", "vecs"), "block")

    def out(tile: int, kept: dict) -> pa.RecordBatch:
        rows = [(tile, i, w, s, d) for (i, w), pairs in kept.items() for s, d in pairs]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["tile", "i", "w", "score", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch[c][n].as_py() for c in batch.schema.names if c not in ("ids", "labels", "vecs")}
                block, a = _arrays(space, batch, n), space.vectors(row["a_vecs"])
                at = np.flatnonzero(np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=len(a)))
                kept = held.setdefault(row["tile"], {})
                for w, scores in enumerate(windows(row, at, a[at], block)):
                    place, value = best(scores, k)
                    for i, p, v in zip(at.tolist(), place, value):
                        got = [(int(s), int(block["ids"][q])) for q, s in zip(p, v) if s != _LEAST]
                        if got:
                            both = kept.get((i, w), []) + got
                            kept[i, w] = sorted(both, key=lambda x: (-x[0], x[1]))[:k]
                if sum(map(len, held.values())) > 50_000:
                    for tile, kept in held.items():
                        if kept:
                            yield out(tile, kept)
                    held = {}
        for tile, kept in held.items():
            if kept:
                yield out(tile, kept)

    return work.mapInArrow(run, "tile bigint, i int, w int, score bigint, id bigint")


def _windows(row: dict, n: int, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score per anchor and positive; empty windows where there is no positive."""
    low = np.full((n, rule.positives), 2**63 - 1, np.int64)
    high = np.full((n, rule.positives), _LEAST, np.int64)
    for p in row["positives"]:
        low[p["i"], p["w"]] = -(-rule.low * p["score"] // 100)
        high[p["i"], p["w"]] = rule.high * p["score"] // 100
    return low, high


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per (tile, i, w) with their rank; partial limits come before the shuffle."""
    from pyspark.sql import Window

    order = Window.partitionBy("tile", "i", "w").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(points: DataFrame, rule: Rule = Rule(), block: int = 4096, tile: int = 512) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``points`` has id and label (bigint), vec (array of whole numbers, bigint) and anchor (boolean).
    """
    columns = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    dims = points.agg(F.max(F.size("vec"))).first()[0] or 1
    fits = math.isqrt((2**63 - 1) // (100 * max(dims, 1)))
    points = points.where(F.forall("vec", lambda x: x.between(-fits, fits)))
    known = space_of(points)
    if known is None:
        return points.sparkSession.createDataFrame([], columns)
    space, rows = known
    blocks = blocks_of(points.withColumn("id", F.coalesce("id", F.lit(NO_ID))), space, rows, block)
    tiles = anchor_tiles(blocks, space, rule, tile)

    def reaches(row, low, high, own, other):
        return own & (high >= np.frombuffer(row["bound"], np.int64)[:, None])

    def of_own_label(row, at, a, block):
        home, place = (np.frombuffer(row[c], np.int64)[at] for c in ("home", "place"))
        kind = np.frombuffer(row["a_labels"], np.int64)[at]
        yield own_label(a, kind, np.where(home == row["block"], place, -1), block)

    pairs = staged(chosen_blocks(tiles, blocks, space, reaches), "pairs")
    near = _ranked(found(pairs, tiles, blocks, space, of_own_label, rule.positives), rule.positives)
    positives = staged(near.select("tile", "i", (F.col("rank") - 1).alias("w"), "score", "id"), "positives")
    discard(pairs)

    # a tile has at most tile * positives of these
    listed = positives.groupBy("tile").agg(F.collect_list(F.struct("i", "w", "score")).alias("positives"))
    windowed = staged(tiles.drop("bound", "home", "place").join(listed, "tile"), "windows")

    def overlaps(row, low, high, own, other):
        first, last = _windows(row, len(low), rule)
        need = np.zeros(low.shape, bool)
        for w in range(rule.positives):
            need |= (high >= first[:, w : w + 1]) & (low <= last[:, w : w + 1])
        return need & other

    def in_windows(row, at, a, block):
        first, last = _windows(row, len(row["a_labels"]) // 8, rule)
        scores = (a @ block["vecs"].T).astype(np.int64)
        scores[np.frombuffer(row["a_labels"], np.int64)[at][:, None] == block["labels"][None, :]] = _LEAST
        for w in range(rule.positives):
            inside = (scores >= first[at, w][:, None]) & (scores <= last[at, w][:, None])
            yield np.where(inside, scores, _LEAST)

    pairs = staged(chosen_blocks(windowed, blocks, space, overlaps), "pairs")
    negatives = _ranked(found(pairs, windowed, blocks, space, in_windows, rule.negatives), rule.negatives)
    negatives = staged(
        negatives.select("tile", "i", "w", "rank", F.col("score").alias("negative_score"), F.col("id").alias("negative_id")), "negatives"
    )
    names = tiles.mapInArrow(_names, "tile bigint, i int, anchor_id bigint")
    out = negatives.join(positives, ["tile", "i", "w"]).join(names, ["tile", "i"])
    real = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    out = out.withColumnRenamed("id", "positive_id").withColumnRenamed("score", "positive_score")
    out = staged(
        out.select("anchor_id", real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score"), "hard"
    )
    for table in (blocks, tiles, windowed, pairs, positives, negatives):
        discard(table)
    return out


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = np.frombuffer(batch["a_ids"][i].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch["tile"][i].as_py()] * len(ids), pa.int64()), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)],
                ["tile", "i", "anchor_id"],
            )


def points_of(vectors: DataFrame, every: int = 50, relabelled: int = 7, kinds: int = 10) -> DataFrame:
    """Rows that take part, with whole components; each ``relabelled``-th id has the next of ``kinds`` labels."""
    x = F.col("embedding").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    label = F.col("label").cast("bigint")
    scaled = F.transform(x, lambda v: F.floor(256 * v))
    return vectors.where(F.col("label").isNotNull() & x.isNotNull() & F.forall(x, finite)).select(
        F.col("vec_id").cast("bigint").alias("id"),
        F.when(F.col("vec_id") % relabelled == 0, (label + 1) % kinds).otherwise(label).alias("label"),
        scaled.alias("vec"),
        F.coalesce(F.col("vec_id") % every == 0, F.lit(False)).alias("anchor"),
    )


@query(
    "op12_hard_negatives",
    """
    WITH p AS (
        SELECT row_number() OVER () AS row, vec_id,
            CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
    ),
    s AS (
        SELECT a.row AS a_row, a.vec_id AS anchor_id, b.row AS b_row, b.vec_id, a.label = b.label AS same,
            list_dot_product(a.v, b.v)::BIGINT AS score
        FROM p a JOIN p b ON a.row <> b.row WHERE a.vec_id % 50 = 0
    ),
    g AS (
        SELECT a_row, anchor_id, b_row, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY a_row ORDER BY score DESC, vec_id) <= 5
    )
    SELECT g.anchor_id, g.positive_id,
        row_number() OVER (PARTITION BY g.a_row, g.b_row ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
        s.vec_id AS negative_id, g.positive_score, s.score AS negative_score
    FROM g JOIN s ON s.a_row = g.a_row AND NOT s.same
        AND 50 * g.positive_score <= 100 * s.score AND 100 * s.score <= 95 * g.positive_score
    QUALIFY row_number() OVER (PARTITION BY g.a_row, g.b_row ORDER BY s.score DESC, s.vec_id) <= 3
    """,
)
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives(points_of(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")))
