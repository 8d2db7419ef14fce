"""Operator 13: hard negatives by Strassen products of integer tiles.

Anchors and candidates are packed into tiles, matrices of whole numbers with a
vector per row. The scores of an anchor tile against a candidate tile are one
matrix product, by Strassen's seven recursive products with zero padding where
a side is odd. All additions are whole-number ones; they may wrap around on
the way, which the ring of 64-bit numbers allows, as the scores themselves fit.

Two passes over the grid of tiles:

1. anchors meet the candidates of their label bucket; each task keeps per anchor
   a heap of its best positives,
2. anchors with the scores of their positives meet all candidates; each task
   keeps per anchor and positive a heap of the best negatives in its window.

Heaps of the same anchor merge, first inside a task and then over tasks (by a
window that keeps the first rows), so nothing but the heaps leaves a task. The
grid is dealt by candidate tile: a hot label is many tiles, and an anchor tile
goes to each candidate tile once.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; only vectors of equal length meet, and empty ones score
0; a repeated row is a row of its own (another row of the same id may be a
positive); ties go to the smaller id; components and scores beyond a long are
held at its ends; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches, staged

#: Fixed values of the window: 50 p <= 100 n <= 95 p.
LOW, HIGH = 50, 95
#: Rows of a tile, about; label buckets; the side below which a product is taken directly.
ANCHOR_ROWS, TILE_ROWS, BUCKETS, LEAF = 512, 4096, 64, 32
#: Anchor tiles whose heaps a task holds before it hands them on.
HELD = 32

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two whole-number matrices."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1, p2 = strassen(a11 + a22, b11 + b22), strassen(a21 + a22, b11)
    p3, p4 = strassen(a11, b12 - b22), strassen(a22, b21 - b11)
    p5, p6 = strassen(a11 + a12, b22), strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), a.dtype)
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b, held at the ends of a long."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    size = lambda x: max(int(x.max()), -int(x.min()))
    if 100 * a.shape[1] * size(a) * size(b) <= _MOST:
        return strassen(a, b.T)
    big = strassen(a.astype(object), b.T.astype(object))
    return np.clip(big, _LEAST + 1, _MOST).astype(np.int64)


def best(values: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k largest values and their ids, ties to the smaller id; ids ascend. ``values`` is used up."""
    every, top, who = np.arange(len(values)), [], []
    for _ in range(min(k, values.shape[1])):
        at = np.argmax(values, axis=1)  # the first of the largest
        top.append(values[every, at])
        who.append(ids[at])
        values[every, at] = _LEAST
    empty = np.zeros((len(values), 0), np.int64)
    return (np.column_stack(top), np.column_stack(who)) if top else (empty, empty)


def merged(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k per row of two heaps (values, ids); missing entries have the least value."""
    v, i = np.concatenate([x[0], y[0]], axis=-1), np.concatenate([x[1], y[1]], axis=-1)
    order = np.lexsort((i, -v.clip(_LEAST + 1)), axis=-1)[..., :k]
    return np.take_along_axis(v, order, -1), np.take_along_axis(i, order, -1)


class Tile:
    """ids, labels, row numbers and vectors of a tile's rows, by ascending id."""

    def __init__(self, batch: pa.RecordBatch, r: int, side: str):
        get = lambda name: batch.column(f"{side}_{name}")[r].values
        ids = get("id").to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        self.id, self.order = ids[order], order
        self.label = get("label").to_numpy(zero_copy_only=False)[order]
        self.row = get("row").to_numpy(zero_copy_only=False)[order]
        flat = get("flat").to_numpy(zero_copy_only=False) if len(get("flat")) else np.zeros(0, np.int64)
        self.vectors = flat.reshape(len(ids), -1).astype(np.int64)[order]


def _held(batches: Iterator[pa.RecordBatch], each, merge, flush) -> Iterator[pa.RecordBatch]:
    """Run ``each`` on every pair of tiles; heaps of an anchor tile merge and leave when too many are held."""
    held: dict[tuple, tuple] = {}
    for batch in batches:
        for r in range(batch.num_rows):
            a = Tile(batch, r, "a")
            key = tuple(a.row.tolist())
            got = each(batch, r, a, Tile(batch, r, "c"))
            held[key] = merge(held[key], got) if key in held else got
            if len(held) > HELD:
                yield from (flush(rows, held.pop(rows)) for rows in [*held])
    yield from (flush(rows, held.pop(rows)) for rows in [*held])


def _positives(k: int):
    def each(batch, r, a: Tile, c: Tile):
        s = scores(a.vectors, c.vectors)
        s[(a.label[:, None] != c.label) | (a.row[:, None] == c.row)] = _LEAST
        return best(s, c.id, k)

    def flush(rows: tuple, heap) -> pa.RecordBatch:
        value, who = heap
        here = value > _LEAST
        at = np.repeat(np.arange(len(rows)), here.sum(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(np.array(rows, np.int64)[at]), pa.array(value[here]), pa.array(who[here])], ["row", "score", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _held(batches, each, lambda x, y: merged(x, y, k), flush)
    return run


def _negatives(k: int):
    def each(batch, r, a: Tile, c: Tile):
        s = scores(a.vectors, c.vectors)
        s[a.label[:, None] == c.label] = _LEAST
        positives = batch.column("a_scores")[r].as_py()
        positives = [positives[i] for i in a.order]
        heaps = []
        for p in range(max(map(len, positives))):
            score = [x[p] if p < len(x) else None for x in positives]
            # an anchor without this positive gets an empty window
            low = np.array([_MOST if x is None else -(-LOW * x // 100) for x in score], np.int64)[:, None]
            high = np.array([_LEAST if x is None else HIGH * x // 100 for x in score], np.int64)[:, None]
            heaps.append(best(np.where((s >= low) & (s <= high) & (s > _LEAST), s, _LEAST), c.id, k))
        return np.stack([h[0] for h in heaps], 1), np.stack([h[1] for h in heaps], 1)

    def flush(rows: tuple, heap) -> pa.RecordBatch:
        value, who = heap
        here = value > _LEAST
        at, p, _ = np.nonzero(here)
        return pa.RecordBatch.from_arrays([pa.array(np.array(rows, np.int64)[at]), pa.array(p.astype(np.int32)), pa.array(value[here]), pa.array(who[here])],
                                          ["row", "p", "score", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _held(batches, each, lambda x, y: merged(x, y, k), flush)
    return run


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, vector: floor(scale * x) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (rows.select("vec_id", F.col("label").cast("long").alias("label"), x.alias("_x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_x").isNotNull()).where(sound)
            .select("vec_id", "label", F.transform("_x", lambda v: F.floor(v * float(scale))).alias("vector")))


def _tiles(rows: DataFrame, per_tile: int, side: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """dims, bucket, {side}_sub and the tile's rows as arrays; rows go to the tiles of their bucket by their number."""
    n = rows.groupBy("dims", "bucket").agg(F.ceil(F.count(F.lit(1)) / per_tile).alias("n"))
    sub = F.pmod(F.xxhash64("row"), F.col("n")).alias(f"{side}_sub")
    fields = ["id", "label", "row", "vector", *extra]
    packed = (rows.join(n, ["dims", "bucket"]).select("dims", "bucket", sub, *fields)
              .groupBy("dims", "bucket", f"{side}_sub").agg(F.collect_list(F.struct(*fields)).alias("m")))
    return packed.select("dims", "bucket", f"{side}_sub", *[F.col(f"m.{f}").alias(f"{side}_{f}") for f in ("id", "label", "row", *extra)],
                         F.flatten("m.vector").alias(f"{side}_flat"))


def _grid(anchors: DataFrame, tiles: DataFrame, same_bucket: bool) -> DataFrame:
    """Each anchor tile beside each candidate tile of its length (and bucket), dealt by candidate tile."""
    where = ["dims", "bucket"] if same_bucket else ["dims"]
    places = tiles.select("dims", F.col("bucket").alias("c_bucket"), "c_sub", *(["bucket"] if same_bucket else []))
    copies = anchors.join(places, where).drop("bucket")
    key = ["dims", "c_bucket", "c_sub"]
    n = max(1, places.count())
    parts = min(n, 4 * int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return copies.repartition(parts, *key).join(tiles.withColumnRenamed("bucket", "c_bucket").repartition(parts, *key), key)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and vector (array of longs); ``is_anchor`` is a
    condition over them.
    """
    spark = rows.sparkSession
    small_batches(spark)
    numbered = staged(rows.select(
        F.col("vec_id").alias("id"), "label", "vector", is_anchor.alias("anchor"), F.size("vector").alias("dims"),
        F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).alias("bucket"), F.monotonically_increasing_id().alias("row")), "hard-rows")
    anchors = numbered.where("anchor")
    tiles = staged(_tiles(numbered, TILE_ROWS, "c"), "hard-tiles")

    first = Window.partitionBy("row").orderBy(F.col("score").desc(), "other")
    found = (_grid(_tiles(anchors, ANCHOR_ROWS, "a"), tiles, True)
             .mapInArrow(_positives(positives), "row long, score long, other long"))
    kept = staged(found.withColumn("p", F.row_number().over(first) - 1).where(F.col("p") < positives), "hard-positives")

    windows = kept.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "score"))), lambda x: x["score"]).alias("scores"))
    second = _grid(_tiles(anchors.join(windows, "row"), ANCHOR_ROWS, "a", ("scores",)), tiles, False)
    nearest = Window.partitionBy("row", "p").orderBy(F.col("score").desc(), "other")
    out = (second.mapInArrow(_negatives(negatives), "row long, p int, score long, other long")
           .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= negatives)
           .select("row", "p", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score")))
    named = kept.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return (out.join(named, ["row", "p"])
            .select("anchor_id", F.col("other").alias("positive_id"), "rank", "negative_id",
                    F.col("score").alias("positive_score"), "negative_score"))
