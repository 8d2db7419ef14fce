"""Operator 6: approximate nearest neighbours with an inverted multi-index.

Unit vectors are cut in two halves, each half is quantised by its own k-means
codebook, and the pair of centroids is a vector's cell. A query walks the cells
by the sum of the two half distances, with a heap over the sorted halves, until
the cells hold the number of entries the index was calibrated to; the entries
of those cells are reranked by the exact cosine.

The codebooks are fitted on at most ``FIT_ROWS`` rows (those with the smallest
id hashes); every row is indexed. How many entries a query visits comes from
``PROBES`` sample queries searched exhaustively: it is the count within which
``RECALL`` of their true neighbours lie.

Cells sharing the first centroid form a group. Groups are cut into blocks of
at most about ``BLOCK_ROWS`` entries, so one very common vector spreads over
tasks, and a query goes once to each block of the groups it visits, with the
list of its cells there. Each block returns its k best, a window joins them.

Defined cases: rows with a null id, or a vector that is null, empty, zero or
holds null or non-finite components, take no part, nor do vectors whose length
is not the most frequent one (the smallest such on ties); rows with the query's
own id are not its candidates; ties go to the smaller vec_id; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelab.llm.common import staged
from kinelab.llm.vectordup import _matrix, cosines, unit, usable

FIT_ROWS = 8_192
PROBES = 128
RECALL = 0.97
CELL_ROWS = 64
MOST_CENTROIDS = 256
BLOCK_ROWS = 4_096
LEAST_VISIT = 256


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = distances(x, c).argmin(1)
        n = np.bincount(near, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = (x.shape[1] + 1) // 2
    return x[:, :h], x[:, h:]


class MultiIndex:
    """Two codebooks and the number of entries in each cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books, self.k = (first, second), len(first)
        self.counts = np.zeros((len(first), len(second)), np.int64)
        self.visit = 0

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = halves(unit(vectors))
        return distances(a, self.books[0]).argmin(1), distances(b, self.books[1]).argmin(1)

    def walk(self, d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells by ascending sum of half distances (multi-sequence heap)."""
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        heap, seen = [(s1[0] + s2[0], 0, 0)], {(0, 0)}
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(o1[i]), int(o2[j])
            for p in ((i + 1, j), (i, j + 1)):
                if p[0] < len(s1) and p[1] < len(s2) and p not in seen:
                    seen.add(p)
                    heapq.heappush(heap, (s1[p[0]] + s2[p[1]], *p))

    def visited(self, vectors: np.ndarray, most: int) -> Iterator[dict[int, list[int]]]:
        """For each vector: group -> cells, until ``most`` entries are seen."""
        a, b = halves(unit(vectors))
        for d1, d2 in zip(distances(a, self.books[0]), distances(b, self.books[1])):
            seen, out = 0, {}
            for i, j in self.walk(d1, d2):
                if self.counts[i, j]:
                    out.setdefault(i, []).append(j)
                    seen += int(self.counts[i, j])
                    if seen >= most:
                        break
            yield out

    def depth(self, vector: np.ndarray, cells: set[tuple[int, int]]) -> list[int]:
        """How many entries are seen when each of ``cells`` has been visited."""
        a, b = halves(unit(vector[None]))
        seen, out = 0, []
        for i, j in self.walk(distances(a, self.books[0])[0], distances(b, self.books[1])[0]):
            seen += int(self.counts[i, j])
            if (i, j) in cells:
                out.append(seen)
                if len(out) == len(cells):
                    break
        return out


def best(query: np.ndarray, query_id: int, ids: np.ndarray, vectors: np.ndarray, near: np.ndarray, k: int) -> list[tuple[int, float]]:
    """The k nearest by exact cosine; ``near`` are cosines up to rounding (-inf: not a candidate)."""
    near = np.where(ids == query_id, -np.inf, near)
    n = int((near > -np.inf).sum())
    if not n:
        return []
    least = np.partition(near, len(near) - min(k, n))[len(near) - min(k, n)]
    take = np.flatnonzero(near >= max(least - 1e-9, -2.0))
    score = cosines(np.broadcast_to(query, (len(take), len(query))), vectors[take])
    order = np.lexsort((ids[take], -score))[:k]
    return [(int(ids[take[o]]), float(score[o])) for o in order]


_FOUND = ["query_id", "vec_id", "score"]


def _found(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], _FOUND)


def _exhaustive(query_ids: np.ndarray, queries: np.ndarray, dim: int, k: int):
    turned = unit(queries).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"), dim)
                near = unit(x) @ turned
                yield _found([(int(q), *r) for i, q in enumerate(query_ids) for r in best(queries[i], q, ids, x, near[:, i], k)])
    return run


def _assign(index: MultiIndex, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c1, c2 = index.cells(_matrix(batch.column("embedding"), dim))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1, pa.int32()), pa.array(c2, pa.int32())], ["vec_id", "embedding", "c1", "c2"])
    return run


def _probe(index: MultiIndex, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, group, cells = [], [], []
            if batch.num_rows:
                for r, seen in enumerate(index.visited(_matrix(batch.column("embedding"), dim), index.visit)):
                    for g, c in seen.items():
                        row.append(r)
                        group.append(g)
                        cells.append(c)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at), batch.column("embedding").take(at), pa.array(group, pa.int32()),
                                              pa.array(cells, pa.list_(pa.int32()))], ["vec_id", "embedding", "c1", "cells"])
    return run


def _rerank(k_centroids: int, dim: int, k: int):
    """Each (group, block) starts with its entries; the probes after them stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("c1", "block", "kind")])
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for s, e in zip([0, *cut], [*cut, batch.num_rows]):
                if s == e:
                    continue
                part, key = batch.slice(s, e - s), (int(keys[0, s]), int(keys[1, s]))
                if key != at:
                    at, held, ready = key, [], None
                x = _matrix(part.column("embedding"), dim)
                ids = part.column("vec_id").to_numpy()
                if keys[2, s] == 0:
                    held.append((ids, x, part.column("c2").to_numpy()))
                    continue
                if ready is None:
                    ready = [np.concatenate(c) for c in zip(*held)] if held else []
                    turned = unit(ready[1]).T if held else None
                if not held:
                    continue
                near = unit(x) @ turned
                rows = []
                for i, cells in enumerate(part.column("cells").to_pylist()):
                    visits = np.zeros(k_centroids, bool)
                    visits[cells] = True
                    rows += [(int(ids[i]), *r) for r in best(x[i], ids[i], ready[0], ready[1], np.where(visits[ready[2]], near[i], -np.inf), k)]
                yield _found(rows)
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_FOUND_SCHEMA = "query_id long, vec_id long, score double"


def build_index(rows: DataFrame, dim: int, n: int, k: int) -> tuple[MultiIndex, DataFrame]:
    """Codebooks, calibrated visit count and the indexed rows (vec_id, embedding, c1, c2)."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).collect()
    x = np.array([r["embedding"] for r in sample], np.float64)
    centroids = int(min(MOST_CENTROIDS, len(x), max(1, round((n / CELL_ROWS) ** 0.5))))
    index = MultiIndex(*(k_means(h, centroids) for h in halves(unit(x))))
    elem = rows.schema["embedding"].dataType.simpleString()
    entries = staged(rows.mapInArrow(_assign(index, dim), f"vec_id long, embedding {elem}, c1 int, c2 int"), "neighbour-entries")
    for r in entries.groupBy("c1", "c2").count().collect():  # centroid pairs: MOST_CENTROIDS ** 2 rows at most
        index.counts[r["c1"], r["c2"]] = r["count"]

    ids = np.array([r["vec_id"] for r in sample[:PROBES]], np.int64)
    truth = _top(rows.select("vec_id", "embedding").mapInArrow(_exhaustive(ids, x[:PROBES], dim, k), _FOUND_SCHEMA), k)
    near = truth.join(entries.select("vec_id", "c1", "c2"), "vec_id").select("query_id", "c1", "c2").collect()  # PROBES * k rows
    depths = []
    for q, v in zip(ids, x):
        depths += index.depth(v, {(r["c1"], r["c2"]) for r in near if r["query_id"] == q})
    index.visit = max(LEAST_VISIT, int(np.quantile(depths, RECALL)) if depths else 0)
    return index, entries


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row."""
    rows = embeddings.where(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes["dim"], sizes["n"]
    rows = rows.where(F.size("embedding") == dim)
    index, entries = build_index(rows, dim, n, k)

    blocks = entries.groupBy("c1").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))  # MOST_CENTROIDS rows at most
    elem = rows.schema["embedding"].dataType.simpleString()
    held = (entries.join(F.broadcast(blocks), "c1")
            .select("c1", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"),
                    "vec_id", "embedding", "c2", F.lit(None).cast("array<int>").alias("cells")))
    probes = (rows.where(is_query).distinct().repartition(F.xxhash64("vec_id"))
              .mapInArrow(_probe(index, dim), f"vec_id long, embedding {elem}, c1 int, cells array<int>")
              .join(F.broadcast(blocks), "c1")
              .select("c1", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"),
                      "vec_id", "embedding", F.lit(0).alias("c2"), "cells"))
    dealt = held.unionByName(probes).repartition("c1", "block").sortWithinPartitions("c1", "block", "kind")
    return _top(dealt.mapInArrow(_rerank(index.k, dim, k), _FOUND_SCHEMA), k)
