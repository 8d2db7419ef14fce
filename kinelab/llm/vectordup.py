"""Operator 5: near-duplicate vectors by randomised-rotation binary codes.

Each unit vector is turned by seeded random rotations; the signs are its code,
and for each rotation the inner product of the vector with its own code (scaled
to unit length) is stored as correction factor. Dividing the inner product of
a code with another, rotated vector by that factor estimates the cosine without
bias, with an error that the factor and the dimension bound.

1. Equal vectors of a label collapse to one class with a count.
2. Tables of code bits propose pairs: vectors of one label that agree in all
   bits of a table meet in a bucket. The number of bits follows the logarithm
   of the number of vectors, and the number of tables is what keeps the miss
   probability at the threshold below ``MISS``. Within a bucket the Hamming
   distance of the whole codes drops pairs far out of reach (six standard
   deviations). Large buckets are cut into a triangle of blocks.
3. The estimate and its confidence interval decide: pairs whose upper bound is
   below the threshold go; all others are recomputed from the original vectors
   in double precision, and only those at or above the threshold link.

Defined cases: rows with a null id or label, or a vector that is null, empty,
zero or holds null or non-finite components, link with nothing and are their
own component; vectors of different lengths do not link; repeated rows are
vectors of their own (a count of the class); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab.llm.common import staged
from kinelab.llm.components import connected_components
from kinelab.llm.groupwise import starts_of, triangle, whole_groups
from kinelab.llm.textbytes import mix

MISS = 1e-6
#: Expected vectors per bucket are about 2 ** this, whatever the number of vectors.
BUCKET_BITS = 3
BLOCK_ROWS = 2_000
#: Half width of the confidence interval in standard errors.
WIDTH = 5.0


def plan(n: int, threshold: float) -> tuple[int, int]:
    """(bits per table, tables) for n vectors."""
    same = 1 - math.acos(threshold) / math.pi
    bits = max(4, math.ceil(math.log2(max(n, 2))) - BUCKET_BITS)
    return bits, math.ceil(math.log(MISS) / math.log1p(-same ** bits))


@lru_cache(maxsize=8)
def rotations(dim: int, n: int) -> np.ndarray:
    """n random rotations side by side: (dim, n * dim)."""
    rng = np.random.default_rng([dim, 5])
    out = []
    for _ in range(n):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(out).T


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b`` beside it, in double precision."""
    return np.clip((unit(a) * unit(b)).sum(axis=1), -1.0, 1.0)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        yield int(d), np.flatnonzero(dims == d)


def _codes(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch):
                part = batch.take(pa.array(rows))
                n_rot = max(1, -(-bits * tables // dim))
                turned = unit(_matrix(part.column("embedding"), dim)) @ rotations(dim, n_rot)
                sign = turned > 0
                factor = np.abs(turned).reshape(len(rows), n_rot, dim).sum(2) / math.sqrt(dim)
                words = -(-sign.shape[1] // 64)
                packed = np.zeros((len(rows), words * 8), np.uint8)
                raw = np.packbits(sign, axis=1)
                packed[:, :raw.shape[1]] = raw
                used = sign[:, :bits * tables].reshape(len(rows), tables, bits)
                weight = np.uint64(1) << np.arange(min(bits, 63), dtype=np.uint64)
                value = (used[:, :, :63].astype(np.uint64) * weight).sum(2) + np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                keys = mix(value).view(np.int64)
                lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), part.column("dim"), lists(keys), lists(packed.view(np.int64)), lists(factor)],
                    ["id", "label", "dim", "tables", "code", "factor"])
    return run


def _in_reach(bits: int, tables: int, threshold: float):
    p = math.acos(threshold) / math.pi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["key", "bi", "bj"]):
            t = t.combine_chunks()
            n = t.num_rows
            starts = starts_of([t.column(c).to_numpy() for c in ("key", "bi", "bj")])
            end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
            code = t.column("code").combine_chunks()
            sizes = np.diff(code.offsets.to_numpy())
            flat = code.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            one = np.zeros((n, int(sizes.max())), np.uint64)
            one[np.repeat(np.arange(n), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
            dim = t.column("dim").to_numpy()
            m = dim * np.maximum(1, -(-bits * tables // dim))
            limit = np.ceil(m * p + 6 * np.sqrt(m * p * (1 - p)))
            within = t.column("bi").to_numpy() == t.column("bj").to_numpy()
            side = t.column("side").to_numpy()
            ids, i, d = t.column("id").combine_chunks(), np.arange(n), 1
            while True:
                i = i[i + d < end[i]]
                if not len(i):
                    break
                j = i + d
                c = within[i] | (side[i] != side[j])
                a, b = i[c], j[c]
                near = np.bitwise_count(one[a] ^ one[b]).sum(1) <= limit[a]
                if near.any():
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(a[near])), ids.take(pa.array(b[near]))], ["a", "b"])
                d += 1
    return run


def estimate(vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased cosine estimates of ``vectors`` with coded vectors, and their standard errors."""
    n, dim = vectors.shape
    n_rot = factors.shape[1]
    turned = (unit(vectors) @ rotations(dim, n_rot)).reshape(n, n_rot, dim)
    signs = np.unpackbits(codes.view(np.uint8).reshape(n, -1), axis=1)[:, :n_rot * dim].reshape(n, n_rot, dim)
    own = ((2.0 * signs - 1) * turned).sum(2) / math.sqrt(dim)
    each = np.sqrt(np.maximum(1 - factors ** 2, 0) / factors ** 2 / max(dim - 1, 1))
    return (own / factors).mean(1), np.sqrt((each ** 2).mean(1) / n_rot)


def _undecided(threshold: float):
    """Pairs whose confidence interval reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch):
                for s in range(0, len(rows), 4096):
                    part = batch.take(pa.array(rows[s:s + 4096]))
                    n = part.num_rows
                    codes = part.column("code").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                    factors = part.column("factor").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                    est, err = estimate(_matrix(part.column("va"), dim), codes, factors)
                    yield part.select(["a", "b", "dim", "va"]).filter(pa.array(est + WIDTH * err >= threshold))
    return run


def _exact(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch):
                part = batch.take(pa.array(rows))
                cos = cosines(_matrix(part.column("va"), dim), _matrix(part.column("vb"), dim))
                yield part.select(["a", "b"]).filter(pa.array(cos >= threshold))
    return run


def usable(vector: str = "embedding"):
    """Not null, not empty, not zero, every component a finite number."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def vector_links(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    label_type = embeddings.schema["label"].dataType.simpleString()
    elem = embeddings.schema["embedding"].dataType.simpleString()
    rows = embeddings.select("vec_id", "label", "embedding")
    fit = rows.where(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = staged(fit.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("dim", F.size("embedding")), "vector-classes")

    bits, tables = plan(classes.count(), threshold)
    coded = staged(classes.select("id", "label", "dim", "embedding").mapInArrow(
        _codes(bits, tables), f"id {id_type}, label {label_type}, dim int, tables array<long>, code array<long>, factor array<double>"), "vector-codes")
    keys = coded.select("id", "dim", "code", F.explode("tables").alias("t"), "label").withColumn("key", F.xxhash64("label", "dim", "t")).drop("t", "label")
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    cells = (triangle(keys.join(buckets, "key"), F.col("m"), F.xxhash64("id"), BLOCK_ROWS)
             .repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj"))
    near = cells.mapInArrow(_in_reach(bits, tables, threshold), f"a {id_type}, b {id_type}")
    near = staged(near.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "vector-near")

    vectors = classes.select("id", "dim", "embedding")
    undecided = (near.join(vectors.select(F.col("id").alias("a"), "dim", F.col("embedding").alias("va")), "a")
                 .join(coded.select(F.col("id").alias("b"), F.col("dim").alias("dim_b"), "code", "factor"), "b")
                 .where("dim = dim_b").select("a", "b", "dim", "va", "code", "factor")
                 .mapInArrow(_undecided(threshold), f"a {id_type}, b {id_type}, dim int, va {elem}"))
    links = staged(undecided.join(vectors.select(F.col("id").alias("b"), F.col("embedding").alias("vb")), "b")
                   .where(F.size("vb") == F.col("dim")).select("a", "b", "dim", "va", "vb")
                   .mapInArrow(_exact(threshold), f"a {id_type}, b {id_type}").distinct(), "vector-links")

    copies = classes.groupBy("id").agg(F.sum("copies").alias("copies"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies, F.col("b") == F.col("id")).groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("others"))
    component = connected_components(links)
    per_class = (classes.select("label", "embedding", "id", "copies")
                 .join(others, "id", "left").join(component, "id", "left")
                 .select("label", F.xxhash64("embedding").alias("h1"), F.hash("embedding").alias("h2"),
                         (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("top")))
    marked = rows.select("vec_id", F.when(usable() & F.col("vec_id").isNotNull(), F.col("label")).alias("label"),
                         F.xxhash64("embedding").alias("h1"), F.hash("embedding").alias("h2"))
    out = marked.join(per_class, ["label", "h1", "h2"], "left")
    component_id = F.coalesce("top", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component_id).alias("kept"))
