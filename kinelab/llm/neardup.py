"""Operator 9: MinHash near-duplicates with odd sketches.

A document is the set of its distinct k-word shingles. Its MinHash samples are
used twice: six at a time as band keys that propose pairs, and folded into a
parity bitmap (odd sketch). The XOR of two bitmaps is the bitmap of the samples
in which two documents differ, so its population count estimates a high
similarity precisely; only pairs that it leaves possible are confirmed on the
full sets.

Steps, none of which lists all pairs of a group:

1. equal sets collapse to one numbered class, for which its first row stands;
2. in each band bucket every class is paired with the bucket's smallest one;
   of these pairs each class keeps the one whose sketches are nearest, and that
   one is confirmed exactly: this alone joins a group of copies into (nearly)
   one component;
3. in buckets that still hold several components, pairs of different components
   whose sketches allow the threshold are confirmed exactly, inside the task
   that holds the bucket: nearest sketches first, and no further pair of two
   components once one has joined them. Only such links leave the task. A large
   bucket is cut into a triangle of blocks.

Links inside one component change nothing, so every link between proposed pairs
takes effect. With ``BANDS`` bands of ``ROWS`` samples a pair at the threshold
0.8 is missed with probability (1 - 0.8^6)^40, about 5e-6, and by the sketches'
bound (five standard deviations) with about 3e-7.

Defined cases: null or empty text, or text without words, has no shingles,
links with nothing and stays; fewer words than k make one shingle; texts decide
and not ids, so different texts under one doc_id are not linked by it, repeated
rows belong together, and rows without a doc_id link like any other;
component_id is the smallest doc_id of the component that is not null, if any;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches, staged
from kinelab.llm.components import connected_components
from kinelab.llm.groupwise import starts_of, triangle, whole_groups
from kinelab.llm.textbytes import NON_SPACE, buffers, mix, shingle_sets, slices, word_hashes

SAMPLES = 256
BANDS, ROWS = 40, 6
BITS = 1024
#: Rows and shingles of a bucket in one block, and members confirmed against one text in one task.
BLOCK_ROWS, BLOCK_SHINGLES, MEMBERS = 1_000, 2_000_000, 400

_rng = np.random.default_rng(20)
_MUL = _rng.integers(0, 1 << 31, SAMPLES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_FOLD = _rng.integers(0, 1 << 31, SAMPLES).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def most_different(threshold: float) -> int:
    """Population count up to which two odd sketches may still reach the threshold."""
    low = threshold - 5 * math.sqrt(threshold * (1 - threshold) / SAMPLES)
    return math.ceil(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - low) / BITS)))


def _sets(batch_texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, off = buffers(batch_texts)
    for i, j in slices(off):
        rows, words = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], NON_SPACE)
        set_off, hashes = shingle_sets(rows, words, j - i, k)
        yield i, j, set_off, hashes


def _sample(off: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """MinHash samples, a row per non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(off), SAMPLES), np.uint32)
    tmp = np.empty_like(x)
    for s in range(SAMPLES):
        np.bitwise_xor(x, _XOR[s], out=tmp)
        np.multiply(tmp, _MUL[s], out=tmp)
        out[:, s] = np.minimum.reduceat(tmp, off)
    return out


def _bands(samples: np.ndarray) -> np.ndarray:
    part = samples[:, :BANDS * ROWS].reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2]).copy()
    for j in range(ROWS):
        acc = mix(acc ^ (part[:, :, j] + np.uint64(0x9E3779B97F4A7C15)))
    return acc.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of ``BITS`` bits, as 64-bit words: one sample flips one bit."""
    n = len(samples)
    place = np.arange(SAMPLES, dtype=np.uint32) * np.uint32(0x85EBCA6B)
    bit = ((samples ^ place) * _FOLD) >> np.uint32(32 - BITS.bit_length() + 1)
    flips = np.bincount((np.arange(n)[:, None] * BITS + bit).ravel(), minlength=n * BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, BITS), axis=1).view(np.int64)


def _lists(values: np.ndarray, has: np.ndarray) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(np.where(has, values.shape[1] if values.ndim > 1 else 0, 0))])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values.ravel(), pa.int64()))


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, h in _sets(batch.column(1), k):
                n = np.diff(off)
                has = n > 0
                h1, h2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                samples = np.zeros((0, SAMPLES), np.uint32)
                if has.any():
                    at = off[:-1][has]
                    h1[has] = np.add.reduceat(mix(h), at)
                    h2[has] = np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
                    samples = _sample(at, h)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                     _lists(_bands(samples) if len(samples) else np.zeros((0, BANDS), np.int64), has),
                     _lists(odd_sketch(samples) if len(samples) else np.zeros((0, BITS // 64), np.int64), has),
                     batch.column(2).slice(i, j - i)],
                    ["doc_id", "n_shingles", "h1", "h2", "bands", "sketch", "text_key"])
    return run


def _confirm(k: int, num: int, den: int):
    """Pairs (a, b) whose full sets reach num / den; each group starts with its hub's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hubs = None, []
        for batch in batches:
            hub, blk, kind = (batch.column(c).to_pylist() for c in ("a", "blk", "kind"))
            ids = batch.column("id").to_pylist()
            found: set[tuple] = set()
            for i, j, off, h in _sets(batch.column("text"), k):
                for r in range(i, j):
                    mine = h[off[r - i]:off[r - i + 1]]
                    if (hub[r], blk[r]) != at:
                        at, hubs = (hub[r], blk[r]), []
                    if kind[r] == 0:
                        hubs.append(mine)
                        continue
                    if any(overlap(mine, other, num, den) for other in hubs):
                        found.add((hub[r], ids[r]))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field("a").type), pa.array(b, batch.schema.field("a").type)], ["a", "b"])
    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int, name: str) -> DataFrame:
    """The pairs (a, b) that link; the members of a hub ``a`` are dealt to several tasks."""
    id_type = texts.schema["id"].dataType.simpleString()
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    dealt = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("d") / MEMBERS)).alias("blk"))
    members = dealt.join(texts, F.col("b") == F.col("id")).select("a", "blk", F.lit(1).alias("kind"), "id", "text")
    hubs = dealt.select("a", "blk").distinct().join(texts, F.col("a") == F.col("id")).select("a", "blk", F.lit(0).alias("kind"), "id", "text")
    rows = members.unionByName(hubs).repartition("a", "blk").sortWithinPartitions("a", "blk", "kind")
    return staged(rows.mapInArrow(_confirm(k, num, den), f"a {id_type}, b {id_type}"), name)


def overlap(mine: np.ndarray, other: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach num / den."""
    small, large = (mine, other) if len(mine) <= len(other) else (other, mine)
    if not len(small) or den * len(small) < num * len(large):
        return False
    pos = np.searchsorted(large, small)
    pos[pos == len(large)] = 0
    both = int((large[pos] == small).sum())
    return den * both >= num * (len(small) + len(large) - both)


def _matrix(t: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in t.column(name).chunks]).reshape(t.num_rows, -1)


def _bridges(k: int, num: int, den: int, limit: int):
    """Links between different components in a bucket cell, enough of them to join what belongs together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["key", "bi", "bj"]):
            n = t.num_rows
            col = lambda c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)  # noqa: E731,B023
            starts = starts_of([col(c) for c in ("key", "bi", "bj")])
            end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
            key, side, within, sketch, bands = col("key"), col("side"), col("bi") == col("bj"), _matrix(t, "sketch").view(np.uint64), _matrix(t, "bands")
            comp = np.unique(col("component"), return_inverse=True)[1]
            first, second, apart, i, d = [], [], [], np.arange(n), 1
            while True:
                i = i[i + d < end[i]]
                if not len(i):
                    break
                c = (comp[i] != comp[i + d]) & (within[i] | (side[i] != side[i + d]))
                a = i[c]
                dist = np.bitwise_count(sketch[a] ^ sketch[a + d]).sum(1)
                a, dist = a[dist <= limit], dist[dist <= limit]
                if len(a):  # a pair that meets in several buckets is confirmed in the first of them
                    same = bands[a] == bands[a + d]
                    mine = bands[a, same.argmax(1)] == key[a]
                    a, dist = a[mine], dist[mine]
                first.append(a)
                second.append(a + d)
                apart.append(dist)
                d += 1
            if not first or not sum(map(len, first)):
                continue
            order = np.argsort(np.concatenate(apart), kind="stable")
            first, second = np.concatenate(first)[order], np.concatenate(second)[order]
            sets: list[np.ndarray] = []
            for x, y, off, h in _sets(t.column("text").combine_chunks(), k):
                sets += [h[off[r]:off[r + 1]] for r in range(y - x)]
            ids, found = t.column("id").combine_chunks(), []
            while len(first):
                for a, b in zip(first[:1024].tolist(), second[:1024].tolist()):
                    if comp[a] != comp[b] and overlap(sets[a], sets[b], num, den):
                        comp[comp == comp[b]] = comp[a]
                        found.append((a, b))
                first, second = first[1024:], second[1024:]
                still = comp[first] != comp[second]
                first, second = first[still], second[still]
            if found:
                a, b = (pa.array(x, pa.int64()) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([ids.take(a), ids.take(b)], ["a", "b"])
    return run


def signatures(docs: DataFrame, k: int = 2) -> DataFrame:
    """doc_id, text_key, n_shingles, set hashes, band keys and odd sketch of every document."""
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.md5("text").alias("text_key")).mapInArrow(
        _signatures(k), f"doc_id {id_type}, n_shingles long, h1 long, h2 long, bands array<long>, sketch array<long>, text_key string")


SAME = ["h1", "h2", "n_shingles"]


def _classes(sig: DataFrame) -> DataFrame:
    """Equal sets: their hashes, a number of the class, and its first row (smallest doc_id, then text; copies of it)."""
    rows = sig.where("n_shingles > 0").groupBy(*SAME, "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "copies")).alias("first")
    return staged(rows.groupBy(*SAME).agg(first).withColumn("id", F.monotonically_increasing_id()), "near-classes")


def _of_class(rows: DataFrame, classes: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of one row of each class that ``classes`` lists: its first one."""
    same = F.col("r.doc_id").eqNullSafe(F.col("c.first.doc_id")) & F.col("r.text_key").eqNullSafe(F.col("c.first.text_key"))
    found = rows.alias("r").join(classes.alias("c"), same).select("c.id", "c.first.copies", *[f"r.{x}" for x in columns])
    once = found.where("copies = 1").drop("copies")
    return once.unionByName(found.where("copies > 1").drop("copies").dropDuplicates(["id"]))


def _components(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(signatures, component of each class: set hashes and the component's first row)."""
    limit = most_different(num / den)
    sig = staged(signatures(docs, k), "near-signatures")
    classes = _classes(sig)
    reps = staged(_of_class(sig, classes, "n_shingles", "bands", "sketch"), "near-reps")

    keys = reps.select("id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("leader")).where("m > 1")
    members = staged(keys.join(buckets, "key"), "near-buckets")
    sketches = reps.select("id", "sketch")

    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    stars = members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    nearest = (stars.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a")
               .join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
               .select("a", "b", apart.alias("d")).where(F.col("d") <= limit)
               .groupBy("b").agg(F.min(F.struct("d", "a")).alias("best")).select("best.a", "b"))

    candidates = classes.join(members.select("id").distinct(), "id", "left_semi")
    texts = staged(_of_class(docs.select("doc_id", "text", F.md5("text").alias("text_key")), candidates, "text"), "near-texts")
    first = _confirmed(staged(nearest, "near-nearest"), texts, k, num, den, "near-first")
    joined = staged(connected_components(first), "near-joined")

    placed = members.join(joined, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"))
    open_rows = staged(placed.join(mixed, "key").join(reps, "id"), "near-open")
    blocks = open_rows.groupBy("key").agg(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    cells = (triangle(open_rows.join(blocks, "key"), F.col("blocks"), F.xxhash64("id"), 1).join(texts, "id")
             .repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj"))
    second = staged(cells.mapInArrow(_bridges(k, num, den, limit), "a long, b long"), "near-second")

    old = lambda side: joined.select(F.col("id").alias(side), F.col("component").alias(f"c{side}"))
    bridges = (second.join(old("a"), "a", "left").join(old("b"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = connected_components(bridges).select(F.col("id").alias("c"), F.col("component").alias("top"))

    found = (classes.join(joined, "id", "left").withColumn("c", F.coalesce("component", "id")).join(merged, "c", "left")
             .select(*SAME, "first", F.coalesce("top", "c").alias("c")))
    chosen = found.groupBy("c").agg(F.min("first").alias("chosen"))
    return sig, staged(found.join(chosen, "c").select(*SAME, "chosen"), "near-found")


def near_duplicates(docs: DataFrame, k: int = 2, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    sig, found = _components(docs, k, num, den)
    component = F.when(F.col("n_shingles") > 0, F.col("chosen.doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    return (sig.select("doc_id", *SAME).join(found, SAME, "left").select("doc_id", "n_shingles", component)
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_of_each(docs: DataFrame, k: int = 2, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of its smallest doc_id (then text).

    Texts decide, not ids: rows without a doc_id, and different texts under one
    doc_id, stay if their components are different ones. Documents without
    shingles stay. Of rows equal in doc_id and text one stays.
    """
    sig, found = _components(docs, k, num, den)
    chosen = found.select("chosen.doc_id", "chosen.text_key").distinct()
    empty = sig.where("n_shingles = 0").select("doc_id", "text_key").distinct()
    stay = staged(chosen.unionByName(empty).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "near-stay")
    copies = (sig.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.md5("text").eqNullSafe(F.col("_key"))
    rows = docs.join(stay, same, "left_semi")
    repeated = staged(copies, "near-copies")
    once = rows.join(repeated, same, "left_anti")
    return once.unionByName(rows.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
