"""Operator 11: runs of repeated words, by string synchronising sets.

A run is a maximal stretch of words with smallest period q that holds at least
``TIMES`` periods. A text of words is searched at the scales t = 8, 16, 32, ...;
scale t finds the periods from t to 2t - 1:

* Every stretch of t words has a hash. A place i is *selected* when the least
  hash of the places i .. i + t is that of i or of i + t. Equal surroundings
  of 2t words are selected alike, and any 3t - 1 words hold a selected place
  among their first t, unless their period is at most t / 4.
* Places inside such highly periodic regions are left out of the minima: each
  region belongs to a run of a lower scale, or of the periods below
  ``FIRST``, which are found beforehand by comparing the words with
  themselves, shifted. So the omitted periods are supplied by their own scale.
* In a run of period q, t <= q < 2t, a place selected in its first t words has
  the same surroundings as the place q further on, and no place between them
  has: two selected neighbours among equal surroundings propose the period.
  The proposal is extended both ways, word by word, and kept if it holds
  enough periods and no divisor of q is a period.

Hashes only propose. Neighbours closer than 2t whose hashes agree are compared
word by word; if two differ, the scale is searched again with other hashes.
The result is exact and does not depend on hashes or batches. The texts of a
batch are searched together, with a symbol of its own after each text.

Defined cases: null, empty and blank texts have no words and no runs, and an
empty collapsed text; repeated rows, null ids and ties count like any row; an
empty table gives an empty result; other columns are ignored, whatever their
names. One text must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches
from kinelab.llm.textbytes import mix

#: A run holds this many periods and this many words at least.
TIMES, LEAST = 4, 6
#: Periods below this are found by comparing shifted words.
FIRST = 8
#: Words searched together; a longer text is searched alone.
GROUP_WORDS = 1 << 19
WORD = r"[^\x20\x09-\x0D]+"

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(names: np.ndarray, t: int) -> np.ndarray:
    """Hashes of stretches of 2t words from those of t words."""
    with np.errstate(over="ignore"):
        return mix(names[:-t] * _LEFT + names[t:] * _RIGHT)


def _least(values: np.ndarray, t: int) -> np.ndarray:
    """Minimum of each t + 1 values in a row; t is a power of two."""
    m, width = values, 1
    while width < t:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[:-1], m[1:])


def _stretch(w: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The longest stretch [a, b) around ``at`` in which words q apart are equal."""
    end, step = at, 64
    while end < len(w) - q:
        stop = min(end + step, len(w) - q)
        differ = np.flatnonzero(w[end:stop] != w[end + q:stop + q])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, step * 2
    start, step = at, 64
    while start > 0:
        stop = max(start - step, 0)
        differ = np.flatnonzero(w[stop:start] != w[stop + q:start + q])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, step * 2
    return start, end + q


def _smallest(w: np.ndarray, a: int, b: int, q: int) -> bool:
    """Whether no divisor of the period q is a period of [a, b), which is at least 2q long."""
    rest, p = q, 2
    while rest > 1:
        if rest % p == 0:
            d = q // p
            if np.array_equal(w[a:b - d], w[a + d:b]):
                return False
            while rest % p == 0:
                rest //= p
        p = p + 1 if p * p <= rest else max(rest, p + 1)
    return True


def _shifted(w: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    """Runs of period q as (start, end, q), by comparing the words with themselves."""
    if len(w) <= q:
        return []
    equal = np.zeros(len(w) - q + 2, np.int8)
    equal[1:-1] = w[:-q] == w[q:]
    edge = np.diff(equal)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= (TIMES - 1) * q
    return [(a, b + q, q) for a, b in zip(start[long].tolist(), end[long].tolist()) if _smallest(w, a, b + q, q)]


def _selected(names: np.ndarray, regions: np.ndarray, t: int) -> np.ndarray:
    """Places of the synchronising set of scale t; ``regions`` are the highly periodic ones (first, last place)."""
    h = np.minimum(names, _NONE - np.uint64(1))
    if len(regions):
        depth = np.zeros(len(h) + 1, np.int64)
        np.add.at(depth, regions[:, 0], 1)
        np.add.at(depth, np.minimum(regions[:, 1] + 1, len(h)), -1)
        h[np.cumsum(depth[:-1]) > 0] = _NONE
    if len(h) <= t:
        return np.zeros(0, np.int64)
    m = _least(h, t)
    return np.flatnonzero((m != _NONE) & ((h[:-t] == m) | (h[t:] == m)))


def _alike(w: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> bool:
    """Whether the stretches of ``length`` words at all places a and b are equal, pair by pair."""
    step = max(1, (1 << 20) // length)
    span = np.arange(length)
    return all(np.array_equal(w[a[i:i + step, None] + span], w[b[i:i + step, None] + span]) for i in range(0, len(a), step))


def _proposals(w: np.ndarray, names: np.ndarray, doubled: np.ndarray, regions: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(places, periods) that selected neighbours with equal surroundings propose; None if hashes collided."""
    place = _selected(names, regions, t)
    around = doubled[place]
    order = np.argsort(around, kind="stable")
    place, around = place[order], around[order]
    apart = np.diff(place)
    near = np.flatnonzero((around[1:] == around[:-1]) & (apart < 2 * t))
    if not _alike(w, place[near], place[near + 1], 2 * t):
        return None
    near = near[apart[near] >= t]
    return place[near], apart[near]


def find_runs(words: list[np.ndarray], seed: int = 1) -> list[list[tuple[int, int, int]]]:
    """Per text (an array of word numbers >= 0): its runs (start, length, period) by start, then period."""
    sizes = np.array([len(x) for x in words], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    texts = np.flatnonzero(sizes >= TIMES)
    # each text ends in a symbol that occurs nowhere else: no run goes over it
    w = np.concatenate([np.zeros(0, np.int64), *(x for i in texts for x in (words[i], [-1 - int(i)]))]).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(sizes[texts] + 1)])[:-1]
    found = np.zeros((0, 4), np.int64)  # text, start, end, period

    def keep(runs: list[tuple[int, int, int]]) -> None:
        nonlocal found
        if runs:
            r = np.array(runs, np.int64)
            k = np.searchsorted(base, r[:, 0], side="right") - 1
            found = np.concatenate([found, np.column_stack([texts[k], r[:, 0] - base[k], r[:, 1] - base[k], r[:, 2]])])

    keep([r for q in range(1, FIRST) for r in _shifted(w, q)])
    with np.errstate(over="ignore"):
        names, t = mix(w.view(np.uint64) + np.uint64(seed) * _LEFT), 1
    while len(texts):
        enough = sizes[texts] >= TIMES * t
        if not enough.all():  # texts too short for this scale go
            stays = np.repeat(enough, sizes[texts] + 1)
            w, names, texts = w[stays], names[stays[:len(names)]], texts[enough]
            base = np.concatenate([[0], np.cumsum(sizes[texts] + 1)])[:-1]
            names = names[:max(len(w) - t + 1, 0)]
            continue
        doubled = _joined(names, t)
        if t >= FIRST:
            high = found[(found[:, 3] * 4 <= t) & (found[:, 2] - found[:, 1] >= t)]
            high = high[np.isin(high[:, 0], texts)]
            at = base[np.searchsorted(texts, high[:, 0])]
            got = _proposals(w, names, doubled, np.column_stack([at + high[:, 1], at + high[:, 2] - t]), t)
            if got is None:
                return find_runs(words, seed + 1)
            runs, reached = [], {}
            for s, q in sorted(zip(got[0].tolist(), got[1].tolist())):
                if s < reached.get(q, -1):
                    continue
                a, b = _stretch(w, s, q)
                reached[q] = b - q
                if b - a >= TIMES * q and _smallest(w, a, b, q):
                    runs.append((a, b, q))
            keep(runs)
        names, t = doubled, 2 * t
    for k, a, b, q in sorted(map(tuple, found.tolist()), key=lambda r: (r[0], r[1], r[3])):
        if b - a >= LEAST:
            out[k].append((a, b - a, q))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, q in runs:
        stays[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(stays)]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        at = 0
        while at < len(texts):
            # bytes.split() cuts at exactly the six ASCII white-space bytes
            split, total, numbers = [], 0, {}
            while at + len(split) < len(texts) and (not split or total < GROUP_WORDS):
                split.append((texts[at + len(split)] or b"").split())
                total += len(split[-1])
            coded = [np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words)) for words in split]
            runs = find_runs(coded)
            n = len(split)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(at, n),
                pa.array([len(x) for x in split], pa.int64()),
                pa.array([[{"start": s, "length": m, "period": q} for s, m, q in r] for r in runs], _RUNS),
                pa.array([b" ".join(collapse(x, r)) for x, r in zip(split, runs)], pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_words", "runs", "collapsed"])
            at += n


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed text of every document.

    One pass over the table: no shuffle, nothing but a batch in memory.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _search, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: documents whose id hash ends in 0 go on periodically from some word; others keep their text.

    Fixed values of the test rule: h = crc32 of the id, g = h / 10, the first
    word a = g % n, the period 1 + (n - a) / (3 + g % 8). Null ids are not hit.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n = F.size("_words").cast("long")
    g = F.floor(F.col("_h") / 10)
    hit = docs.select("doc_id", "text", h.alias("_h"))
    words = F.when(F.pmod(F.col("_h"), F.lit(10)) == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    prepared = (hit.withColumn("_words", words).withColumn("_n", n)
                .withColumn("_a", F.when(F.col("_n") > 0, F.pmod(g, F.col("_n"))))
                .withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.pmod(g, F.lit(8))))))

    def source(i: Column) -> Column:
        return F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))

    rebuilt = F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda i: F.get("_words", source(i).cast("int"))))
    return prepared.select("doc_id", F.when(F.col("_n") > 0, rebuilt).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of most periods, digests of all runs and of the collapsed text."""
    ratio = lambda a, b: (b["length"] * a["period"]) - (a["length"] * b["period"])  # noqa: E731  below 0: a has more periods

    def first(a: Column, b: Column) -> Column:
        return (F.when(ratio(a, b) != 0, F.signum(ratio(a, b).cast("double")))
                .when(a["start"] != b["start"], F.signum((a["start"] - b["start"]).cast("double")))
                .otherwise(F.signum((a["period"] - b["period"]).cast("double")))).cast("int")

    best = F.get(F.array_sort("runs", first), 0)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))))
    return (found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
