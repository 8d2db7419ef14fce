"""Operator 13 against plain products and sorting."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import kinelab.llm.hardneg as m
from kinelab.llm.hardneg import best, hard_negatives, integer_vectors, merged, scores, strassen
from kinelab.llm.queries import op13_hard_negatives
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<float>, id string, row int, score double, bucket string"


@given(st.integers(0, 90), st.integers(0, 90), st.integers(0, 90), st.integers(0, 2**31))
@settings(max_examples=60, deadline=None)
def test_strassen(a, k, b, seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(-10**6, 10**6, (a, k)), rng.integers(-10**6, 10**6, (k, b))
    assert np.array_equal(strassen(x, y), x @ y)


def test_strassen_wraps_and_recovers():
    """Sums on the way leave the range of a long, the products do not."""
    rng = np.random.default_rng(1)
    x, y = rng.integers(2**61, 2**62, (70, 70)), np.zeros((70, 70), np.int64)
    np.fill_diagonal(y, 1)
    assert np.array_equal(strassen(x, y), x)


def test_scores_beyond_a_long_are_held_at_its_ends():
    a = np.full((1, 40), 2**40)
    assert scores(a, np.array([[2**40] * 40, [-2**40] * 40, [1] * 40])).tolist() == [[2**63 - 1, -2**63 + 1, 40 * 2**40]]


@given(st.lists(st.integers(-3, 3), min_size=1, max_size=30), st.integers(1, 4), st.integers(1, 6))
@settings(max_examples=100, deadline=None)
def test_heaps_merge(values, parts, k):
    pairs = list(enumerate(values))
    heap = None
    for p in range(parts):
        mine = pairs[p::parts]
        if mine:
            got = best(np.array([[v for _, v in mine]], np.int64), np.array([i for i, _ in mine]), k)
            heap = merged(heap, got, k) if heap else got
    want = sorted(pairs, key=lambda x: (-x[1], x[0]))[:k]
    assert list(zip(heap[1][0].tolist(), heap[0][0].tolist())) == want


def expected(rows):
    """Rows (vec_id, label, vector of whole numbers); anchors are ids divisible by 50."""
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a % 50:
            continue
        s = [(sum(x * y for x, y in zip(v, w)), c, lab) for j, (c, lab, w) in enumerate(rows) if j != i and len(w) == len(v)]
        order = lambda xs: sorted(xs, key=lambda x: (-x[0], x[1]))
        for p, pid, _ in order(x for x in s if x[2] == label)[:5]:
            near = order(x for x in s if x[2] != label and 50 * p <= 100 * x[0] <= 95 * p)[:3]
            out += [(a, pid, r, n, p, score) for r, (score, n, _) in enumerate(near, 1)]
    return sorted(out)


def prepared(rows):
    got = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            got.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]))
    return got


def run(spark, df):
    rows = integer_vectors(df, 256)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0).collect())


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    want = expected(prepared(rows))
    assert sorted(tuple(r) for r in op13_hard_negatives(spark, SF).collect()) == want and len(want) > 50


@pytest.mark.parametrize("tile", [7, 4096])
def test_hot_label_ties_and_small_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(m, "TILE_ROWS", tile)
    monkeypatch.setattr(m, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(m, "HELD", 2)
    rng = random.Random(3)
    rows = [(i, 0 if i % 3 else rng.randrange(10), [rng.choice([0.0, 0.25, 0.5, -0.5, 1.0]) for _ in range(4)]) for i in range(400)]
    rows += [(50, 0, rows[50][2]), (50, 0, rows[50][2]), (51, 3, rows[51][2])]  # repeated rows
    df = spark.createDataFrame([(*r, "x", 1, 2.0, "b") for r in rows], SCHEMA)
    got = run(spark, df)
    assert got == expected(prepared(rows)) and len(got) > 60


def test_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(50, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 1.0]), (3, None, [1.0, 1.0]), (4, 1, None), (5, 2, [inf, 1.0]), (6, 2, [nan, 1.0]),
            (8, 2, [None, 1.0]), (None, 2, [1.0, 1.0]), (9, 2, [1.0, 1.0, 1.0]), (100, 1, [1.0, 1.0, 1.0]), (150, 5, []), (10, 5, []), (11, 6, []),
            (200, 1, [0.0, 0.0]), (12, 4, [0.1]), (250, 9, [3.0e38])]
    df = spark.createDataFrame([(*r, "x", 1, 2.0, "b") for r in rows], SCHEMA)
    got = run(spark, df)
    assert got == expected(prepared(rows))
    assert (150, 10, 1, 11, 0, 0) in got
    assert run(spark, df.limit(0)) == [] and run(spark, df.where("vec_id = 1")) == []
