"""Near-duplicate documents and vectors, nearest neighbours: against brute force."""

import math
import random

import numpy as np
import pytest

from kinelab.llm.components import connected_components
from kinelab.llm.neardup import near_duplicates
from kinelab.llm.neighbours import nearest
from kinelab.llm.vectordup import estimate, rotations, vector_links
from pyspark.sql import functions as F


def closure(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    import re
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    out = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {i for a, b in links if a != b for i in (a, b)}
    assert out == closure(ids, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice((6, 30, 120)))]
        out.append(" ".join(base))
        for _ in range(rng.choice((0, 2, 12))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((" " if rng.random() < 0.5 else "\n").join(copy))
    return out


def test_near_duplicates_match_brute_force(spark):
    texts = near_texts() + [None, "", " \t\n", "one", "ONE", "one two", "Ünï one", None]
    long = " ".join(f"x{i % 5000}" for i in range(700_000))  # longer than several slices
    texts += [long, long + " tail"]
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, n_shingles int")
    out = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    sets = {i: shingles(t) for i, t, *_ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = closure(sets, links)
    assert len(set(comp.values())) < len(comp) - 30
    for i in sets:
        assert (out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (len(sets[i]), comp[i], comp[i] == i), i


def test_near_duplicates_in_a_large_bucket_of_blocks(spark, monkeypatch):
    import kinelab.llm.neardup as m
    monkeypatch.setattr(m, "BLOCK_ROWS", 7)
    monkeypatch.setattr(m, "MEMBERS", 5)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(80):
        copy = list(base)
        for _ in range(rng.choice((1, 2, 3, 4))):
            copy[rng.randrange(60)] = f"v{rng.randrange(500)}"
        texts.append(" ".join(copy))
    out = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    comp = closure(sets, [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert out == comp


def test_near_duplicates_edges(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (7, "a b c")], "doc_id long, text string")
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect())
    assert rows == [(False, 1, 2, 1), (False, 1, 2, 1), (False, 7, 2, 1), (True, 0, 0, None), (True, 0, 2, 1)]
    # rows without an id link; of two texts under one id only the near one belongs to the group
    long = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(None, " ".join(long)), (None, " ".join([*long, "more"])), (8, "x y z"), (8, " ".join(["q", *long])), (9, "x y z")], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(None, 59, 8, False), (None, 60, 8, False), (8, 2, 8, True), (8, 60, 8, True), (9, 2, 8, False)], key=str)
    alone = near_duplicates(docs.where("doc_id is null"))
    assert [(r["component_id"], r["kept"]) for r in alone.collect()] == [(None, True)] * 2
    empty = near_duplicates(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def vectors(n, dim, seed=2):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        v = rng.standard_normal(dim)
        out.append(v)
        for _ in range(rng.integers(0, 6)):
            out.append(v + rng.standard_normal(dim) * np.linalg.norm(v) / math.sqrt(dim) * rng.choice((0.0, 0.05, 0.15, 0.2, 0.25)))
    return [[float(np.float32(x)) for x in v] for v in out[:n]]


def cosine(a, b):
    a, b = np.array(a, np.float64), np.array(b, np.float64)
    return float((a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)))


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


ODD = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0]]


@pytest.mark.parametrize("block", [2000, 4])
def test_vector_links_match_brute_force(spark, monkeypatch, block):
    import kinelab.llm.vectordup as m
    monkeypatch.setattr(m, "BLOCK_ROWS", block)
    vs = vectors(220, 16) + ODD + ODD[-1:]
    rows = [(i * 7 % 1009, v, None if i % 40 == 39 else i % 2, "n") for i, v in enumerate(vs)]
    got = {r["vec_id"]: r for r in vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string")).collect()}
    links = [(a, b) for a, v, la, _ in rows for b, w, lb, _ in rows if a < b and la is not None and la == lb
             and usable(v) and usable(w) and len(v) == len(w) and cosine(v, w) >= 0.98]
    assert len(links) > 50
    comp = closure([r[0] for r in rows], links)
    for i, *_ in rows:
        n = sum(i in x for x in links)
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n, comp[i], comp[i] == i)


def test_vector_links_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [0.0, 1.0], None)]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in vector_links(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 0, None), (1, 1, 1), (1, 1, 1), (4, 0, 4)]
    assert vector_links(spark.createDataFrame([], schema)).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((400, 64))
    b = a + 0.6 * rng.standard_normal((400, 64))
    n_rot = 4
    from kinelab.llm.vectordup import cosines, unit
    turned = unit(b) @ rotations(64, n_rot)
    codes = np.packbits(turned > 0, axis=1).view(np.int64)
    factors = np.abs(turned).reshape(400, n_rot, 64).sum(2) / 8
    est, err = estimate(a, codes, factors)
    true = cosines(a, b)
    assert abs((est - true).mean()) < 3 * err.mean() / 20
    assert (np.abs(est - true) <= 4 * err).mean() > 0.99


def brute_neighbours(rows, is_query, k):
    fit = [(i, v) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q, v in fit:
        if is_query(q):
            best = sorted((-cosine(v, w), i) for i, w in fit if i != q and len(v) == len(w))[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def test_nearest_recall_and_scores(spark):
    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in nearest(emb, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    rows = [(r["vec_id"], r["embedding"]) for r in emb.collect()]
    want = brute_neighbours(rows, lambda i: i % 50 == 0, 5)
    assert set(got) == set(want)
    hits = sum(len({x[1] for x in got[q]} & {x[0] for x in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    by_id = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == [1, 2, 3, 4, 5]
        assert [x[1:] for x in found] == sorted((x[1:] for x in found), key=lambda x: (-x[1], x[0]))
        assert all(abs(s - cosine(by_id[q], by_id[i])) < 1e-12 for _, i, s in found)


def test_nearest_ties_and_edges(spark):
    schema = "vec_id long, embedding array<float>, score string"
    rows = [(i, [1.0, 1.0], "x") for i in range(60)] + [(100, [1.0, 0.0], None), (150, None, None), (200, [0.0, 0.0], None), (None, [1.0, 0.0], None)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4]}
    few = nearest(spark.createDataFrame(rows[:3], schema), F.col("vec_id") % 50 == 0)
    assert [r["vec_id"] for r in few.orderBy("rank").collect()] == [1, 2]
    assert nearest(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
