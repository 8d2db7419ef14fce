import numpy as np
import pytest

from kinelab.operators.folds import stratified_folds


def reference_folds(labels, k):
    """Brute force of the public StratifiedKFold(shuffle=False) definition."""
    labels = list(labels)
    classes = []
    for y in labels:
        if y not in classes:
            classes.append(y)
    enc = [classes.index(y) for y in labels]
    order = sorted(enc)
    alloc = [[sum(1 for j in range(i, len(order), k) if order[j] == c) for c in range(len(classes))]
             for i in range(k)]
    out = [None] * len(labels)
    for c in range(len(classes)):
        seq = [f for f in range(k) for _ in range(alloc[f][c])]
        idx = [i for i, e in enumerate(enc) if e == c]
        for i, f in zip(idx, seq):
            out[i] = f
    return out


@pytest.mark.parametrize("seed,n,k", [(0, 97, 5), (1, 240, 5), (2, 31, 3)])
def test_matches_definition(spark, seed, n, k):
    rng = np.random.default_rng(seed)
    rows = [(f"K{int(rng.integers(0, 6))}", int(t), bool(rng.random() < 0.3), i)
            for i, t in enumerate(rng.integers(-50_000, 400_000, n))]
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[3]))
    want = reference_folds([r[2] for r in rows], k)
    df = spark.createDataFrame(rows, "pid string, time bigint, is_intoxicated boolean, rid int")
    got = {r.rid: r.fold for r in stratified_folds(df, time_col="time", tiebreak=("rid",), k=k,
                                                     bucket_s=40_000).collect()}
    assert [got[r[3]] for r in rows] == want


def test_null_labels_dropped(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 2, True), ("A", 3, False)],
                               "pid string, time bigint, is_intoxicated boolean")
    assert stratified_folds(df, time_col="time", k=2).count() == 2
