"""Operator 11 against shifted comparison at every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import kinelab.llm.periodic as m
from kinelab.llm.periodic import collapse, find_runs, periodic_runs, run_digests, with_planted_tails
from kinelab.llm.queries import op11_periodic_runs

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every period by comparing the words with themselves, each stretch checked for smaller periods."""
    w = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        equal = np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]])
        for a, b in zip(np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)):
            end = b + q
            if end - a >= max(6, 4 * q) and not any((w[a:end - p] == w[a + p:end]).all() for p in range(1, q)):
                out.append((int(a), int(end - a), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.3:
            out += [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 30))]
        elif kind < 0.4:
            a, b = [0], [0, 1]
            for _ in range(rng.randint(1, 9)):
                a, b = b, b + a
            out += b
        elif kind < 0.5:
            out += [bin(i).count("1") % 2 for i in range(rng.randint(1, 128))]  # Thue-Morse
        else:
            base = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randint(1, 40))]
            piece = (base * 7)[:int(len(base) * rng.uniform(2, 6.5))]
            if rng.random() < 0.3:
                piece[rng.randrange(len(piece))] = 99
            out += piece
    return out[:n]


def test_runs_of_repetitive_texts():
    rng, total = random.Random(5), 0
    for _ in range(260):
        texts = [repetitive(rng, rng.randint(0, 600)) for _ in range(rng.randint(1, 6))]
        for text, got in zip(texts, find_runs([np.array(t, np.int64) for t in texts])):
            total += len(got)
            assert got == plain_runs(text)
    assert total > 1000


@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=4))
@settings(max_examples=150, deadline=None)
def test_runs_of_small_alphabets(texts):
    assert find_runs([np.array(t, np.int64) for t in texts]) == [plain_runs(t) for t in texts]


def test_colliding_hashes_do_not_change_runs(monkeypatch):
    mix, calls = m.mix, []

    def poor(x):  # few values for the first seeds
        calls.append(1)
        return mix(x) % np.uint64(3) if len(calls) < 40 else mix(x)

    monkeypatch.setattr(m, "mix", poor)
    rng = random.Random(8)
    text = repetitive(rng, 500)
    assert find_runs([np.array(text, np.int64)]) == [plain_runs(text)]
    assert len(calls) >= 40


def test_long_period_and_batches(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(900)}" for _ in range(1500)]
    long = " ".join(base * 5 + ["end"])
    rows = spark.createDataFrame([(1, long), (2, "a " * 7), (3, None), (4, " \t\n")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs(rows).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 7500, 1500)] and got[1]["collapsed"] == " ".join([*base, "end"])
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 7, 1)] and got[2]["collapsed"] == "a"
    assert got[3]["runs"] == got[4]["runs"] == [] and got[3]["collapsed"] == got[4]["collapsed"] == ""
    assert got[3]["n_words"] == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    milli = best[1] * 1000 // best[2] if runs else None
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(words) if i not in drop)))


def test_query_against_brute_force(spark):
    got = sorted(tuple(r) for r in op11_periodic_runs(spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(expected(*r) for r in docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_defined_cases(spark):
    schema = "doc_id long, text string, runs int, n_words string, _words int, _h int, source string, label int"
    hit = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    texts = [(None, "x y x y x y x y"), (None, None), (5, ""), (hit, "one two three four five six seven eight nine"), (hit, None), (hit, " \n"),
             (7, "a b c d"), (7, "a b c d"), (8, "ü \U0001f600 " * 9), (9, "a\x1fb " * 9)]
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3, "s", 4) for i, t in texts], schema)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in run_digests(periodic_runs(with_planted_tails(docs))).collect()), key=key) == sorted((expected(*r) for r in texts), key=key)
    assert periodic_runs(docs.limit(0)).count() == 0 and run_digests(periodic_runs(with_planted_tails(docs.limit(0)))).count() == 0


def test_collapse_keeps_the_first_period():
    assert collapse(list("xabababab"), [(1, 8, 2)]) == ["x", "a", "b"]
