"""Rates of counters against a plain loop over the samples."""

import random

import pytest

from kinelab.operators import counters, opsmetrics

SCHEMA = "job string, instance string, code string, at_s long, value double"


def plain_rate(points, t, r):
    inside = [(a, v) for a, v in points if t - r < a <= t]
    if len(inside) < 2:
        return None
    lost = sum(v for (_, v), (_, w) in zip(inside, inside[1:]) if w < v)
    (t0, v0), (t1, v1) = inside[0], inside[-1]
    span = t1 - t0
    gap = span / (len(inside) - 1)
    increase = v1 - v0 + lost
    start, end = t0 - (t - r), t - t1
    start = gap / 2 if start >= gap * 1.1 else start
    if increase > 0 and v0 >= 0:
        start = min(start, span * v0 / increase)
    end = gap / 2 if end >= gap * 1.1 else end
    return increase * ((span + start + end) / span) / r


def series(rng, n, step, reset):
    out, at, value = [], rng.randint(0, 50), 0.0
    for _ in range(n):
        at += rng.choice([step, step, step + 3, 4 * step])
        value = 0.0 if rng.random() < reset else value + rng.choice([0, 0, 1, 7])
        out.append((at, value))
    return out


@pytest.mark.parametrize("r,step", [(60, 15), (60, 60), (100, 7), (30, 45)])
def test_rates_against_a_loop(spark, monkeypatch, r, step):
    monkeypatch.setattr(counters, "STRETCH_S", 200)  # many stretches
    rng = random.Random(r + step)
    all_series = {("j", str(i), code): series(rng, 120, 15, 0.1) for i in range(3) for code in ("200", "500", "2000")}
    df = spark.createDataFrame([(*k, a, v) for k, pts in all_series.items() for a, v in pts], SCHEMA)
    got = {(x["job"], x["instance"], x["code"], x["t_s"]): x["rate"] for x in counters.rates(df, r, step).collect()}
    want = {}
    for k, pts in all_series.items():
        for t in range(0, pts[-1][0] + r + step, step):
            rate = plain_rate(pts, t, r)
            if rate is not None:
                want[(*k, t)] = rate
    assert got.keys() == want.keys() and len(want) > 100 * (step < r)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    sums = {}
    for (job, instance, code, t), rate in want.items():
        if code != "200":
            sums[job, instance, t] = sums.get((job, instance, t), 0) + rate
    errors = {(x["job"], x["instance"], x["window_start_s"]): x["rate"] for x in counters.error_rates(df, r, step).collect()}
    assert errors.keys() == {k for k, v in sums.items() if v > 0}
    assert all(abs(errors[k] - sums[k]) < 1e-9 for k in errors)


def test_restart_between_two_samples(spark):
    df = spark.createDataFrame([("j", "0", "500", 0, 100.0), ("j", "0", "500", 30, 5.0), ("j", "0", "500", 60, 8.0)], SCHEMA)
    by_time = {x["t_s"]: x["rate"] for x in counters.rates(df, 61, 60).collect()}
    assert abs(by_time[60] - 8 * (61 / 60) / 61) < 1e-12  # 5 + 3, carried on over the second before the first sample
    lost = [x["lost"] for x in counters.restarts(df).orderBy("at_s").collect()]
    assert lost == [0.0, 100.0, 0.0]


def test_cases_without_a_rate(spark):
    df = spark.createDataFrame([("j", "0", "500", 10, 1.0), ("j", "1", "500", None, 1.0), ("j", "1", "500", 5, None), ("j", "1", "500", 6, float("nan")),
                                (None, "2", "500", 5, 1.0), (None, "2", "500", 9, 4.0), ("j", "3", "500", 5, 1.0), ("j", "3", "500", 5, 4.0)], SCHEMA)
    got = [tuple(x) for x in counters.rates(df, 60, 60).collect()]
    assert len(got) == 1 and got[0][:5] == (None, "2", "500", 60, 2)
    assert counters.rates(df.limit(0), 60, 15).count() == 0


def test_alert_over_counters(spark):
    """A counter that grows for a while: the condition holds from its first evaluation to its last."""
    pts = [(15 * i, float(min(max(i - 10, 0), 20))) for i in range(60)]
    df = spark.createDataFrame([("j", "0", "500", a, v) for a, v in pts], SCHEMA)
    found = counters.error_rates(df, 60, 15)
    times = sorted(x["window_start_s"] for x in found.collect())
    runs = opsmetrics.sustained(found, 15, 60).collect()
    assert [(x["start_s"], x["end_s"], x["n_windows"]) for x in runs] == [(times[0], times[-1] + 15, len(times))]
    assert times == list(range(165, 481, 15))  # the last rise, from 435 to 450, is in the ranges up to 480
