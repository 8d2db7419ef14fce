"""Alerts and newest rows in keyed state, over several batches, against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kinelab.operators import drift, opsmetrics
from kinelab.streaming import jobs
from kinelab.streaming.alerts import CHANGES, alert_changes
from kinelab.streaming.newest import keep_newest, newest

BASE = dt.datetime(2024, 1, 1)
HTTP = "ts timestamp, code string, job string, instance string"
LOG = "timestamp long, is_intoxicated boolean, event_id long, ts timestamp"


def files(spark, path, parts, schema):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_alerts_fire_and_resolve(spark, scratch):
    rng, root = random.Random(5), scratch("alerts")
    rows = []
    for instance in ("0", "1", None):
        t = 0
        while t < 6000:
            errors = rng.random() < 0.6
            for _ in range(rng.randint(1, 6)):
                rows += [(BASE + dt.timedelta(seconds=t + rng.randint(0, 59)), "500" if errors else "200", "j", instance)]
                t += 60 if errors else rng.choice([0, 60, 180])
    rows = sorted({r for r in rows}, key=lambda r: (r[0], str(r)))
    cuts = [rows[len(rows) * i // 5:len(rows) * (i + 1) // 5] for i in range(5)]
    quiet = [(BASE + dt.timedelta(seconds=20_000), "200", "j", "9")]
    stream = files(spark, f"{root}/in", [*cuts, quiet], HTTP)
    with jobs.keyed_state(spark):
        assert jobs.run_available(alert_changes(stream, 60, 120, "60 seconds"), f"{root}/out", f"{root}/ck") == 0
    out = spark.read.schema(CHANGES).parquet(f"{root}/out")
    got = sorted(map(tuple, out.where("state = 'resolved'").select("job", "instance", "start_s", "end_s", "n_windows", "at_s").collect()), key=str)
    batch = opsmetrics.sustained(opsmetrics.error_rate(spark.createDataFrame(rows, HTTP), 60), 60, 120)
    want = sorted(((*map(lambda c: r[c], ("job", "instance", "start_s", "end_s", "n_windows")), r["end_s"]) for r in batch.collect()), key=str)
    assert got == want and len(want) > 10
    fired = sorted(map(tuple, out.where("state = 'firing'").select("job", "instance", "start_s", "at_s", "n_windows").collect()), key=str)
    assert fired == sorted(((j, i, s, s + 180, 3) for j, i, s, *_ in want), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_newest_rows_after_any_split(spark, scratch, seed):
    rng, root = random.Random(seed), scratch("newest")
    rows = [(rng.randint(0, 40), rng.choice([True, False, None]), i + 2**60, BASE) for i in range(200)]  # ids beyond doubles
    order = rng.sample(rows, len(rows))  # late rows
    cuts = sorted(rng.sample(range(1, 200), 3))
    parts = [order[a:b] for a, b in zip([0, *cuts], [*cuts, 200])]
    parts.insert(2, parts[0])  # a batch that comes again
    parts.append([(None, True, 5, BASE), (50, True, None, BASE)])
    stream = files(spark, f"{root}/in", parts, LOG)
    with jobs.keyed_state(spark):
        jobs.run_available(keep_newest(stream, 5, buckets=3), f"{root}/none", f"{root}/ck", mode="update", fmt="noop")
    want = drift.latest_n(spark.createDataFrame(rows, LOG), 5).select("timestamp", "is_intoxicated", "event_id").collect()
    assert sorted(map(tuple, newest(spark, f"{root}/ck", 5).collect()), key=str) == sorted(map(tuple, want), key=str)
    assert newest(spark, f"{root}/ck", 300).count() == 0  # fewer than asked for
    state = spark.read.format("statestore").option("path", f"{root}/ck").option("stateVarName", "latest").load()
    assert state.groupBy("key").count().agg(F.max("count")).first()[0] <= 5


def test_the_stream_goes_on_from_its_state(spark, scratch):
    root = scratch("restart")
    parts = [[(i, i % 2 == 0, i, BASE) for i in range(20)], [(i, True, i, BASE) for i in range(20, 24)]]
    for k, part in enumerate(parts):
        stream = files(spark, f"{root}/in", [part], LOG)
        with jobs.keyed_state(spark):
            jobs.run_available(keep_newest(stream, 3), f"{root}/none", f"{root}/ck", mode="update", fmt="noop")
        got = sorted(r["event_id"] for r in newest(spark, f"{root}/ck", 3).collect())
        assert got == ([17, 18, 19], [21, 22, 23])[k]


WINDOWS = "pid string, window_start_s long, x double, y double, z double"
READINGS = "pid string, timestamp long, TAC_Reading double, tiebreak long"


def versions_of(spark, root, window_parts, reading_parts, keep_s):
    from kinelab.streaming.late_asof import label_versions
    w, r = files(spark, f"{root}/w", window_parts, WINDOWS), files(spark, f"{root}/r", reading_parts, READINGS)
    with jobs.keyed_state(spark):
        versions = label_versions(w, r, keep_s)
        jobs.run_available(versions, f"{root}/out", f"{root}/ck")
    return spark.read.schema(versions.schema).parquet(f"{root}/out")


@pytest.mark.parametrize("seed", [3, 4])
def test_late_readings_correct_their_windows(spark, scratch, seed):
    from kinelab.operators.asof import asof_join
    from kinelab.streaming.late_asof import newest_labels
    rng = random.Random(seed)
    windows = [(p, 10 * i, rng.choice([1.0, None]), float(i), 0.5) for p in ("a", "b", "c") for i in range(40) if rng.random() < 0.8]
    readings = [(p, rng.randint(0, 400), rng.choice([0.1, 0.2, 0.3, None]), rng.choice([k, 7, None])) for p in ("a", "b", "d") for k in range(30)]
    rng.shuffle(windows)
    rng.shuffle(readings)
    odd = [(None, 5, 1.0, 1.0, 1.0), ("a", None, 1.0, 1.0, 1.0)]
    cut = lambda xs: [xs[:len(xs) // 3], xs[len(xs) // 3:len(xs) // 2], xs[len(xs) // 2:]]
    out = versions_of(spark, scratch("late"), cut(windows + odd), [*cut(readings), [(None, 3, 0.9, 1), ("a", None, 0.9, 1)]], 10**6)
    got = sorted(map(tuple, newest_labels(out).collect()), key=str)
    best = {}
    for p, t, v, tie in readings:  # the rule for equal times, in plain words: largest tie-break, then value
        rank = (tie is not None, tie or 0, v is not None, v or 0.0)
        if (p, t) not in best or rank > best[p, t][0]:
            best[p, t] = (rank, v)
    reduced = spark.createDataFrame([(p, t, v) for (p, t), (_, v) in best.items()], "pid string, timestamp long, TAC_Reading double")
    batch = asof_join(spark.createDataFrame(windows, WINDOWS), reduced, "pid", "window_start_s", "timestamp", ["TAC_Reading"], tiebreak=None)
    assert got == sorted(map(tuple, batch.select("pid", "window_start_s", "x", "y", "z", "TAC_Reading").collect()), key=str)
    assert out.where("version > 0").count() > 10
    per_window = out.groupBy("pid", "window_start_s").agg(F.count("*").alias("n"), F.max("version").alias("v")).collect()
    assert all(r["n"] == r["v"] + 1 for r in per_window)


def test_what_is_too_old_is_forgotten(spark, scratch):
    windows = [[("a", 0, 1.0, 1.0, 1.0)], [("a", 1000, 1.0, 1.0, 1.0)], [("a", 2000, 1.0, 1.0, 1.0)]]
    readings = [[("a", 900, 0.1, 1)], [("a", 1990, 0.2, 1)], [("b", 1, 0.5, 1)], [("a", 0, 0.9, 1), ("a", 1995, 0.3, 1)]]
    out = versions_of(spark, scratch("old"), windows, readings, 500)
    got = sorted((r["window_start_s"], r["version"], r["TAC_Reading"]) for r in out.collect())
    assert got == [(0, 0, None), (1000, 0, 0.1), (2000, 0, 0.2), (2000, 1, 0.3)]


def test_keys_of_a_bucket_stay_apart_over_segments(spark, scratch):
    """Many keys in few buckets, readings of one time whose tie-breaks only whole numbers tell apart, times far apart."""
    from kinelab.streaming.late_asof import SEGMENT_S, label_versions, newest_labels
    far, big = 3 * SEGMENT_S, 2**60
    keys = [f"p{i}" for i in range(20)]
    windows = [[(p, far * j + 10 * i, float(i), None, 1.0) for i, p in enumerate(keys)] for j in range(3)]
    readings = [[(p, far + 5, 0.5, 1) for p in keys[::2]], [(p, t, 0.1 + i % 3, big + k) for i, p in enumerate(keys) for k, t in enumerate((3, 3, far + 5))],
                [(p, 3, 0.01, big + 2) for p in keys[:5]] + [(p, 2 * far, 0.7, None) for p in keys[5:7]]]
    out = {}
    for buckets in (2, 64):
        root = scratch("buckets")
        w, r = files(spark, f"{root}/w", windows, WINDOWS), files(spark, f"{root}/r", readings, READINGS)
        with jobs.keyed_state(spark):
            versions = label_versions(w, r, 10**9, buckets=buckets)
            jobs.run_available(versions, f"{root}/out", f"{root}/ck")
        out[buckets] = spark.read.schema(versions.schema).parquet(f"{root}/out")
    rows = {b: sorted(map(tuple, df.collect()), key=str) for b, df in out.items()}
    assert rows[2] == rows[64]
    best = {}
    for p, t, v, tie in sum(readings, []):
        if (p, t) not in best or (tie or 0) > best[p, t][0]:
            best[p, t] = (tie or 0, v)
    want = []
    for p, at, x, y, z in sum(windows, []):
        times = [t for q, t in best if q == p and t <= at]
        want.append((p, at, x, y, z, best[p, max(times)][1] if times else None))
    assert sorted(map(tuple, newest_labels(out[2]).collect()), key=str) == sorted(want, key=str)
    assert out[2].where("version > 0").count() > 0
