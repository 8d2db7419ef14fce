import numpy as np
import pandas as pd
import pytest

from kinelab.operators.asof import asof_join

PLANS = ["broadcast", "union", "bucketed"]


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)
LEFT = "pid string, t bigint, x double"
RIGHT = "pid string, ts bigint, v double, tb bigint"


def run(spark, left, right, plan, bucket_s=100):
    if bucket_s is None and plan == "bucketed":
        bucket_s = 3600
    l = spark.createDataFrame(left, LEFT)
    r = spark.createDataFrame(right, RIGHT)
    out = asof_join(l, r, "pid", "t", "ts", ["v"], tiebreak="tb", plan=plan, bucket_s=bucket_s)
    return sorted(((row.pid, row.t, row.x, row.v) for row in out.collect()), key=_key)


@pytest.mark.parametrize("plan", PLANS)
def test_exact_time_match(spark, plan):
    left = [("A", 0, 1.0), ("A", 10, 2.0)]
    right = [("A", 0, 0.1, 0), ("A", 10, 0.02, 1)]
    assert [r[3] for r in run(spark, left, right, plan, bucket_s=5)] == [0.1, 0.02]


@pytest.mark.parametrize("plan", PLANS)
def test_unmatched_unknown_key_ties(spark, plan):
    left = [("A", 5, 1.0), ("A", 50, 2.0), ("B", 7, 3.0), ("C", 1, 4.0), (None, 9, 5.0)]
    right = [("A", 10, 0.5, 1), ("A", 10, 0.7, 2), ("A", 40, 0.9, 0), ("B", 8, 0.3, 0)]
    got = run(spark, left, right, plan, bucket_s=7)
    assert got == sorted([("A", 5, 1.0, None), ("A", 50, 2.0, 0.9), ("B", 7, 3.0, None),
                          ("C", 1, 4.0, None), (None, 9, 5.0, None)], key=_key)
    # ties: the larger tiebreak wins at equal (key, time)
    got = run(spark, [("A", 10, 0.0)], right, plan)
    assert got[0][3] == 0.7


def brute(left, right):
    r = pd.DataFrame(right, columns=["pid", "ts", "v", "tb"]).sort_values(["pid", "ts", "tb"])
    r = r.groupby(["pid", "ts"], as_index=False).last()
    out = []
    for pid, t, x in left:
        cand = r[(r.pid == pid) & (r.ts <= t)]
        out.append((pid, t, x, None if cand.empty else float(cand.sort_values("ts").iloc[-1].v)))
    return sorted(out, key=_key)


@pytest.mark.parametrize("plan", PLANS)
def test_random_against_brute_force(spark, plan):
    rng = np.random.default_rng(7)
    keys = ["K0", "K1", "K2", "HOT"]
    left = [(str(rng.choice(keys, p=[.1, .1, .1, .7])), int(rng.integers(-500, 3000)), float(i))
            for i in range(400)]
    right = [(str(rng.choice(keys[:2] + keys[3:])), int(rng.integers(-300, 2500)),
              float(rng.integers(0, 1000)) / 1000, int(rng.integers(0, 5))) for _ in range(150)]
    assert run(spark, left, right, plan, bucket_s=97) == brute(left, right)


def test_merge_asof_equality(spark):
    rng = np.random.default_rng(3)
    left = [("A", int(t), float(i)) for i, t in enumerate(sorted(rng.integers(0, 1000, 200)))]
    right = [("A", int(t), float(i), i) for i, t in enumerate(sorted(set(rng.integers(0, 1000, 60).tolist())))]
    lp = pd.DataFrame(left, columns=["pid", "t", "x"])
    rp = pd.DataFrame(right, columns=["pid", "ts", "v", "tb"])
    m = pd.merge_asof(lp, rp, left_on="t", right_on="ts", by="pid", direction="backward")
    want = sorted(((r.pid, r.t, r.x, None if pd.isna(r.v) else r.v) for r in m.itertuples()), key=_key)
    for plan in PLANS:
        assert run(spark, left, right, plan, bucket_s=50) == want


def test_auto_uses_broadcast_when_small(spark):
    from kinelab.operators.asof import choose_plan
    r = spark.createDataFrame([("A", 1, 0.1, 0)], RIGHT)
    assert choose_plan(r, "pid", "ts") == "broadcast"
    assert choose_plan(r, "pid", "ts", broadcast_max_rows=1) == "bucketed"


def test_broadcast_plan_keeps_left_unshuffled(spark):
    l = spark.createDataFrame([("A", 5, 1.0)], LEFT)
    r = spark.createDataFrame([("A", 1, 0.1, 0), ("A", 3, 0.1, 0)], RIGHT)  # an interval (one level) and an open end
    out = asof_join(l, r, "pid", "t", "ts", ["v"], tiebreak="tb", plan="broadcast")
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    left_scan = [i for i, ln in enumerate(lines) if "Scan ExistingRDD[pid" in ln and "t#" in ln]
    assert left_scan
    # ancestors of the left scan: no exchange between it and the root
    i = left_scan[0]
    depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    ancestors = []
    for ln in reversed(lines[:i]):
        d = len(ln) - len(ln.lstrip(" :+-"))
        if d < depth:
            ancestors.append(ln)
            depth = d
    assert not any("Exchange" in a for a in ancestors)
    assert sum("BroadcastHashJoin" in a for a in ancestors) == 3
    assert "SortMergeJoin" not in "\n".join(lines)


@pytest.mark.parametrize("plan", PLANS)
def test_hot_dense_key_and_sparse_keys(spark, plan):
    """One key holds most readings at high density; others are sparse."""
    rng = np.random.default_rng(11)
    right = [("HOT", int(t), float(i), i) for i, t in enumerate(rng.integers(0, 100_000, 3000))]
    right += [(f"S{j}", int(t), float(-j), 0) for j in range(5) for t in rng.integers(0, 100_000, 3)]
    left = [("HOT", int(t), float(i)) for i, t in enumerate(rng.integers(-10, 100_010, 500))]
    left += [(f"S{j}", int(t), 0.0) for j in range(6) for t in rng.integers(0, 100_000, 20)]
    assert run(spark, left, right, plan, bucket_s=None if plan != "union" else 100) == brute(left, right)


def test_labelled_windows_materializes_for_bucketed(spark):
    from kinelab.plans.labelling import labelled_windows
    from kinelab.sources import tables as tb
    sf = "/root/testdata/sf0.001"
    a = labelled_windows(tb.sensor_events(spark, sf), tb.readings_events(spark, sf), 86400, plan="broadcast")
    b = labelled_windows(tb.sensor_events(spark, sf), tb.readings_events(spark, sf), 86400, plan="bucketed",
                         bucket_s=3 * 86400, materialize=True)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


@pytest.mark.parametrize("plan", ["auto"] + PLANS)
def test_empty_readings_keep_all_windows(spark, plan):
    from kinelab.plans.labelling import labelled_windows
    from kinelab.sources.csv import empty_readings
    samples = spark.createDataFrame([("A", 0, 1.0, 2.0, 3.0), ("B", 15000, 1.0, 1.0, 1.0)],
                                    "pid string, time_ms bigint, x double, y double, z double")
    out = labelled_windows(samples, empty_readings(spark), 10, plan=plan,
                           bucket_s=None if plan in ("auto", "broadcast") else 100)
    rows = sorted((r.pid, r.time, r.TAC_Reading) for r in out.collect())
    assert rows == [("A", 0, None), ("B", 10, None)]


def test_forced_broadcast_over_bound_falls_back(spark, caplog):
    import logging
    l = spark.createDataFrame([("A", 5, 1.0), ("A", 50, 2.0)], LEFT)
    r = spark.createDataFrame([("A", t, float(t), 0) for t in range(0, 40, 4)], RIGHT)
    with caplog.at_level(logging.WARNING, logger="kinelab.operators.asof"):
        out = asof_join(l, r, "pid", "t", "ts", ["v"], tiebreak="tb", plan="broadcast",
                        broadcast_max_rows=8)
    assert any("bucketed plan" in rec.getMessage() for rec in caplog.records)
    assert sorted((row.t, row.v) for row in out.collect()) == [(5, 4.0), (50, 36.0)]


def test_broadcast_plan_reads_the_written_readings_and_only_levels_that_occur(spark):
    """A burst and a long gap: two levels, no aggregate or window left in the plan of the join."""
    from kinelab.operators.asof import asof_broadcast
    readings = spark.createDataFrame([("a", 10 * i, float(i)) for i in range(50)] + [("a", 10**8, 1.0)], "pid string, t long, v double")
    left = spark.createDataFrame([("a", 5), ("a", 495), ("a", 10**7), ("a", 10**8 + 1), ("b", 1), (None, 1)], "pid string, at long")
    out = asof_broadcast(left, readings, "pid", "at", "t", ["v"], min_bucket_s=10)
    assert sorted((r["pid"] or "", r["at"], r["v"]) for r in out.collect()) == [("", 1, None), ("a", 5, 0.0), ("a", 495, 49.0), ("a", 10**7, 49.0), ("a", 10**8 + 1, 1.0), ("b", 1, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") <= 4  # widths, two levels, open ends
