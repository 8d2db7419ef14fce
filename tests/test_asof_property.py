"""Property test: every as-of plan equals a brute-force backward search."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kinelab.operators.asof import asof_join

KEYS = st.sampled_from(["A", "B", "C"])
LEFT = st.lists(st.tuples(KEYS, st.integers(-20, 200)), min_size=1, max_size=25)
RIGHT = st.lists(st.tuples(KEYS, st.integers(-20, 200), st.integers(0, 3)), max_size=25)


def brute(left, right):
    best = {}
    for k, t, tb in right:  # dedupe equal (key, time): the largest tiebreak wins
        if (k, t) not in best or tb > best[(k, t)]:
            best[(k, t)] = tb
    out = []
    for i, (k, t) in enumerate(left):
        cands = [rt for (rk, rt) in best if rk == k and rt <= t]
        out.append((i, None if not cands else float(max(cands) * 10 + best[(k, max(cands))])))
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=LEFT, right=RIGHT, bucket=st.sampled_from([7, 50, 1000]))
def test_plans_equal_brute_force(spark, left, right, bucket):
    l = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(left)], "i int, pid string, t bigint")
    r = spark.createDataFrame([(k, t, float(t * 10 + tb), tb) for k, t, tb in right],
                              "pid string, ts bigint, v double, tb int")
    want = brute(left, right)
    for plan in ("broadcast", "union", "bucketed"):
        b = None if plan == "broadcast" and bucket == 1000 else bucket
        out = asof_join(l, r, "pid", "t", "ts", ["v"], tiebreak="tb", plan=plan, bucket_s=b)
        assert sorted((row.i, row.v) for row in out.collect()) == want, plan
