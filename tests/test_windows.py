import math

from pyspark.sql import types as T

from kinelab.operators.windows import tumbling_mean

SCHEMA = "pid string, time_ms bigint, x double, y double, z double"


def test_window_means_golden(spark):
    rows = [("A", t, 1.0 + i, 2.0 + i, 3.0 + i) for i, t in enumerate(range(0, 30000, 5000))]
    out = tumbling_mean(spark.createDataFrame(rows, SCHEMA), 10).orderBy("window_start_s").collect()
    assert [r.window_start_s for r in out] == [0, 10, 20]
    assert [r.x for r in out] == [1.5, 3.5, 5.5]
    assert [r.y for r in out] == [2.5, 4.5, 6.5]
    assert [r.z for r in out] == [3.5, 5.5, 7.5]


def test_empty_input_gives_no_windows(spark):
    assert tumbling_mean(spark.createDataFrame([], SCHEMA), 10).count() == 0


def test_null_key_dropped_nan_skipped_negative_floor(spark):
    rows = [(None, 0, 1.0, 1.0, 1.0), ("A", 0, float("nan"), 1.0, 1.0), ("A", 1000, 3.0, 1.0, 1.0),
            ("A", -1500, 5.0, 5.0, 5.0), ("A", None, 9.0, 9.0, 9.0)]
    out = {r.window_start_s: r for r in tumbling_mean(spark.createDataFrame(rows, SCHEMA), 10).collect()}
    assert set(out) == {0, -10}
    assert out[0].x == 3.0  # NaN skipped
    assert out[-10].x == 5.0  # floor, not truncation


def test_all_nan_window_is_null(spark):
    rows = [("A", 0, float("nan"), 1.0, 1.0)]
    r = tumbling_mean(spark.createDataFrame(rows, SCHEMA), 10).collect()[0]
    assert r.x is None and r.y == 1.0


def test_duplicates_kept(spark):
    rows = [("A", 0, 1.0, 1.0, 1.0), ("A", 0, 1.0, 1.0, 1.0), ("A", 0, 4.0, 1.0, 1.0)]
    r = tumbling_mean(spark.createDataFrame(rows, SCHEMA), 10).collect()[0]
    assert r.x == 2.0


def test_sort_and_union_aligned(spark):
    from kinelab.operators.windows import sort_readings, union_aligned
    a = spark.createDataFrame([("B", 2, 0.1), ("A", 5, 0.2), ("A", 1, 0.3)], "pid string, timestamp bigint, TAC_Reading double")
    assert [(r.pid, r.timestamp) for r in sort_readings(a).collect()] == [("A", 1), ("A", 5), ("B", 2)]
    b = spark.createDataFrame([("C", 3)], "pid string, timestamp bigint")
    u = union_aligned([a, b])
    assert u.count() == 4 and u.where("pid = 'C'").collect()[0].TAC_Reading is None
