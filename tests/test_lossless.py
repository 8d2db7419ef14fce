"""Inputs that used to be dropped, merged or changed without an error: values, not just schemas."""

import pytest
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.functions import json_field
from kinelab.operators import asof, drift, features, folds, model, registry
from kinelab.operators.windows import tumbling_mean
from kinelab.sources import csv
from kinelab.sources import tables as tb
from kinelab.streaming import jobs

SMOKE = "/root/testdata/sf0.001"


def text_file(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.mode("append").text(path)


def rename_to_csv(spark, folder):
    """Spark writes .txt parts; the readers look for .csv."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith(".txt"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(p, name.replace(".txt", ".csv")))


def test_sensor_columns_are_bound_by_name(spark, scratch):
    path = scratch("sensor")
    text_file(spark, path, ["time,pid,x,y,z", "1000,A,1.0,2.0,3.0", "2000,A,3.0,,5.0"])
    text_file(spark, path, ["z,extra,pid,x,time,y\r", '7.0,"q,r",B,5.0,1e4,6.0\r', "7.0,q,B,5.0,never,6.0\r"])
    rename_to_csv(spark, path)
    parsed = csv.parse_sensor_csv(spark, path)
    rows = sorted((r["pid"], r["time_ms"], r["x"], r["y"], r["z"]) for r in parsed.rows.collect())
    assert rows == [("A", 1000, 1.0, 2.0, 3.0), ("A", 2000, 3.0, None, 5.0), ("B", 10000, 5.0, 6.0, 7.0)]
    assert [r["line"].strip() for r in parsed.rejected.collect()] == ["7.0,q,B,5.0,never,6.0"]
    assert tumbling_mean(parsed.rows, 10).count() == 2


def test_readings_numeric_text_and_rejects(spark, scratch):
    path = scratch("AB1234_clean_TAC.csv")
    text_file(spark, path, ["timestamp,TAC_Reading", "1.0,0.5", "bad,0.6", "3,0.7"])
    rename_to_csv(spark, path)
    parsed = csv.parse_readings_folder(spark, path, key_from="parent_dir")
    assert sorted(map(tuple, parsed.rows.collect())) == [(1, 0.5, "AB1234"), (3, 0.7, "AB1234")]
    assert [r["line"] for r in parsed.rejected.collect()] == ["bad,0.6"]
    assert csv.read_readings_folder(spark, path).count() == 0  # the file names carry no key
    assert csv.read_readings_folder(spark, scratch("absent")).columns == ["timestamp", "TAC_Reading", "pid"]


def test_every_request_gets_a_prediction(spark):
    train = spark.createDataFrame([(float(i), float(i), 0.0, 0.0, i < 20) for i in range(40)], "time double, x double, y double, z double, is_intoxicated boolean")
    forest = model.fit_forest(model.training_frame(features.with_energy_magnitude(train)), num_trees=3, max_depth=2)
    lines = spark.createDataFrame([(f'{{"time": {1000 * i}, "y": 0.0, "z": 0.0' + (f', "x": {i}.0' if i % 4 else "") + "}",) for i in range(40)] + [("no json",)], "value string")
    from kinelab.sources.telemetry import parse_requests
    feats = features.scoring_features(parse_requests(lines))
    out = model.predict(forest, feats, keep=["time"])
    assert out.count() == 41 and out.where("prediction in (0, 1)").count() == 41
    assert out.agg(F.max("time")).first()[0] == 39.0  # seconds, as in training
    assert jobs.scoring(lines, forest).count() == 41
    absent = features.scoring_features(spark.createDataFrame([(5000, 1.0)], "time long, x double"))
    assert model.predict(forest, absent).count() == 1


def test_folds_keep_rows_without_key_or_time(spark):
    rows = [(None if i == 3 else f"k{i % 4}", None if i == 9 else i, i, i % 3 == 0) for i in range(21)]
    df = spark.createDataFrame(rows, "pid string, time long, id long, is_intoxicated boolean")
    out = folds.stratified_folds(df, tiebreak=("id",)).collect()
    assert sorted(r["id"] for r in out) == list(range(21))
    for label in (True, False):
        sizes = [sum(r["fold"] == f for r in out if r["is_intoxicated"] == label) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_stream_over_a_table_folder(spark, scratch):
    root = scratch("stream")
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    events.repartition(4).write.parquet(f"{root}/events.parquet")
    jobs.run_available(jobs.table_stream(spark, root, "events"), f"{root}/out", f"{root}/ck")
    assert spark.read.parquet(f"{root}/out").count() == events.count() > 0


def test_flushed_windows_complete_the_stream(spark, scratch):
    root = scratch("flush")
    batch = tb.sensor_events(spark, SMOKE)
    s = tb.sensor_from_events(jobs.table_stream(spark, SMOKE, "events"))
    assert jobs.run_available(jobs.window_means(s, 86_400, "3600 seconds"), f"{root}/out", f"{root}/ck") == 0
    rest = jobs.window_means(jobs.open_rows(batch, 86_400, 3_600), 86_400, "3600 seconds")
    got = spark.read.parquet(f"{root}/out").unionByName(rest)
    key = lambda df: sorted((r["pid"], r["window_start_s"], round(r["x"], 9)) for r in df.collect())
    assert key(got) == key(tumbling_mean(batch, 86_400)) and rest.count() > 0


@pytest.mark.parametrize("plan", ["broadcast", "union", "bucketed"])
def test_fractional_reading_times(spark, plan):
    left = spark.createDataFrame([("a", 10), ("a", 11)], "pid string, t long")
    right = spark.createDataFrame([("a", 9.25, 0.1), ("a", 10.5, 0.5)], "pid string, ts double, v double")
    out = {r["t"]: r["v"] for r in asof.asof_join(left, right, "pid", "t", "ts", ["v"], plan=plan).collect()}
    assert out == {10: 0.1, 11: 0.5}


@pytest.mark.parametrize("plan", ["broadcast", "bucketed"])
def test_bursts_with_long_gaps(spark, plan):
    """Eight readings a minute apart, then days: intervals of every length."""
    times = [d * 400_000 + m * 60 for d in range(40) for m in range(8)] + [10 ** 9]
    right = spark.createDataFrame([("a", t, float(t)) for t in times], "pid string, ts long, v double")
    left = spark.createDataFrame([("a", t) for t in range(-5, 40 * 400_000, 9_973)] + [("a", 10 ** 9 - 1), ("a", 2 * 10 ** 9), ("b", 5)], "pid string, t long")
    out = asof.asof_join(left, right, "pid", "t", "ts", ["v"], plan=plan).collect()
    assert len(out) == left.count()
    for r in out:
        before = [t for t in times if t <= r["t"]] if r["pid"] == "a" else []
        assert r["v"] == (float(max(before)) if before else None)


def test_values_of_a_tie_come_from_one_row(spark):
    right = spark.createDataFrame([("a", 1, 7, 1.0, 9.0), ("a", 1, 7, 2.0, 3.0)], "pid string, ts long, tb long, v double, w double")
    left = spark.createDataFrame([("a", 5)], "pid string, t long")
    r = asof.asof_join(left, right, "pid", "t", "ts", ["v", "w"], tiebreak="tb").first()
    assert (r["v"], r["w"]) == (2.0, 3.0)


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.createDataFrame([("a", i, "x" * 1000) for i in range(50)], "pid string, ts long, v string")
    stats = asof.reading_stats(wide, "pid", "ts", ["v"])
    assert stats["bytes"] > 50 * 1000
    assert asof.choose_plan(wide, "pid", "ts", stats=stats) == "broadcast"
    assert asof.choose_plan(wide, "pid", "ts", stats=stats | {"bytes": C.ASOF_BROADCAST_MAX_BYTES}) == "bucketed"


def test_one_new_run_per_absent_name(spark):
    reg = spark.createDataFrame([("r1", "a", None)], "run_id string, run_name string, end_time timestamp")
    wanted = spark.createDataFrame([("a",), ("b",), ("b",)], "run_name string")
    assert [r["run_name"] for r in registry.create_if_absent(reg, wanted).collect()] == ["b"]


def test_malformed_json_and_empty_reference(spark):
    df = spark.createDataFrame([('{"k": 1.5}',), ('{"k": "x"}',), ("{",)], "props string")
    assert [r[0] for r in df.select(json_field("props", "k")).collect()] == [1.5, None, None]
    log = spark.createDataFrame([(i, True, i) for i in range(5)], "timestamp long, is_intoxicated boolean, event_id long")
    assert drift.psi(drift.class_counts(log.limit(0)), drift.latest_n(log, 3)).count() == 0


def test_newest_version_of_a_complete_mode_sink(spark, scratch):
    path = scratch("versions")
    write = jobs.version_writer(path)
    for n in (3, 12):
        write(spark.range(n), n)
    assert jobs.newest_version(spark, path).count() == 12


def test_shared_folder_is_required_off_local(monkeypatch):
    from kinelab import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError):
        session.checkpoint_root(Session())
