from kinelab.operators.windows import tumbling_mean
from kinelab.sources import tables as tb
from kinelab.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_stream_window_means_equal_batch_on_closed_windows(spark, scratch):
    root = scratch("st1")
    s = tb.sensor_from_events(jobs.table_stream(spark, SF, "events"))
    jobs.run_available(jobs.window_means(s, 86400, "0 seconds"), f"{root}/out", f"{root}/ck")
    streamed = {(r.pid, r.window_start_s): (r.x, r.y, r.z) for r in spark.read.parquet(f"{root}/out").collect()}
    batch = {(r.pid, r.window_start_s): (r.x, r.y, r.z)
             for r in tumbling_mean(tb.sensor_events(spark, SF), 86400).collect()}
    assert streamed and set(streamed) <= set(batch)
    last_day = max(k[1] for k in batch)
    assert {k for k in batch if k[1] < last_day} == set(streamed)
    for k, v in streamed.items():
        assert all(abs(a - b) < 1e-9 for a, b in zip(v, batch[k]))


def test_foreach_batch_is_idempotent(spark, scratch):
    root = scratch("fb")
    log = tb.scored_from_events(jobs.table_stream(spark, SF, "events"))
    write = jobs.batch_writer(f"{root}/out")
    jobs.run_foreach(log, write, f"{root}/ck")
    n = spark.read.parquet(f"{root}/out").count()
    # replaying batch 0 overwrites its folder instead of appending
    spark.read.parquet(f"{root}/out/batch_id=0").write.parquet(f"{root}/copy")
    write(spark.read.parquet(f"{root}/copy"), 0)
    assert spark.read.parquet(f"{root}/out").count() == n


def test_drift_state_over_many_batches_equals_batch(spark, scratch):
    from pyspark.sql import functions as F
    from kinelab.operators import drift
    src = scratch("ev_parts")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # several files, streamed one per trigger
    ev.repartitionByRange(4, "event_id").write.parquet(src)
    schema = ev.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    log = tb.scored_from_events(stream)
    counts = spark.createDataFrame([("is_intoxicated", "false", 10), ("is_intoxicated", "true", 3)],
                                   "target string, category string, cnt bigint")
    root = scratch("st4")
    jobs.run_foreach(log, jobs.drift_monitor(counts, f"{root}/log", f"{root}/psi"), f"{root}/ck")
    psi = spark.read.parquet(f"{root}/psi")
    assert psi.select("batch_id").distinct().count() >= 2
    last = psi.orderBy(F.col("batch_id").desc()).first().psi
    want = drift.psi(counts, drift.latest_n(tb.scored_log(spark, SF), 3)).first().psi
    assert abs(last - want) < 1e-12
    assert spark.read.parquet(f"{root}/log").count() == ev.count()


def test_parts_of_several_files_arrive_as_one_batch(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F
    from kinelab.streaming import catalog
    monkeypatch.setattr(catalog, "PART_FILE_ROWS", 40, raising=False)
    root = scratch("parts")
    (spark.range(600).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.when(F.col("id") < 3, 100_000).otherwise(F.col("id") * 37 % 600 * 60)).alias("ts"))
     .repartition(3).write.parquet(f"{root}/events.parquet"))
    stream, batches = catalog._events_in_parts(spark, root, f"{root}/in"), []
    jobs.run_foreach(stream, lambda b, i: batches.append(tuple(b.agg(F.count("ts"), F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first())), f"{root}/ck")
    assert len(batches) == 4 and sum(n for n, *_ in batches) == 600
    full = [(lo, hi) for n, lo, hi in batches if n]
    assert all(a[1] < b[0] for a, b in zip(full, full[1:]))
