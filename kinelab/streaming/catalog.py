"""Registered streaming queries: each drains its stream with ``availableNow``
into the shared checkpoint folder and returns the sink table.

Append-mode windows are emitted once the watermark (max event time minus
the delay) reaches the window end; the windows still open at the end of the
input are flushed as a batch, so the results hold every window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.operators import drift, opsmetrics
from kinelab.plans import catalog as cat
from kinelab.session import scratch_path
from kinelab.sources import tables as tb
from kinelab.sources.telemetry import requests_as_json
from kinelab.streaming import compaction, jobs
from kinelab.streaming.alerts import CHANGES, alert_changes
from kinelab.streaming.late_asof import label_versions, newest_labels
from kinelab.streaming.newest import keep_newest, newest

DELAY_S = 3_600
DELAY = f"{DELAY_S} seconds"


def _events_stream(spark, d):
    return jobs.table_stream(spark, d, "events")


def q_st1_window_mean(spark, d):
    root = scratch_path(spark, "st1")
    s = tb.sensor_from_events(_events_stream(spark, d))
    jobs.run_available(jobs.window_means(s, cat.DAY, DELAY), f"{root}/out", f"{root}/ck")
    rest = jobs.open_rows(tb.sensor_events(spark, d), cat.DAY, DELAY_S)
    jobs.window_means(rest, cat.DAY, DELAY).write.mode("append").parquet(f"{root}/out_flush")
    return cat._windows_out(spark.read.parquet(f"{root}/out").unionByName(spark.read.parquet(f"{root}/out_flush")))


def q_st1_folder_table(spark, d):
    """ST1 over the usual layout: a table folder of several part files."""
    root = scratch_path(spark, "st1-table")
    tb.table(spark, d, "events").repartition(5).write.parquet(f"{root}/events.parquet")
    return q_st1_window_mean(spark, root)


def q_st1_compacted_sink(spark, d):
    """ST1 over many batches into a sink whose batch folders are folded as it goes."""
    root = scratch_path(spark, "st1c")
    stream = _events_in_parts(spark, d, f"{root}/events", parts=6)
    _quiet_end(spark, stream, f"{root}/events", DELAY_S + 2 * cat.DAY)
    means = jobs.window_means(tb.sensor_from_events(stream), cat.DAY, DELAY)
    jobs.run_foreach(means, compaction.compacting_writer(f"{root}/out", fan=2, grace_s=0), f"{root}/ck")
    return cat._windows_out(compaction.read_batches(spark, f"{root}/out", means.schema))


def q_st2_stream_asof(spark, d):
    root = scratch_path(spark, "st2")
    s = tb.sensor_from_events(_events_stream(spark, d))
    label = jobs.asof_labeller(tb.readings_events(spark, d), f"{root}/out")
    jobs.run_foreach(jobs.window_means(s, cat.DAY, DELAY), label, f"{root}/ck")
    label(jobs.window_means(jobs.open_rows(tb.sensor_events(spark, d), cat.DAY, DELAY_S), cat.DAY, DELAY), "flush")
    return cat._asof_out(spark.read.parquet(f"{root}/out").drop("batch_id"))


def q_st4_stream_drift(spark, d):
    root = scratch_path(spark, "st4")
    log = tb.scored_from_events(_events_stream(spark, d))
    ref = cat._reference_counts(spark, d)
    jobs.run_foreach(log, jobs.drift_monitor(ref, f"{root}/log", f"{root}/psi"), f"{root}/ck")
    psi = spark.read.parquet(f"{root}/psi")
    last = psi.agg(F.max("batch_id").alias("batch_id"))
    return psi.join(F.broadcast(last), "batch_id").select("target", cat.r6("psi").alias("psi"))


def _newest_state(spark, d, name: str) -> DataFrame:
    """The newest rows in the state of a stream of the log: four files in time order, then an early one again."""
    root = scratch_path(spark, name)
    stream = _events_in_parts(spark, d, f"{root}/events")
    tb.table(spark, d, "events").where(F.col("event_id") % 3 == 0).write.mode("append").parquet(f"{root}/events")
    with jobs.keyed_state(spark):
        jobs.run_available(keep_newest(tb.scored_from_events(stream)), f"{root}/none", f"{root}/ck", mode="update", fmt="noop")
    return newest(spark, f"{root}/ck")


def q_st4_state_latest(spark, d):
    """T3 from the state store."""
    return _newest_state(spark, d, "st4l").select("timestamp", C.LABEL, "event_id")


def q_st4_state_drift(spark, d):
    """PSI of the newest rows in the state store against the reference counts."""
    latest = _newest_state(spark, d, "st4p")
    return drift.psi(cat._reference_counts(spark, d), latest).select("target", cat.r6("psi").alias("psi"))


def q_st5_stream_pred_counts(spark, d):
    root = scratch_path(spark, "st5")
    log = tb.scored_from_events(_events_stream(spark, d))
    jobs.run_foreach(jobs.prediction_counter(log), jobs.version_writer(f"{root}/out"),
                     f"{root}/ck", mode="complete")
    return jobs.newest_version(spark, f"{root}/out")


def q_st5_stream_latency_histogram(spark, d):
    """The cumulative latency buckets, kept up to date by a stream."""
    root = scratch_path(spark, "st5h")
    log = tb.scored_from_events(_events_stream(spark, d))
    jobs.run_foreach(opsmetrics.latency_histogram(log), jobs.version_writer(f"{root}/out"),
                     f"{root}/ck", mode="complete")
    return jobs.newest_version(spark, f"{root}/out")


def q_st6_stream_error_rate(spark, d):
    root = scratch_path(spark, "st6")
    http = tb.http_from_events(_events_stream(spark, d))
    jobs.run_available(jobs.error_windows(http, cat.HOUR, DELAY), f"{root}/out", f"{root}/ck")
    rest = jobs.open_rows(tb.http_log(spark, d), cat.HOUR, DELAY_S)
    out = spark.read.parquet(f"{root}/out").unionByName(jobs.error_windows(rest, cat.HOUR, DELAY))
    return out.select("job", "instance", "window_start_s", "errors", cat.r6("rate").alias("rate"))


#: Rows of one file of a part.
PART_FILE_ROWS = 1_000_000


def _events_in_parts(spark, d, path: str, parts: int = 4, backwards: bool = False) -> DataFrame:
    """The events as parts that arrive one after another in time order (or the newest first), and a stream of them, one part per batch.

    Each part is the same number of files, so that a batch is a part however large it is: files of one part
    have rows of its whole time, and would come too late after one another.
    """
    ev = tb.table(spark, d, "events")
    lo, hi, rows = ev.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp"))),
                          F.count(F.lit(1))).first()
    part = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(lo or 0)) * parts / F.lit((hi or 0) - (lo or 0) + 1)), F.lit(parts - 1))
    files = max(1, -(-rows // (parts * PART_FILE_ROWS)))
    for k, i in enumerate(reversed(range(parts)) if backwards else range(parts), 1):
        ev.where(part == i).repartition(files).write.mode("append").parquet(path)
        for _ in range(len(spark.read.schema(ev.schema).parquet(path).inputFiles()), k * files):  # a part of few rows has empty files
            ev.limit(0).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files).parquet(path)


def _quiet_end(spark, stream: DataFrame, path: str, after_s: int) -> None:
    """A last file with one event of another user, no error and no reading, ``after_s`` after all others: it closes all windows but its own."""
    fixed = {"event_type": "quiet", "user_id": -1}
    ev = spark.read.schema(stream.schema).parquet(path)
    quiet = ev.agg((F.max("ts") + F.expr(f"INTERVAL {after_s} SECONDS")).alias("ts")).where("ts is not null")
    (quiet.select(*[F.col("ts").cast(f.dataType) if f.name == "ts" else F.lit(fixed.get(f.name)).cast(f.dataType).alias(f.name)
                    for f in stream.schema.fields]).write.mode("append").parquet(path))


def q_st2_late_readings(spark, d):
    """Windows in time order, readings the newest first: most windows are labelled before their reading comes, and corrected."""
    root = scratch_path(spark, "st2l")
    stream = _events_in_parts(spark, d, f"{root}/events")
    _quiet_end(spark, stream, f"{root}/events", DELAY_S + 2 * cat.DAY)
    late = _events_in_parts(spark, d, f"{root}/readings", backwards=True)
    windows = jobs.window_means(tb.sensor_from_events(stream), cat.DAY, DELAY)
    with jobs.keyed_state(spark):
        versions = label_versions(windows, tb.readings_from_events(late), keep_s=3_650 * cat.DAY)
        jobs.run_available(versions, f"{root}/out", f"{root}/ck")
    return cat._asof_out(newest_labels(spark.read.schema(versions.schema).parquet(f"{root}/out")))


def q_a13_stream_alert(spark, d):
    """Firing and resolved alerts of the streamed HTTP log."""
    root = scratch_path(spark, "a13")
    stream = _events_in_parts(spark, d, f"{root}/events")
    _quiet_end(spark, stream, f"{root}/events", DELAY_S + 4 * cat.HOUR)
    with jobs.keyed_state(spark):
        jobs.run_available(alert_changes(tb.http_from_events(stream), cat.HOUR, cat.HOUR, DELAY), f"{root}/out", f"{root}/ck")
    return spark.read.schema(CHANGES).parquet(f"{root}/out")


def q_st3_stream_scoring(spark, d):
    """Requests written as JSON lines, streamed, scored with the fitted forest."""
    from kinelab.plans.ml_catalog import fitted_model
    root = scratch_path(spark, "st3")
    s = tb.sensor_events(spark, d)
    req = s.select(F.col(C.TIME_MS).alias("time"), "x", "y", "z",
                   F.lit(0.0).alias("energy"), F.lit(0.0).alias("magnitude"))
    requests_as_json(req).write.mode("overwrite").text(f"{root}/requests")
    stream = spark.readStream.text(f"{root}/requests")
    jobs.run_available(jobs.scoring(stream, fitted_model(spark, d)), f"{root}/out", f"{root}/ck")
    return spark.read.parquet(f"{root}/out")


def q_st3_stream_equals_batch(spark, d):
    """The streamed predictions against those of the batch: one per request, none different."""
    from kinelab.operators import features, model
    from kinelab.plans.ml_catalog import SMALL, _gappy_requests, fitted_model
    from kinelab.sources.telemetry import parse_requests
    root = scratch_path(spark, "st3b")
    _gappy_requests(spark, d).write.mode("overwrite").text(f"{root}/requests")
    forest = fitted_model(spark, d, **SMALL)
    jobs.run_available(jobs.scoring(spark.readStream.text(f"{root}/requests"), forest), f"{root}/out", f"{root}/ck")
    batch = model.predict(forest, features.scoring_features(parse_requests(spark.read.text(f"{root}/requests"))), keep=["time"])
    count = lambda df: df.groupBy("time", "prediction").agg(F.count(F.lit(1)).alias("n"))
    a, b = count(spark.read.parquet(f"{root}/out")), count(batch).withColumnRenamed("n", "m")
    return (a.join(b, ["time", "prediction"], "full_outer")
            .agg(F.sum("n").alias("rows"), F.count_if(~F.col("n").eqNullSafe(F.col("m"))).alias("mismatches")))


STREAM_QUERIES = {
    "st1_stream_window_mean": q_st1_window_mean,
    "st1_folder_table": q_st1_folder_table,
    "a1_compacted_sink": q_st1_compacted_sink,
    "st2_stream_asof": q_st2_stream_asof,
    "st3_stream_scoring": q_st3_stream_scoring,
    "st3_stream_equals_batch": q_st3_stream_equals_batch,
    "st4_stream_drift": q_st4_stream_drift,
    "st5_stream_pred_counts": q_st5_stream_pred_counts,
    "st5_stream_latency_histogram": q_st5_stream_latency_histogram,
    "st6_stream_error_rate": q_st6_stream_error_rate,
    "alert_stream_a13": q_a13_stream_alert,
    "j1_late_readings": q_st2_late_readings,
    "t3_state_latest": q_st4_state_latest,
    "a5_state_drift": q_st4_state_drift,
}

SQL_A13_STREAM = f"""SELECT job, instance, 'resolved' AS state, end_s AS at_s, start_s, end_s, n_windows FROM ({cat.SQL_A13})
UNION ALL SELECT job, instance, 'firing', start_s + {2 * cat.HOUR}, start_s, start_s + {2 * cat.HOUR}, 2 FROM ({cat.SQL_A13})"""

STREAM_SQL = {
    "st1_stream_window_mean": cat.SQL_WINDOWS.format(w=cat.WIN_A),
    "st1_folder_table": cat.SQL_WINDOWS.format(w=cat.WIN_A),
    "a1_compacted_sink": cat.SQL_WINDOWS.format(w=cat.WIN_A),
    "st2_stream_asof": cat._asof_sql(cat.WIN_A, cat.READ_A),
    "st3_stream_equals_batch": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatches FROM events",
    "st4_stream_drift": cat.SQL_PSI,
    "st5_stream_pred_counts": cat.SQL_A9,
    "st5_stream_latency_histogram": cat.SQL_A10,
    "st6_stream_error_rate": cat.SQL_A12,
    "alert_stream_a13": SQL_A13_STREAM,
    "j1_late_readings": cat._asof_sql(cat.WIN_A, cat.READ_A),
    "t3_state_latest": cat.SQL["t3_latest_n"],
    "a5_state_drift": cat.SQL_PSI,
}
