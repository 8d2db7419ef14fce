"""ST1-ST6: Structured Streaming jobs.

Sinks are parquet folders under the shared checkpoint root; foreachBatch
writers overwrite one ``batch_id=N`` folder per micro-batch, so a retried
batch replaces its own output instead of duplicating it (exactly-once).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinelab import config as C
from kinelab.functions import bool_text, nan_to_null
from kinelab.operators import drift
from kinelab.operators.asof import asof_join
from kinelab.operators.features import scoring_features
from kinelab.operators.model import fill_missing
from kinelab.sources.parquet_io import is_folder
from kinelab.sources.telemetry import parse_requests

log = logging.getLogger(__name__)


def table_stream(spark: SparkSession, folder: str, name: str,
                 max_files: int | None = None) -> DataFrame:
    """Stream the table ``name`` of ``folder``: a folder of part files, or one file (schema from the table)."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> int:
    """Process everything available now, then stop; returns the rows dropped as too late."""
    q: StreamingQuery = (df.writeStream.format(fmt).outputMode(mode)
                         .option("path", path).option("checkpointLocation", checkpoint)
                         .trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = late_rows(q)
    if dropped:
        log.warning("%d rows came after their window was closed (watermark)", dropped)
    return dropped


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators dropped behind the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def open_from(samples: DataFrame, size_s: int, delay_s: int, event_time: str = "ts") -> int | None:
    """Start of the first window (epoch seconds) that a drained stream has not emitted.

    Append mode emits a window once the watermark (largest event time less the
    delay) reaches its end. At the end of the input the rest is flushed as a
    batch: the same aggregate over the rows from this time on, whose windows
    are exactly the open ones. None for an empty input.
    """
    last = samples.agg(F.max(F.unix_millis(event_time))).first()[0]
    return None if last is None else int((last - 1000 * delay_s) // (1000 * size_s) * size_s)


def open_rows(samples: DataFrame, size_s: int, delay_s: int, event_time: str = "ts") -> DataFrame:
    """The rows of the windows that a drained stream has not emitted."""
    start = open_from(samples, size_s, delay_s, event_time)
    return samples.where(F.col(event_time) >= F.timestamp_seconds(F.lit(start or 0)))


#: The state store for arbitrary keyed state: changes are logged per batch, snapshots come now and then, few versions stay.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "10",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that arbitrary keyed state needs, for the streams started inside."""
    old = {k: spark.conf.get(k, None) for k in KEYED_STATE}
    for k, v in KEYED_STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_foreach(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    trig = trigger or {"availableNow": True}
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(fn).trigger(**trig).start())
    if trig.get("availableNow"):
        q.awaitTermination()
    return q


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: overwrite the folder of this batch id (idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


# ------------------------------------------------------------------- ST1
def window_means(samples: DataFrame, size_s: int, delay: str,
                 event_time: str = "ts", key: str = C.KEY,
                 value_cols: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """ST1: tumbling-window means per key, emitted once the watermark passes the window.

    ``delay`` is how late a row may come; a later one is dropped and counted
    (``late_rows``). On a static frame the watermark does nothing, which is
    how the end-of-input flush uses it.
    """
    # No filter before the aggregate: Catalyst pushes filters below the
    # watermark, which would then follow only the surviving rows' event time.
    # NULL keys are dropped from the finished windows instead.
    return (samples.withWatermark(event_time, delay)
            .groupBy(F.col(key), F.window(event_time, f"{size_s} seconds").alias("w"))
            .agg(*[F.avg(nan_to_null(c)).alias(c) for c in value_cols])
            .where(F.col(key).isNotNull())
            .select(key, F.unix_seconds(F.col("w.start")).alias(C.WINDOW_START), *value_cols))


# ------------------------------------------------------------------- ST2
def asof_labeller(readings: DataFrame, path: str, tiebreak: str | None = "tiebreak",
                  bucket_s: float | None = None) -> Callable[[DataFrame, int], None]:
    """ST2: label each micro-batch of closed windows against static readings.

    The readings are reduced to one row per (key, time) and written once
    next to the output, so every micro-batch reads a small prepared table
    instead of re-scanning the source. Their size is checked once (Plan A
    needs a bounded side); each batch then runs the broadcast interval join,
    or Plan C beyond the bound.
    """
    from kinelab.operators.asof import auto_bucket, choose_plan, dedupe_readings, reading_stats
    spark = readings.sparkSession
    prepared = f"{path}_readings"
    (dedupe_readings(readings, C.KEY, C.READING_TIME, [C.READING], tiebreak)
     .select(F.col("_k").alias(C.KEY), F.col("_rt").alias(C.READING_TIME), F.col(f"_r.{C.READING}"))
     .write.mode("overwrite").parquet(prepared))
    table = spark.read.parquet(prepared)
    stats = reading_stats(table, C.KEY, C.READING_TIME, [C.READING])
    plan = choose_plan(table, C.KEY, C.READING_TIME, stats=stats)
    if plan == "bucketed":
        bucket_s = bucket_s or auto_bucket(stats)

    def label(batch: DataFrame, batch_id: int | str) -> None:
        out = asof_join(batch, table, C.KEY, C.WINDOW_START, C.READING_TIME, [C.READING],
                        tiebreak=None, plan=plan, bucket_s=bucket_s, stats=stats)
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return label


# ------------------------------------------------------------------- ST3
def scoring(requests: DataFrame, model, keep: Sequence[str] = ("time",)) -> DataFrame:
    """ST3: JSON request lines -> features -> model prediction (a stateless stream)."""
    feats = fill_missing(scoring_features(parse_requests(requests)))
    return model.transform(feats).select(*keep, F.col("prediction").cast("int").alias("prediction"))


# ------------------------------------------------------------------- ST4
def drift_monitor(train_counts: DataFrame, log_path: str, psi_path: str,
                  n: int = C.LIVE_ROWS, latest_path: str | None = None
                  ) -> Callable[[DataFrame, int], None]:
    """ST4: append the batch to the scored-log table, then PSI of the latest n rows.

    A micro-batch alone is not the latest n. Instead of re-sorting the whole
    log each trigger, the latest n rows are kept as a small state table:
    latest(log + batch) = latest(previous latest + batch). Each batch writes
    its own state folder, so a replayed batch reads the same previous state.
    """
    latest_path = latest_path or f"{psi_path}_latest"
    # The reference counts (targets x categories) are computed once, not per trigger.
    train_counts.write.mode("overwrite").parquet(f"{psi_path}_reference")
    counts = train_counts.sparkSession.read.schema(train_counts.schema).parquet(f"{psi_path}_reference")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log_part = f"{log_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(log_part)
        cand = spark.read.schema(batch.schema).parquet(log_part)  # the batch is evaluated once
        prev = _previous_state(spark, latest_path, batch_id)
        if prev is not None:
            cand = prev.unionByName(cand)
        top = drift.latest_n(cand, n, require_full=False)
        top.write.mode("overwrite").parquet(f"{latest_path}/b={batch_id}")
        latest = drift.latest_n(spark.read.parquet(f"{latest_path}/b={batch_id}"), n)
        (drift.psi(counts, latest).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{psi_path}/b={batch_id}"))
    return step


def _previous_state(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    """The newest state folder written by an earlier batch (at most n rows)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    prev = jvm.org.apache.hadoop.fs.Path(f"{root}/b={batch_id - 1}")
    if fs.exists(prev):  # the usual case: no listing of the growing folder
        return spark.read.parquet(f"{root}/b={batch_id - 1}")
    ids = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("b=") and int(name[2:]) < batch_id:
            ids.append(int(name[2:]))
    if not ids:
        return None
    return spark.read.parquet(f"{root}/b={max(ids)}")


# ------------------------------------------------------------------- ST5
def prediction_counter(scored: DataFrame, pred: str = C.LABEL) -> DataFrame:
    """ST5: running count per predicted class (complete mode; two keys of state)."""
    return scored.groupBy(bool_text(pred).alias("pred")).agg(F.count(F.lit(1)).alias("cnt"))


def version_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Complete-mode sink: each batch writes the whole table as its own version."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    return write


def newest_version(spark: SparkSession, path: str) -> DataFrame:
    """The table of the newest version whose write has ended; a version being written is not seen."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [int(st.getPath().getName()[8:]) for st in fs.listStatus(p)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
    return spark.read.parquet(f"{path}/version={max(done)}")


# ------------------------------------------------------------------- ST6
def error_windows(http: DataFrame, window_s: int, delay: str,
                  ok_pattern: str = "200") -> DataFrame:
    """ST6: non-OK responses per (window, job, instance) with a watermark."""
    from kinelab.functions import not_matching
    # Errors are counted inside the aggregate rather than filtered before it:
    # a filter would be pushed below the watermark, which would then follow
    # only error events and leave windows open while other traffic flows.
    bad = not_matching("code", ok_pattern)
    return (http.withWatermark("ts", delay)
            .groupBy(F.window("ts", f"{window_s} seconds").alias("w"), "job", "instance")
            .agg(F.count_if(bad).alias("errors"))
            .where(F.col("errors") > 0)
            .select("job", "instance", F.unix_seconds(F.col("w.start")).alias("window_start_s"),
                    "errors", (F.col("errors") / F.lit(float(window_s))).alias("rate")))
