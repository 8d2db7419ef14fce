"""Sensor samples -> labelled windows -> features -> model.

One lazy plan per stage: scan -> partial/final aggregate -> as-of join ->
projection -> partitioned write. No data passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab import schemas
from kinelab.operators.asof import asof_join, auto_bucket, choose_plan, reading_stats
from kinelab.operators.features import fit
from kinelab.operators.sampling import sample_rows
from kinelab.operators.windows import tumbling_mean
from kinelab.sources.clustered import read_clustered, write_clustered
from kinelab.sources.parquet_io import read_stage, write_stage
from kinelab.session import scratch_path
from kinelab.sources.telemetry import save_state


def labelled_windows(samples: DataFrame, readings: DataFrame, size_s: int = C.WINDOW_SECONDS,
                     plan: str = "auto", tiebreak: str | None = "tiebreak",
                     bucket_s: float | None = None, materialize: bool | None = None) -> DataFrame:
    """A1 -> J1 -> P6: (time BIGINT window start s, x, y, z, TAC_Reading, pid).

    When the readings are too big to broadcast, the window table is written
    to the shared checkpoint folder first (``materialize``): the bucketed
    as-of plan reads the left side twice (rows, then its key/bucket pairs),
    and a written table makes the second read a two-column scan and cuts
    the lineage back to the raw samples.
    """
    windows = tumbling_mean(samples, size_s)
    if tiebreak and tiebreak not in readings.columns:
        tiebreak = None
    stats = None
    if plan == "auto":
        stats = reading_stats(readings, C.KEY, C.READING_TIME, [C.READING])
        plan = choose_plan(readings, C.KEY, C.READING_TIME, stats=stats)
        if plan == "bucketed" and bucket_s is None:
            bucket_s = auto_bucket(stats)
    if materialize or (materialize is None and plan == "bucketed"):
        spark = windows.sparkSession
        path = scratch_path(spark, "windows")
        windows.write.mode("overwrite").parquet(path)
        windows = spark.read.parquet(path)
    labelled = asof_join(windows, readings, by=C.KEY, left_t=C.WINDOW_START,
                         right_t=C.READING_TIME, values=[C.READING], tiebreak=tiebreak,
                         plan=plan, bucket_s=bucket_s, stats=stats)
    return labelled.select(F.col(C.WINDOW_START).cast("bigint").alias("time"),
                           "x", "y", "z", C.READING, C.KEY)


@dataclass
class StagePaths:
    labelled: str
    preprocessed: str
    features: str
    state: str
    model: str
    scores: str
    metrics: str = ""
    class_distribution: str = ""
    registry: str = ""


def run_pipeline(spark: SparkSession, paths: StagePaths, stages=("preprocess", "features", "training"),
                 sample_rate: float = C.SAMPLE_RATE, seed: int = C.SEED, forest: dict | None = None,
                 run_name: str = "forest", run_id: str = "run-1"):
    """M9: preprocess -> features -> training, handing over through tables.

    Every stage reads the previous stage's table, so a lost executor only
    recomputes the current stage. Where the paths name the tables, the
    training stage opens a run before it fits and finishes it at the end (T6),
    writes the fold means (A7), the mean accuracy, the time of the training
    and the training rows as the run's metrics (S12), and the class
    distribution of the features (S6).
    """
    from kinelab.operators import drift, folds, model, opsmetrics, registry
    from kinelab.sources import telemetry as tel
    out = {}
    if "preprocess" in stages:
        data = sample_rows(read_labelled(spark, paths.labelled), sample_rate, seed)
        write_stage(data, paths.preprocessed)
    if "features" in stages:
        feats, state = fit(read_stage(spark, paths.preprocessed))
        save_state(state, paths.state)
        write_stage(feats, paths.features)
    if "training" in stages:
        feats = read_stage(spark, paths.features)
        if paths.registry:
            _open_run(spark, paths.registry, run_name, run_id)
        if paths.class_distribution:
            tel.write_class_distribution(drift.class_counts(feats), paths.class_distribution)
        train = model.training_frame(
            folds.stratified_folds(feats, tiebreak=(), time_col="time"))
        write_stage(spread(train), paths.features + "_train")
        train = read_stage(spark, paths.features + "_train").cache()
        scores = model.cross_validate(train, **(forest or {}))
        write_stage(scores, paths.scores)
        fitted = model.fit_forest(train.drop("fold"), **(forest or {}))
        model.save_model(fitted, paths.model)
        out["model"] = fitted
        if paths.metrics:
            means = opsmetrics.fold_metric_means(read_stage(spark, paths.scores))
            done = spark.range(1).select(F.unix_seconds(F.current_timestamp()).cast("double").alias("v"))
            rows = (tel.metric_rows(means, "fold_mean", "value", "name", "name")
                    .unionByName(tel.metric_rows(means.where("name = 'test_accuracy'"), "mean_accuracy", "value"))
                    .unionByName(tel.metric_rows(done, "last_train_time", "v"))
                    .unionByName(tel.metric_rows(train.groupBy().count(), "training_rows", "count")))
            tel.append_metrics(rows, paths.metrics, run_id)
        if paths.registry:
            _finish_run(spark, paths.registry, run_id)
        train.unpersist()
    return out


def spread(df: DataFrame) -> DataFrame:
    """A training table over enough partitions: MLlib's parallelism follows its input's.

    The count is the session's shuffle partitions (sized for the data by the
    deployment), at least the cores.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _registry_versions(path: str, run_id: str) -> tuple[str, str]:
    return f"{path}/opened={run_id}", f"{path}/finished={run_id}"


def _open_run(spark: SparkSession, path: str, run_name: str, run_id: str) -> None:
    wanted = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(run_name).alias("run_name"),
                                   F.lit(None).cast("timestamp").alias("end_time"))
    wanted.write.mode("overwrite").parquet(_registry_versions(path, run_id)[0])


def _finish_run(spark: SparkSession, path: str, run_id: str) -> None:
    opened, finished = _registry_versions(path, run_id)
    (spark.read.schema(schemas.REGISTRY).parquet(opened).withColumn("end_time", F.current_timestamp())
     .write.mode("overwrite").parquet(finished))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: its finished version where there is one."""
    events = spark.read.option("recursiveFileLookup", "true").schema(schemas.REGISTRY).parquet(path)
    return events.groupBy("run_id", "run_name").agg(F.max("end_time").alias("end_time"))


def write_labelled(df: DataFrame, path: str) -> None:
    """S3 for the labelled table: clustered by key inside days, so the files follow the bytes and not the keys."""
    write_clustered(df, path, key=C.KEY, time="time")


def read_labelled(spark: SparkSession, path: str, keys=None) -> DataFrame:
    """S4 for the labelled table, or some of its keys."""
    return read_clustered(spark, path, schemas.LABELLED, keys=keys)
