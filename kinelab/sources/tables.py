"""The driver's parquet tables and their bindings to our roles (FIXTURES §2).

Each binding is a lazy projection over one scan, so Catalyst prunes the
columns and pushes the filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.functions import epoch_ms, epoch_s, json_field


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor samples A: pid, time_ms, x, y, z (+ event_id for ordering)."""
    return sensor_from_events(table(spark, sf_dir, "events"))


def sensor_from_events(ev: DataFrame) -> DataFrame:
    """Binding of an events frame (batch or stream) to sensor samples; keeps ts."""
    return ev.select(
        F.col("user_id").alias(C.KEY),
        epoch_ms("ts").alias(C.TIME_MS),
        F.col("value").alias("x"),
        json_field("props", "k").alias("y"),
        ((F.col("event_id") % 100) / F.lit(10.0)).alias("z"),
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def sensor_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor samples B: pid = supplier."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias(C.KEY),
        epoch_ms("l_shipdate").alias(C.TIME_MS),
        F.col("l_quantity").alias("x"),
        F.col("l_discount").alias("y"),
        F.col("l_tax").alias("z"),
    )


def sensor_lineitem_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor samples for the wide-range readings: lineitem joined to orders for pid."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias(C.KEY),
                    epoch_ms("l_shipdate").alias(C.TIME_MS),
                    F.col("l_quantity").alias("x"),
                    F.col("l_discount").alias("y"),
                    F.col("l_tax").alias("z")))


def readings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings: purchase events; tie-break event_id."""
    return readings_from_events(table(spark, sf_dir, "events"))


def readings_from_events(ev: DataFrame) -> DataFrame:
    """Binding of an events frame (batch or stream) to readings."""
    return (ev.where(F.col("event_type") == "purchase")
            .select(F.col("user_id").alias(C.KEY),
                    epoch_s("ts").alias(C.READING_TIME),
                    (F.col("value") / F.lit(500.0)).alias(C.READING),
                    F.col("event_id").alias("tiebreak")))


def readings_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings over a wide time range: orders; tie-break o_orderkey."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias(C.KEY),
                    epoch_s("o_orderdate").alias(C.READING_TIME),
                    (F.col("o_totalprice") / F.lit(1e6)).alias(C.READING),
                    F.col("o_orderkey").alias("tiebreak"))


def scored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored log: timestamp (ms), is_intoxicated, event_id, latency_s, kind."""
    return scored_from_events(table(spark, sf_dir, "events"))


def scored_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        epoch_ms("ts").alias("timestamp"),
        ((F.col("value") / F.lit(500.0)) >= F.lit(C.LABEL_THRESHOLD)).alias(C.LABEL),
        F.col("event_id"),
        (F.col("value") / F.lit(50.0)).alias("latency_s"),
        F.col("event_type").alias("kind"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def http_log(spark: SparkSession, sf_dir: str, job: str = "scoring-api") -> DataFrame:
    """HTTP log: ts, code (500 for error events, else 200), job, instance."""
    return http_from_events(table(spark, sf_dir, "events"), job)


def http_from_events(ev: DataFrame, job: str = "scoring-api") -> DataFrame:
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")).alias("code"),
        F.lit(job).alias("job"),
        (F.col("user_id") % 4).cast("string").alias("instance"),
    )


def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run registry: run_id, run_name, end_time (NULL = unfinished)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("run_name"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("timestamp"))
         .otherwise(F.col("o_orderdate").cast("timestamp")).alias("end_time"),
    )


def truth_and_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """y_true = toxic = 1, y_pred = quality = 0."""
    lb = table(spark, sf_dir, "labels")
    return lb.select("doc_id", (F.col("toxic") == 1).alias("y_true"),
                     (F.col("quality") == 0).alias("y_pred"))
