"""Explicit schemas for every source (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

SENSOR_CSV = T.StructType([
    T.StructField("pid", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
])

READING_CSV_COLUMNS = ("timestamp", "TAC_Reading")
READING_TYPES = {"timestamp": T.LongType(), "TAC_Reading": T.DoubleType()}

LABELLED = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("TAC_Reading", T.DoubleType()),
    T.StructField("pid", T.StringType()),
])

REQUEST = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("magnitude", T.DoubleType()),
])

# {target: {"false": n, "true": n}}
CLASS_DISTRIBUTION = T.MapType(
    T.StringType(),
    T.StructType([
        T.StructField("false", T.LongType()),
        T.StructField("true", T.LongType()),
    ]),
)

# {"timestamp": {row: ms}, "is_intoxicated": {row: bool}}
COLUMN_LOG = T.StructType([
    T.StructField("timestamp", T.MapType(T.StringType(), T.LongType())),
    T.StructField("is_intoxicated", T.MapType(T.StringType(), T.BooleanType())),
])

FITTED_STATE = T.StructType([
    T.StructField(name, T.StructType([
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]))
    for name in ("energy", "magnitude")
])

REGISTRY = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("end_time", T.TimestampType()),
])

METRIC = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("label_key", T.StringType()),
    T.StructField("label_value", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])
