"""Features, labels and fitted statistics.

Training and scoring are explicit functions (no hidden mode by fitted
state, Q6). Fitted state is a one-row DataFrame of STRUCT<mean, std>
columns, computed in ONE aggregate pass (the reference runs eight jobs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.functions import energy, magnitude, ms_to_seconds, threshold_label


def with_energy_magnitude(df: DataFrame) -> DataFrame:
    """F1, F2 (M2 scoring mode). Client-sent energy/magnitude are overwritten (Q4)."""
    return (df.withColumn("energy", energy("x", "y", "z"))
              .withColumn("magnitude", magnitude("energy")))


def with_label(df: DataFrame, threshold: float = C.LABEL_THRESHOLD,
               unmatched: str = "null", reading: str = C.READING) -> DataFrame:
    """is_intoxicated = reading >= threshold (NULL for unmatched by default)."""
    return df.withColumn(C.LABEL, threshold_label(reading, threshold, unmatched))


def training_features(df: DataFrame, threshold: float = C.LABEL_THRESHOLD,
                      unmatched: str = "null") -> DataFrame:
    """M1 without the fit: energy, magnitude, label."""
    return with_label(with_energy_magnitude(df), threshold, unmatched)


def scoring_features(df: DataFrame, order: Sequence[str] = C.FEATURE_ORDER) -> DataFrame:
    """M2 + P7: features in the fixed model order; absent inputs become NULL.

    Requests carry epoch milliseconds, the training table epoch seconds; the
    conversion (F3) happens here, at the boundary.
    """
    have = [c for c in ("x", "y", "z") if c not in df.columns]
    for c in have:
        df = df.withColumn(c, F.lit(None).cast("double"))
    if "time" in df.columns:
        df = df.withColumn("time", ms_to_seconds("time"))
    return ordered_columns(with_energy_magnitude(df), order)


def ordered_columns(df: DataFrame, order: Sequence[str], dtype: str = "double") -> DataFrame:
    """Select ``order``; a missing column becomes a typed NULL."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(dtype).alias(c)
                       for c in order])


def fit_stats(df: DataFrame, cols: Sequence[str] = ("energy", "magnitude")) -> DataFrame:
    """A2: mean and sample stddev of each column, one pass (1 row -> std NULL)."""
    aggs: list[Column] = []
    for c in cols:
        aggs.append(F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c))
    return df.agg(*aggs)


def fit(df: DataFrame, threshold: float = C.LABEL_THRESHOLD,
        unmatched: str = "null") -> tuple[DataFrame, DataFrame]:
    """M1 training mode: (features, fitted one-row state)."""
    feats = training_features(df, threshold, unmatched)
    return feats, fit_stats(feats)


def transform(df: DataFrame) -> DataFrame:
    """M2 scoring mode."""
    return with_energy_magnitude(df)


def drop_non_training(df: DataFrame) -> DataFrame:
    """Drop the key and the raw reading."""
    return df.drop(C.KEY, C.READING)


def split_xy(df: DataFrame, features: Sequence[str] = C.FEATURE_ORDER,
             label: str = C.LABEL) -> DataFrame:
    """P5: features in fixed order plus the label as boolean."""
    return drop_non_training(df).select(*[F.col(c) for c in features],
                                        F.col(label).cast("boolean").alias(label))
