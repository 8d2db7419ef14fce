"""A1: tumbling-window means per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.functions import nan_to_null, window_start


def tumbling_mean(samples: DataFrame, size_s: int = C.WINDOW_SECONDS,
                  key: str = C.KEY, time_col: str = C.TIME_MS,
                  value_cols: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Mean of ``value_cols`` per (key, floor(time/size)) window.

    Rows with a NULL key or time are dropped (pandas groupby does the same),
    NaN samples are skipped by the mean. Output: key, window_start_s, values.
    The grouping key includes the window, so a hot key is spread over many
    groups, and the partial (map-side) aggregate shrinks it before the shuffle.
    """
    return (samples
            .where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
            .groupBy(F.col(key), window_start(time_col, size_s).alias(C.WINDOW_START))
            .agg(*[F.avg(nan_to_null(c)).alias(c) for c in value_cols]))


def sort_readings(readings: DataFrame, key: str = C.KEY, time_col: str = C.READING_TIME) -> DataFrame:
    """Readings ordered by (key, time) for output (a range-partitioned sort).

    Joins never need it: they sort or hash on their own keys.
    """
    return readings.orderBy(F.col(key), F.col(time_col))


def union_aligned(frames) -> DataFrame:
    """Union by column name; a column missing from a frame becomes NULL."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
