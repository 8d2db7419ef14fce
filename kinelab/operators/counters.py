"""A12 over counter samples: rates of cumulative counters that may restart, and what is summed over them.

A sample is the value of a counter of one series (job, instance, code) at a
scrape. The rate at a time t over a range r follows the public definition of
Prometheus for ``rate(counter[r])``: the increase over the samples in (t - r, t],
a fall of the value being a restart from 0, extrapolated to the ends of the
range where the samples reach near them, and never below 0 at its start.

Each sample is repeated for the evaluation times whose range holds it (range
over step of them), and all else is one aggregate by (series, time): a hot
series is spread over its times. The value before a sample is found inside
stretches of a series' time, with the last value of the stretch before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelab.functions import not_matching

SERIES = ("job", "instance", "code")
#: Samples of one series that lie this close (seconds) are ordered in one task.
STRETCH_S = 86_400
#: Fixed value of the definition: samples reach an end of the range within this many mean distances.
NEAR = 1.1


def restarts(samples: DataFrame, series: Sequence[str] = SERIES, time: str = "at_s", value: str = "value") -> DataFrame:
    """``samples`` with ``lost``: the value before a restart, which the sample no longer holds (else 0)."""
    key = [F.col(c) for c in series]
    rows = samples.withColumn("_stretch", F.floor(F.col(time) / STRETCH_S))
    last = (rows.groupBy(*key, "_stretch").agg(F.max_by(value, F.struct(time, value)).alias("_end"))
            .withColumn("_carried", F.lag("_end").over(Window.partitionBy(*key).orderBy("_stretch"))).drop("_end"))
    inside = Window.partitionBy(*key, "_stretch").orderBy(time, value)
    before = F.coalesce(F.lag(value).over(inside), F.col("_carried"))
    same = None
    for c in (*series, "_stretch"):
        equal = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        same = equal if same is None else same & equal
    joined = rows.alias("a").join(last.alias("b"), same).select("a.*", "b._carried")
    return (joined.withColumn("_before", before)
            .withColumn("lost", F.when(F.col(value) < F.col("_before"), F.col("_before")).otherwise(0.0))
            .drop("_before", "_carried", "_stretch"))


def rates(samples: DataFrame, range_s: int, step_s: int, series: Sequence[str] = SERIES,
          time: str = "at_s", value: str = "value") -> DataFrame:
    """series, t_s, n, rate (per second) at every multiple of ``step_s`` whose range holds two samples or more.

    ``time`` is in seconds (whole or not), ``value`` a double; samples without either are left out.
    """
    clean = samples.where(F.col(time).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
    first = F.ceil(F.col(time) / step_s)
    until = F.ceil((F.col(time) + range_s) / step_s)  # a sample as old as the range is outside
    each = (restarts(clean, series, time, value).where(until > first)
            .withColumn("t_s", F.explode(F.transform(F.sequence(first, until - 1), lambda k: k * step_s))))
    s = F.struct(time, value, "lost")
    got = (each.groupBy(*series, "t_s")
           .agg(F.count(F.lit(1)).alias("n"), F.min(s).alias("a"), F.max(s).alias("b"), F.sum("lost").alias("lost"))
           .where("n >= 2").where(F.col(f"b.{time}") > F.col(f"a.{time}")))
    increase = F.col(f"b.{value}") - F.col(f"a.{value}") + F.col("lost") - F.col("a.lost")
    shaped = (got.withColumn("increase", increase)
              .withColumn("span", (F.col(f"b.{time}") - F.col(f"a.{time}")).cast("double"))
              .withColumn("gap", F.col("span") / (F.col("n") - 1)))

    def reach(distance: Column) -> Column:
        return F.when(distance >= F.col("gap") * NEAR, F.col("gap") / 2).otherwise(distance.cast("double"))

    to_start = reach(F.col(f"a.{time}") - (F.col("t_s") - range_s))
    to_zero = F.when((F.col("increase") > 0) & (F.col(f"a.{value}") >= 0), F.col("span") * F.col(f"a.{value}") / F.col("increase"))
    covered = F.col("span") + F.least(to_start, to_zero) + reach(F.col("t_s") - F.col(f"b.{time}"))
    return shaped.select(*series, F.col("t_s").cast("long").alias("t_s"), F.col("n").cast("long").alias("n"),
                         (F.col("increase") * (covered / F.col("span")) / float(range_s)).alias("rate"))


def error_rates(samples: DataFrame, range_s: int, step_s: int, ok_pattern: str = "200",
                by: Sequence[str] = ("job", "instance")) -> DataFrame:
    """By, window_start_s (the evaluation time), rate: the summed rates of all codes but the OK ones, where above 0."""
    bad = rates(samples.where(not_matching("code", ok_pattern)), range_s, step_s)
    return (bad.groupBy(*by, F.col("t_s").alias("window_start_s")).agg(F.sum("rate").alias("rate"))
            .where(F.col("rate") > 0))
