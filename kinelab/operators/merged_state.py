"""S10, A2, A3 as mergeable state: statistics per batch, merged when they are read.

Each batch of features leaves one row: per column the count, mean and sum of
squared deviations (M2), per target the class counts. The fitted state of all
batches is a merge of these rows, two at a time, so training statistics grow
with a batch and never rescan the rows before it. A batch that is written again
replaces its row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelab import config as C

COLUMNS = ("energy", "magnitude")
#: Rows of the state table are merged in this many groups first, then these.
GROUPS = 64


def batch_state(features: DataFrame, cols: Sequence[str] = COLUMNS, targets: Sequence[str] = C.DRIFT_TARGETS) -> DataFrame:
    """One row: per column (n, mean, m2), per target (false, true); one pass."""
    moments = [F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("m2")).alias(c) for c in cols]
    counts = [F.struct(*[F.count_if(F.col(t) == F.lit(v)).alias(str(v).lower()) for v in (False, True)]).alias(t) for t in targets]
    return features.agg(*moments, *counts)


def write_batch_state(features: DataFrame, path: str, batch: int | str, **kw) -> None:
    """The state row of one batch; a second write of the batch replaces the first."""
    batch_state(features, **kw).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def state_writer(path: str, **kw) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink for streams of features."""
    return lambda batch, batch_id: write_batch_state(batch, path, batch_id, **kw)


def read_batch_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("string"))


def _merge(a: Column, b: Column) -> Column:
    """(n, mean, m2) of two disjoint sets of values together."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    both = F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)


def merged(states: DataFrame, cols: Sequence[str] = COLUMNS, targets: Sequence[str] = C.DRIFT_TARGETS) -> DataFrame:
    """The state row of all batches together."""
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2"))

    def together(df: DataFrame, *by: Column) -> DataFrame:
        moments = [F.aggregate(F.array_sort(F.collect_list(c)), empty, _merge).alias(c) for c in cols]
        counts = [F.struct(*[F.coalesce(F.sum(f"{t}.{v}"), F.lit(0)).alias(v) for v in ("false", "true")]).alias(t) for t in targets]
        return df.groupBy(*by).agg(*moments, *counts)

    return together(together(states, F.pmod(F.xxhash64("batch"), F.lit(GROUPS)).alias("group")))


def fitted(state: DataFrame, cols: Sequence[str] = COLUMNS) -> DataFrame:
    """A2: mean and sample standard deviation per column, in the layout of ``features.fit_stats``."""
    std = lambda c: F.when(F.col(f"{c}.n") > 1, F.sqrt(F.col(f"{c}.m2") / (F.col(f"{c}.n") - 1)))
    return state.select(*[F.struct(F.col(f"{c}.mean").alias("mean"), std(c).alias("std")).alias(c) for c in cols])


def counts(state: DataFrame, targets: Sequence[str] = C.DRIFT_TARGETS) -> DataFrame:
    """A3: (target, category, cnt), in the layout of ``drift.class_counts``."""
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.lit(v).alias("category"), F.col(f"{t}.{v}").alias("cnt"))
                               for t in targets for v in ("false", "true")]))
    return state.select(rows.alias("r")).select("r.*")
