"""Class counts, latest-N shares and PSI drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelab import config as C


def class_counts(df: DataFrame, targets: Sequence[str] = C.DRIFT_TARGETS) -> DataFrame:
    """A3: (target, category, cnt) with both categories, zero counts included.

    One aggregate pass with conditional counts (partial aggregation, no
    shuffle of rows); NULL labels count in neither category.
    """
    aggs = []
    for t in targets:
        aggs += [F.count_if(F.col(t) == F.lit(False)).alias(f"{t}\u0001false"),
                 F.count_if(F.col(t) == F.lit(True)).alias(f"{t}\u0001true")]
    wide = df.agg(*aggs)
    return _stack_counts(wide, targets, "cnt")


def _stack_counts(wide: DataFrame, targets: Sequence[str], value: str) -> DataFrame:
    args = []
    for t in targets:
        for cat in ("false", "true"):
            args.append(f"'{t}', '{cat}', `{t}\u0001{cat}`")
    expr = f"stack({2 * len(targets)}, {', '.join(args)}) as (target, category, {value})"
    return wide.selectExpr(expr)


def latest_n(log: DataFrame, n: int = C.LIVE_ROWS, order: Sequence[str] = ("timestamp", "event_id"),
             require_full: bool = True) -> DataFrame:
    """T3 + T4: newest ``n`` rows by ``order`` (descending, total order).

    ``orderBy().limit()`` plans as a TakeOrderedAndProject: each partition
    keeps its own top n, so only n rows per partition move. With
    ``require_full`` fewer than n rows give an empty result (T4).
    """
    top = log.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    if not require_full:
        return top
    # The window is over at most n rows.
    return (top.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
            .where(F.col("_n") >= F.lit(n)).drop("_n"))


def live_shares(latest: DataFrame, targets: Sequence[str] = C.DRIFT_TARGETS,
                epsilon: float = C.PSI_EPSILON) -> DataFrame:
    """A4: (target, category, q) with q = count(category)/count(rows) + eps."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for t in targets:
        aggs += [F.count_if(F.col(t) == F.lit(False)).alias(f"{t}\u0001false"),
                 F.count_if(F.col(t) == F.lit(True)).alias(f"{t}\u0001true")]
    wide = latest.agg(*aggs).where(F.col("_total") > 0)
    # stack keeps _total alongside each (target, category) row
    args = []
    for t in targets:
        for cat in ("false", "true"):
            args.append(f"'{t}', '{cat}', `{t}\u0001{cat}`")
    long = wide.selectExpr("_total", f"stack({2 * len(targets)}, {', '.join(args)}) "
                                     "as (target, category, cnt)")
    return long.select("target", "category",
                       (F.col("cnt") / F.col("_total") + F.lit(epsilon)).alias("q"))


def training_shares(counts: DataFrame, epsilon: float = C.PSI_EPSILON) -> DataFrame:
    """(target, category, p) with p = cnt / total(target) + eps.

    ``counts`` is the small class-count table (targets x categories).
    """
    total = F.sum("cnt").over(Window.partitionBy("target"))
    return counts.withColumn("_total", total).where(F.col("_total") > 0).select("target", "category",
                         (F.col("cnt") / F.col("_total") + F.lit(epsilon)).alias("p"))


def psi(train_counts: DataFrame, latest: DataFrame, targets: Sequence[str] = C.DRIFT_TARGETS,
        epsilon: float = C.PSI_EPSILON) -> DataFrame:
    """A5 + A6 + J4: (target, psi) with psi = sum((q - p) * ln(q / p)).

    Categories are aligned by a full outer join on (target, category); a
    category absent on one side has share eps there. Targets without live
    or without reference rows give no row (the guard of T4 propagates).
    """
    p = training_shares(train_counts, epsilon)
    q = live_shares(latest, targets, epsilon)
    j = p.join(q, on=["target", "category"], how="full_outer")
    pp = F.coalesce(F.col("p"), F.lit(epsilon))
    qq = F.coalesce(F.col("q"), F.lit(epsilon))
    return (j.groupBy("target")
            .agg(F.sum((qq - pp) * F.log(qq / pp)).alias("psi"),
                 F.count_if(F.col("q").isNotNull()).alias("_live"),
                 F.count_if(F.col("p").isNotNull()).alias("_ref"))
            .where((F.col("_live") > 0) & (F.col("_ref") > 0)).drop("_live", "_ref"))


def psi_pairs(pairs: DataFrame) -> DataFrame:
    """PSI of share columns already aligned: (group, p, q) -> (group, psi)."""
    return pairs.groupBy("group").agg(
        F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"))


def quantile_disc(df: DataFrame, col: str, q: float = 0.5, buckets: int = 4096,
                  max_rounds: int = 16):
    """Exact discrete quantile: the value at 0-based index floor((n-1)*q).

    A distributed selection: each round counts the rows of the current value
    range in ``buckets`` equal-width buckets (one groupBy; at most
    ``buckets`` small rows reach the driver) and keeps the bucket holding the
    target index. Rounds shrink the range by the bucket count, so a 64-bit
    value range needs about five passes over the one column. No buffer
    grows with the data (an exact ``percentile`` or a high-accuracy
    ``percentile_approx`` would hold up to all values in one task).
    """
    v = df.select(F.col(col).alias("v")).where(F.col("v").isNotNull())
    stats = v.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n = stats["n"]
    if not n:
        return None
    k = int((n - 1) * q)  # target index among all non-null values
    lo, hi, below = stats["lo"], stats["hi"], 0
    for _ in range(max_rounds):
        if lo == hi:
            return lo
        width = (float(hi) - float(lo)) / buckets
        b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1))
        hist = (v.where((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)))
                .groupBy(b.alias("b"))
                .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .collect())
        for row in sorted(hist, key=lambda r: r["b"]):
            if below + row["c"] > k:
                lo, hi = row["lo"], row["hi"]
                break
            below += row["c"]
    raise RuntimeError("quantile_disc did not converge")
