"""Exact stratified k-fold assignment, unshuffled, contiguous by row order.

Fold sizes follow the public definition of scikit-learn's StratifiedKFold
(shuffle=False): classes are numbered by first appearance in row order; in
the label-sorted sequence, class c occupies positions [s_c, s_c + n_c), and
fold i receives the positions j in that range with j mod k == i. Within a
class, rows keep their order and fill fold 0 first, then fold 1, ...

Row order is a total order given by ``(key, time, tiebreak...)``. The rank
of a row inside its class is computed without a one-partition window over
the rows: counts per (label, key, time bucket) -> prefix sums over keys and
over each key's buckets -> row_number inside each (label, key, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelab import config as C


def _groups(d: DataFrame, label: str, key: str) -> DataFrame:
    """Row counts per (label, key, bucket): a hash aggregate, shared by all users."""
    return d.groupBy(label, key, "_fb").agg(F.count(F.lit(1)).alias("_gn"))


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL meets NULL; the columns of ``on`` come from the left."""
    names = {c: f"_r_{c}" for c in on}
    r = right.withColumnsRenamed(names)
    cond = [left[c].eqNullSafe(r[n]) for c, n in names.items()]
    return left.join(r, cond, how).drop(*names.values())


def _key_offsets(per_key: DataFrame, label: str, key: str) -> DataFrame:
    """(label, key, _koff): rows of the label's smaller keys.

    Two levels: the key table is range-partitioned and written once, rows are
    summed inside each (label, partition), then over the partitions (one row
    per partition and label). No task holds all keys of a label.
    """
    from kinelab.session import scratch_path
    spark = per_key.sparkSession
    path = scratch_path(spark, "fold-keys")
    (per_key.repartitionByRange(F.col(key)).withColumn("_kp", F.spark_partition_id())
     .write.mode("overwrite").parquet(path))
    keys = spark.read.parquet(path)
    before = Window.unboundedPreceding
    parts = (keys.groupBy(label, "_kp").agg(F.sum("_kn").alias("_pn"))
             .withColumn("_poff", F.coalesce(F.sum("_pn").over(
                 Window.partitionBy(label).orderBy("_kp").rowsBetween(before, -1)), F.lit(0))).drop("_pn"))
    inside = Window.partitionBy(label, "_kp").orderBy(key).rowsBetween(before, -1)
    return (keys.withColumn("_ioff", F.coalesce(F.sum("_kn").over(inside), F.lit(0)))
            .join(parts, on=[label, "_kp"])
            .select(label, key, (F.col("_poff") + F.col("_ioff")).alias("_koff")))


def class_rank(d: DataFrame, groups: DataFrame, label: str, key: str, time_col: str,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Adds ``_rank``: 0-based position of the row among rows of its class.

    ``d`` carries the time bucket ``_fb``; ``groups`` is ``_groups(d)``.
    """
    # Two-level prefix sum on the count tables: keys in order within a
    # label (one row per key), then buckets in order within a key (one row
    # per bucket of that key's span). No window sees the raw rows.
    before = Window.unboundedPreceding
    per_key = groups.groupBy(label, key).agg(F.sum("_gn").alias("_kn"))
    key_off = _key_offsets(per_key, label, key)
    boff = groups.withColumn("_boff", F.coalesce(F.sum("_gn").over(
        Window.partitionBy(label, key).orderBy("_fb").rowsBetween(before, -1)), F.lit(0)))
    offsets = (_null_safe(boff, key_off, [label, key])
               .select(label, key, "_fb", (F.col("_koff") + F.col("_boff")).alias("_off")))
    order = [F.col(time_col)] + [F.col(c) for c in tiebreak]
    wr = Window.partitionBy(label, key, "_fb").orderBy(*order)
    ranked = d.withColumn("_rn", F.row_number().over(wr))
    return (_null_safe(ranked, offsets, [label, key, "_fb"], "left")
            .withColumn("_rank", F.col("_off") + F.col("_rn") - 1)
            .drop("_fb", "_rn", "_off"))


def class_order(d: DataFrame, groups: DataFrame, label: str, key: str, time_col: str,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """(label, _first, _n): each class's first row in row order, and its size.

    The first (key, bucket) group of each class comes from the small count
    table; the exact first row is then taken only among the rows of those
    few groups (a broadcast filter), so no sort runs over all rows.
    """
    # The min reads the group count (always > 0) so that the optimizer keeps
    # the group aggregate underneath: a min over the group columns alone
    # would be rewritten onto the raw rows and sort all of them.
    first_group = groups.groupBy(label).agg(
        F.min(F.when(F.col("_gn") > 0, F.struct(F.col(key).alias("k"), F.col("_fb").alias("b"))))
        .alias("_fg"),
        F.sum("_gn").alias("_n"))
    fg = first_group.select(label, F.col("_fg.k").alias(key), F.col("_fg.b").alias("_fb"))
    first = F.struct(*[F.col(c) for c in (key, time_col, *tiebreak)])
    firsts = (_null_safe(d, F.broadcast(fg), [label, key, "_fb"])
              .groupBy(label).agg(F.min(first).alias("_first")))
    return first_group.select(label, "_n").join(firsts, on=label)


def fold_table(classes: DataFrame, label: str, k: int = C.NUM_FOLDS) -> DataFrame:
    """(label, fold, lo, hi): class rows with lo <= rank < hi go to ``fold``.

    ``classes`` is ``class_order(...)``; size is classes x k rows.
    """
    # Classes in order of first appearance; start of each class in the
    # label-sorted sequence (a window over the few classes).
    wc = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("_s", F.coalesce(F.sum("_n").over(wc), F.lit(0)))
    i = F.col("fold")

    def upto(m):  # number of j in [0, m) with j % k == i
        return F.floor((m - i + F.lit(k - 1)) / F.lit(k))

    alloc = (classes.select(label, "_s", "_n", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
             .withColumn("_a", (upto(F.col("_s") + F.col("_n")) - upto(F.col("_s"))).cast("bigint")))
    wf = Window.partitionBy(label).orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    return (alloc.withColumn("lo", F.coalesce(F.sum("_a").over(wf), F.lit(0)).cast("bigint"))
            .select(label, "fold", "lo", (F.col("lo") + F.col("_a")).alias("hi")))


def stratified_folds(df: DataFrame, label: str = C.LABEL, key: str = C.KEY,
                     time_col: str = "time", tiebreak: Sequence[str] = (),
                     k: int = C.NUM_FOLDS, bucket_s: float = C.FOLD_BUCKET_SECONDS,
                     time_per_s: float = 1.0) -> DataFrame:
    """Adds ``fold`` (0..k-1) to every row with a non-NULL label."""
    cols = df.columns
    d = (df.where(F.col(label).isNotNull())
         .withColumn("_fb", F.floor(F.col(time_col) / F.lit(float(bucket_s) * time_per_s))))
    groups = _groups(d, label, key)
    ranked = class_rank(d, groups, label, key, time_col, tiebreak)
    classes = class_order(d, groups, label, key, time_col, tiebreak)
    folds = F.broadcast(fold_table(classes, label, k).alias("f"))
    j = ranked.join(folds, (ranked[label] == F.col(f"f.{label}"))
                    & (F.col("_rank") >= F.col("f.lo")) & (F.col("_rank") < F.col("f.hi")))
    return j.select(*[ranked[c] for c in cols], F.col("f.fold").cast("int").alias("fold"))
