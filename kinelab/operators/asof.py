"""Backward as-of left join by key.

For every left row, attach the values of the newest right row of the same
key whose time is <= the left time (exact match allowed, no tolerance).
Left rows without such a row keep NULL values (J2). Right rows with equal
(key, time) are first reduced to one: the largest ``tiebreak`` wins.

Spark has no public as-of operator, so three plans rewrite it:

* ``broadcast`` (Plan A): each reading becomes the interval [ts, next_ts).
  Intervals are exploded over time buckets sized per key, longer ones over
  wider buckets (levels), and probed with one equi-join on (key, bucket) per
  level plus the range condition; open-ended intervals, one per key, are
  probed by key. The reading tables are broadcast; the left side is never
  shuffled.
* ``union`` (Plan B): union both sides, sort by (key, time, side) and carry
  the last reading forward with ``last(ignorenulls)``. Simple, but a key
  holding a large share of rows lands in one task.
* ``bucketed`` (Plan C): Plan B per (key, time bucket), then a carry-in for
  buckets that start without a reading, computed per key on one row per
  bucket. No task holds more than one bucket of one key's rows.

Times are compared in a type that holds both sides, in every plan.

``auto`` measures the right side and uses ``broadcast`` only when its rows and
bytes (times the explode bound) are under the limits, ``bucketed`` otherwise. An
explicit ``broadcast`` request is held to the same bound.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.session import scratch_path

log = logging.getLogger(__name__)


def common_time(left: DataFrame, left_t: str, right: DataFrame, right_t: str) -> str:
    """The type both times are compared in: whole numbers stay BIGINT, mixed numbers become DOUBLE.

    Comparing in the left side's type would round a reading at 10.5 s down to
    10 and attach it to a window that starts before it.
    """
    a, b = (df.schema[t].dataType.simpleString() for df, t in ((left, left_t), (right, right_t)))
    whole = {"tinyint", "smallint", "int", "bigint"}
    if a == b:
        return a
    return "bigint" if {a, b} <= whole else "double"


def dedupe_readings(right: DataFrame, by: str, t: str, values: Sequence[str],
                    tiebreak: str | None = None, t_type: str | None = None) -> DataFrame:
    """One row per (key, time): ``_k, _rt, _r`` with ``_r`` a struct of values.

    Grouping on (key, time) spreads a hot key over many groups. All values
    come from one row: the largest by (tie-break, values).
    """
    time = F.col(t).cast(t_type) if t_type else F.col(t)
    base = (right.where(F.col(by).isNotNull() & F.col(t).isNotNull())
            .groupBy(F.col(by).alias("_k"), time.alias("_rt")))
    if tiebreak and len(values) == 1:
        # One value: max_by keeps a fixed-width buffer, so the dedupe runs as
        # a hash aggregate (a struct buffer forces a sort).
        out = base.agg(F.max_by(F.col(values[0]), F.col(tiebreak)).alias(values[0]))
        return out.select("_k", "_rt", F.struct(F.col(values[0])).alias("_r"))
    row = F.struct(*([F.col(tiebreak).alias("_tb")] if tiebreak else []), *[F.col(v) for v in values])
    out = base.agg(F.max(row).alias("_m"))
    return out.select("_k", "_rt", F.struct(*[F.col(f"_m.{v}").alias(v) for v in values]).alias("_r"))


def _bucket(c, bucket_s: float):
    return F.floor(c / F.lit(float(bucket_s)))


def _expand(df: DataFrame, left_cols: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"_l.{c}").alias(c) for c in left_cols],
                     *[F.col(f"_v.{v}").alias(v) for v in values])


def asof_broadcast(left: DataFrame, right: DataFrame, by: str, left_t: str,
                   right_t: str, values: Sequence[str], tiebreak: str | None = None,
                   bucket_s: float | None = None,
                   max_explode: int = C.ASOF_MAX_EXPLODE,
                   min_bucket_s: float = C.ASOF_MIN_BUCKET_SECONDS) -> DataFrame:
    """Plan A. Call only when the right side's size is checked (see ``asof_join``).

    Each key gets its own bucket width (its reading span over its reading
    count, at least ``min_bucket_s``) unless ``bucket_s`` is given. An
    interval is exploded over buckets of the lowest level at which it covers
    fewer than ``max_explode`` of them; a level's buckets are
    ``max_explode`` times as wide as those of the level below. The left side
    is probed by one equi-join per level, so bursts with long gaps between
    them cost no more than evenly spaced readings. Open-ended intervals (one
    per key) are probed by key. All broadcast tables are bounded by the
    reading count: per-key widths, and at most ``max_explode`` rows per
    reading over all levels.
    """
    t_type = common_time(left, left_t, right, right_t)
    r = dedupe_readings(right, by, right_t, values, tiebreak, t_type)
    # The right side is bounded by the caller's size check, so these per-key
    # aggregates and windows run over a bounded table.
    wk = Window.partitionBy("_k")
    if bucket_s:
        width = F.lit(float(bucket_s))
    else:
        span = (F.max("_rt").over(wk) - F.min("_rt").over(wk)).cast("double")
        width = F.greatest(F.lit(float(min_bucket_s)), span / F.count(F.lit(1)).over(wk))
    per = max_explode - 1
    ratio = (F.col("_next") - F.col("_rt")) / F.col("_bw")
    r = (r.withColumn("_next", F.lead("_rt").over(wk.orderBy("_rt")))
         .withColumn("_bw", width)
         .withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log(F.greatest(ratio, F.lit(1.0)) / per) / math.log(max_explode))).cast("int")))
    # Written once: every level reads this small table instead of deriving it anew.
    spark, path = left.sparkSession, scratch_path(left.sparkSession, "asof-readings")
    r.write.parquet(path)
    r = spark.read.schema(r.schema).parquet(path)
    widths = r.select("_k", "_bw").distinct()
    levels = sorted(x["_level"] for x in r.where(F.col("_next").isNotNull()).select("_level").distinct().collect())  # logarithmic in the span

    left_cols = left.columns
    lt = F.col(f"_l.{left_t}").cast(t_type)
    L = left.select(F.struct(*[F.col(c) for c in left_cols]).alias("_l"), F.col(by).alias("_lk"))
    wb = F.broadcast(widths.alias("wb"))
    j = (L.join(wb, F.col("_lk") == F.col("wb._k"), "left")
         .select("_l", "_lk", F.col("wb._bw").alias("_lw"), F.lit(None).cast(r.schema["_r"].dataType).alias("_v")))
    for level in [*levels, None]:
        if level is not None:
            scale = F.lit(float(max_explode ** level))
            part = (r.where(F.col("_next").isNotNull() & (F.col("_level") == level))
                    .select("_k", F.explode(F.sequence(F.floor(F.col("_rt") / (F.col("_bw") * scale)),
                                                       F.floor(F.col("_next") / (F.col("_bw") * scale)))).alias("_b"), "_rt", "_next", "_r"))
            s = F.broadcast(part.alias("s"))
            on = ((F.col("_lk") == F.col("s._k")) & (F.floor(lt / (F.col("_lw") * scale)) == F.col("s._b"))
                  & (F.col("s._rt") <= lt) & (lt < F.col("s._next")))
        else:
            s = F.broadcast(r.where(F.col("_next").isNull()).select("_k", "_rt", "_r").alias("s"))
            on = (F.col("_lk") == F.col("s._k")) & (F.col("s._rt") <= lt)
        j = j.join(s, on, "left").select("_l", "_lk", "_lw", F.coalesce(F.col("_v"), F.col("s._r")).alias("_v"))
    return _expand(j.select("_l", "_v"), left_cols, values)


def _union_sides(left: DataFrame, r: DataFrame, by: str, left_t: str) -> DataFrame:
    """Left rows (side 1) and deduped readings (side 0) in one frame."""
    left_struct = F.struct(*[F.col(c) for c in left.columns])
    l_type = left.select(left_struct.alias("s")).schema["s"].dataType
    r_type = r.schema["_r"].dataType
    t_type = r.schema["_rt"].dataType
    lside = left.select(F.col(by).alias("_k"), F.col(left_t).cast(t_type).alias("_t"),
                        F.lit(1).alias("_side"), left_struct.alias("_l"),
                        F.lit(None).cast(r_type).alias("_r"))
    rside = r.select("_k", F.col("_rt").alias("_t"), F.lit(0).alias("_side"),
                     F.lit(None).cast(l_type).alias("_l"), "_r")
    return lside.unionByName(rside)


def asof_union(left: DataFrame, right: DataFrame, by: str, left_t: str, right_t: str,
               values: Sequence[str], tiebreak: str | None = None) -> DataFrame:
    """Plan B: one sort per key. Readings sort before left rows at equal time."""
    r = dedupe_readings(right, by, right_t, values, tiebreak, common_time(left, left_t, right, right_t))
    u = _union_sides(left, r, by, left_t)
    w = (Window.partitionBy("_k").orderBy("_t", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_v", F.last("_r", ignorenulls=True).over(w)).where(F.col("_side") == 1)
    return _expand(u, left.columns, values)


def asof_bucketed(left: DataFrame, right: DataFrame, by: str, left_t: str, right_t: str,
                  values: Sequence[str], tiebreak: str | None = None,
                  bucket_s: float = C.ASOF_BUCKET_SECONDS) -> DataFrame:
    """Plan C: Plan B inside (key, bucket), then a carry-in across buckets.

    Pass 1 (the big one) sorts both sides inside (key, bucket) and carries
    the last reading forward. Left rows whose bucket has no earlier reading
    take the carry-in of their bucket: the newest reading of the key's
    earlier buckets. The carry-in is a small as-of problem solved per key
    over one row per bucket: the (key, bucket) pairs the left side uses (a
    two-column distinct over the left input) and the newest reading of each
    non-empty bucket. It is joined back on (key, bucket), the partitioning
    of pass 1, so the big side is not shuffled again. The left rows and the
    reduced readings are written to the shared folder first: each is derived
    once, and a lost executor re-reads files.
    """
    t_type = common_time(left, left_t, right, right_t)
    left = _written(left, "asof-left")
    r = _written(dedupe_readings(right, by, right_t, values, tiebreak, t_type), "asof-readings")
    u = _union_sides(left, r, by, left_t).withColumn("_b", _bucket(F.col("_t"), bucket_s))
    w1 = (Window.partitionBy("_k", "_b").orderBy("_t", "_side")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_c", F.last("_r", ignorenulls=True).over(w1))
    lpart = u.where(F.col("_side") == 1).select("_k", "_b", "_l", "_c")

    # Newest reading of each non-empty (key, bucket).
    # (one max_by per field: fixed-width buffers keep it a hash aggregate)
    tails = (r.withColumn("_b", _bucket(F.col("_rt"), bucket_s))
             .groupBy("_k", "_b")
             .agg(*[F.max_by(F.col(f"_r.{v}"), F.col("_rt")).alias(v) for v in values])
             .select("_k", "_b", F.struct(*[F.col(v) for v in values]).alias("_tail")))
    need = (left.where(F.col(by).isNotNull() & F.col(left_t).isNotNull())
            .select(F.col(by).alias("_k"), _bucket(F.col(left_t).cast(t_type), bucket_s).alias("_b"))
            .distinct())
    tail_type = tails.schema["_tail"].dataType
    x = (need.select("_k", "_b", F.lit(0).alias("_s"), F.lit(None).cast(tail_type).alias("_tail"))
         .unionByName(tails.select("_k", "_b", F.lit(1).alias("_s"), "_tail")))
    # A request sorts before the tail of its own bucket, so only earlier
    # buckets are carried in. Rows per key: buckets of its span.
    w2 = (Window.partitionBy("_k").orderBy("_b", "_s")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (x.withColumn("_in", F.last("_tail", ignorenulls=True).over(w2))
             .where(F.col("_s") == 0).select("_k", "_b", "_in"))
    out = (lpart.join(carry, on=["_k", "_b"], how="left")
           .select("_l", F.coalesce(F.col("_c"), F.col("_in")).alias("_v")))
    return _expand(out, left.columns, values)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reading_stats(right: DataFrame, by: str, right_t: str, values: Sequence[str] = ()) -> dict:
    """One small aggregate over the right side: rows, keys (approx.), time span, bytes of the values."""
    cols = [by, right_t, *values]
    text = [c for c in cols if right.schema[c].dataType.simpleString() in ("string", "binary")]
    wide = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0)) + F.lit(8 * len(cols) + 16)
    row = (right.where(F.col(by).isNotNull() & F.col(right_t).isNotNull())
           .agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(by).alias("keys"),
                F.min(right_t).alias("lo"), F.max(right_t).alias("hi"), F.coalesce(F.sum(wide), F.lit(0)).alias("bytes"))).first()
    return row.asDict()


def auto_bucket(stats: dict, min_bucket: float = C.ASOF_MIN_BUCKET_SECONDS) -> float:
    """Bucket width giving about one reading per key and bucket.

    Narrower buckets spread a hot key over more tasks; wider ones keep the
    carry-in tables (one row per bucket of each key's span) small. The
    reading density sets the balance.
    """
    n, keys = stats.get("n") or 0, max(stats.get("keys") or 1, 1)
    if not n or stats.get("lo") is None:
        return float(C.ASOF_BUCKET_SECONDS)
    span = float(stats["hi"] - stats["lo"]) or 1.0
    per_key = max(n / keys, 1.0)
    return min(max(float(min_bucket), span / per_key), float(C.ASOF_MAX_BUCKET_SECONDS))


def choose_plan(right: DataFrame, by: str, right_t: str,
                broadcast_max_rows: int = C.ASOF_BROADCAST_MAX_ROWS,
                max_explode: int = C.ASOF_MAX_EXPLODE, stats: dict | None = None) -> str:
    """Size check for Plan A, in rows and bytes: the broadcast holds at most max_explode rows per reading."""
    stats = stats or reading_stats(right, by, right_t)
    fits = (stats["n"] * max_explode <= broadcast_max_rows
            and stats.get("bytes", 0) * max_explode <= C.ASOF_BROADCAST_MAX_BYTES)
    return "broadcast" if fits else "bucketed"


def asof_join(left: DataFrame, right: DataFrame, by: str, left_t: str, right_t: str,
              values: Sequence[str], tiebreak: str | None = None, plan: str = "auto",
              bucket_s: float | None = None,
              broadcast_max_rows: int = C.ASOF_BROADCAST_MAX_ROWS,
              max_explode: int = C.ASOF_MAX_EXPLODE, stats: dict | None = None) -> DataFrame:
    """Backward as-of left join; output = left columns + ``values``.

    ``bucket_s=None`` sizes the time bucket from the readings' density.
    Both ``auto`` choices need one small aggregate over the right side
    (``reading_stats``; pass ``stats`` when already computed).
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"value columns already on the left side: {sorted(clash)}")
    if stats is None and (plan in ("auto", "broadcast") or (bucket_s is None and plan == "bucketed")):
        stats = reading_stats(right, by, right_t, values)
    if plan in ("auto", "broadcast"):
        # A requested broadcast is honoured only under the size bound; above
        # it the bucketed plan runs (same result, no broadcast).
        chosen = choose_plan(right, by, right_t, broadcast_max_rows, max_explode, stats)
        if plan == "broadcast" and chosen != "broadcast":
            log.warning("as-of: %d readings exceed the broadcast bound; using the bucketed plan",
                        stats["n"])
        plan = chosen
    if plan == "broadcast":  # per-key widths unless bucket_s is given
        return asof_broadcast(left, right, by, left_t, right_t, values, tiebreak,
                              bucket_s, max_explode)
    if plan == "union":
        return asof_union(left, right, by, left_t, right_t, values, tiebreak)
    if plan == "bucketed":
        if bucket_s is None:
            bucket_s = auto_bucket(stats) if stats else float(C.ASOF_BUCKET_SECONDS)
        return asof_bucketed(left, right, by, left_t, right_t, values, tiebreak, bucket_s)
    raise ValueError(f"unknown as-of plan {plan!r}")
