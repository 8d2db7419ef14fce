"""ST2 with readings that arrive late: an as-of join of two streams that corrects itself.

Windows (closed ones, from ST1) and readings are two streams of one keyed
state machine. A window is labelled with the latest reading at or before its
start that is known, and emitted as version 0. A reading that comes later
relabels the windows from its time to the next reading's, and each one that
changes is emitted again with the next version. The newest version of a window
is the batch join over all that has arrived (``newest_labels``).

State per key is one row per window and per reading of the last ``keep_s``
seconds before the newest window, with one reading before these. Windows are
aggregates, so a key's state is bounded by time, not by its samples. What comes
later than ``keep_s`` corrects nothing.

A call to the state store and a call of the state machine cost far more than a
row, so keys are dealt to buckets, which are labelled at once, and the rows of
a bucket lie in the store as one table per ``SEGMENT_S``: a batch writes the
segments in which it changes something.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kinelab import config as C

VALUES = ("x", "y", "z")
#: Buckets of keys; a bucket's state passes through memory at once. Fixed as long as a stream's checkpoint is used.
BUCKETS = 256
#: Seconds of windows, or readings, in one table of a bucket's state.
SEGMENT_S = 7 * 86_400


class LateAsof(StatefulProcessor):
    """Versions of the labelled windows of the keys of one bucket."""

    def __init__(self, key: str, values: Sequence[str], keep_s: int):
        self.key, self.values, self.keep_s = key, list(values), keep_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getMapState("windows", "segment long", "rows binary")
        self.readings = handle.getMapState("readings", "segment long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        by = [self.key, "at"]
        windows = new.loc[new["is_window"], [*by, *self.values]].drop_duplicates(by)
        readings = new.loc[~new["is_window"], [*by, "reading", "has_tiebreak", "tiebreak"]]
        old_windows, old_readings = _stored(self.windows), _stored(self.readings)
        if old_windows is not None:
            windows = pd.concat([old_windows, windows], ignore_index=True).drop_duplicates(by)
        else:
            windows = windows.assign(reading=float("nan"), version=float("nan"))
        fresh = windows["version"].isna()
        windows["version"] = windows["version"].fillna(-1).astype("int64")
        # Of equal times the largest tie-break wins, then the largest value; missing ones lose.
        known = readings if old_readings is None else pd.concat([old_readings, readings], ignore_index=True)
        known = known.assign(has_value=known["reading"].notna()).sort_values(["has_tiebreak", "tiebreak", "has_value", "reading"], kind="stable")
        known = known.drop_duplicates(by, keep="last").drop(columns="has_value")

        codes = pd.factorize(pd.concat([windows[self.key], known[self.key]], ignore_index=True))[0]
        windows, known = windows.assign(_k=codes[:len(windows)], _fresh=fresh).sort_values("at"), known.assign(_k=codes[len(windows):]).sort_values("at")
        found = pd.merge_asof(windows[["_k", "at"]], known[["_k", "at", "reading"]], on="at", by="_k")["reading"].to_numpy()
        was = windows["reading"].to_numpy()
        changed = windows["_fresh"].to_numpy() | ~((found == was) | (pd.isna(found) & pd.isna(was)))
        windows["reading"] = found
        windows["version"] += changed
        out = windows[changed].sort_values(["_k", "at"], kind="stable")

        # Windows before the horizon of their key are forgotten, and readings before the newest one that is not after it.
        horizon = windows.groupby("_k")["at"].max() - self.keep_s
        kept = windows[windows["at"] >= windows["_k"].map(horizon)]
        limit = known["_k"].map(horizon)
        before = known[known["at"] <= limit].groupby("_k")["at"].max()
        first = known["_k"].map(before)
        left = known[first.isna() | (known["at"] >= first)]
        _store(self.windows, by, old_windows, kept[[*by, *self.values, "reading", "version"]])
        _store(self.readings, by, old_readings, left[[*by, "reading", "has_tiebreak", "tiebreak"]])
        out = out[[*by, *self.values, "reading", "version"]].set_axis([self.key, C.WINDOW_START, *self.values, C.READING, "version"], axis=1)
        yield out.astype({C.WINDOW_START: "int64", "version": "int32", **{c: "float64" for c in (*self.values, C.READING)}})

    def close(self) -> None:
        pass


def _stored(state) -> pd.DataFrame | None:
    """The rows of all segments, with the number of the segment; None if there is none."""
    parts = [pa.ipc.open_stream(bytes(rows)).read_all().to_pandas().assign(_segment=segment) for (segment,), (rows,) in state.iterator()]
    return pd.concat(parts, ignore_index=True) if parts else None


def _store(state, by: Sequence[str], old: pd.DataFrame | None, rows: pd.DataFrame) -> None:
    """Writes the segments whose rows are not the old ones."""
    rows = rows.sort_values(list(by))
    parts = dict(iter(rows.groupby(rows["at"] // SEGMENT_S)))
    before = {} if old is None else dict(iter(old.drop(columns="_segment").groupby(old["_segment"])))
    for segment, part in parts.items():
        part = part.reset_index(drop=True)
        if segment not in before or not part.equals(before[segment].reset_index(drop=True)):
            table = pa.Table.from_pandas(part, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            state.updateValue((int(segment),), (sink.getvalue().to_pybytes(),))
    for segment in before.keys() - parts.keys():
        state.removeKey((int(segment),))


def label_versions(windows: DataFrame, readings: DataFrame, keep_s: int, values: Sequence[str] = VALUES,
                   tiebreak: str | None = "tiebreak", buckets: int = BUCKETS) -> DataFrame:
    """key, window start, values, reading, version of two streams: windows and readings (key, time, value).

    Rows without a key or time are left out. ``buckets`` is how many groups the
    keys are dealt to; no change of it fits an older checkpoint.
    """
    key_type = windows.schema[C.KEY].dataType.simpleString()
    none = lambda kind: F.lit(None).cast(kind)
    w = windows.select(C.KEY, F.lit(True).alias("is_window"), F.col(C.WINDOW_START).cast("long").alias("at"),
                       *[F.col(c).cast("double").alias(c) for c in values], none("double").alias("reading"),
                       F.lit(False).alias("has_tiebreak"), F.lit(0).cast("long").alias("tiebreak"))
    tie = F.col(tiebreak).cast("long") if tiebreak else none("long")  # no missing numbers reach pandas, which would make them doubles
    r = readings.select(F.col(C.KEY).cast(key_type).alias(C.KEY), F.lit(False).alias("is_window"), F.col(C.READING_TIME).cast("long").alias("at"),
                        *[none("double").alias(c) for c in values], F.col(C.READING).cast("double").alias("reading"),
                        tie.isNotNull().alias("has_tiebreak"), F.coalesce(tie, F.lit(0)).alias("tiebreak"))
    both = w.unionByName(r).where(F.col(C.KEY).isNotNull() & F.col("at").isNotNull())
    both = both.withColumn("_bucket", F.pmod(F.xxhash64(C.KEY), F.lit(buckets)))
    schema = f"{C.KEY} {key_type}, {C.WINDOW_START} long, " + ", ".join(f"{c} double" for c in values) + f", {C.READING} double, version int"
    return both.groupBy("_bucket").transformWithStateInPandas(LateAsof(C.KEY, values, keep_s), schema, "Append", "None")


def newest_labels(versions: DataFrame) -> DataFrame:
    """The newest version of each window, without the version."""
    rest = [c for c in versions.columns if c not in (C.KEY, C.WINDOW_START, "version")]
    return (versions.groupBy(C.KEY, C.WINDOW_START).agg(F.max_by(F.struct(*rest), "version").alias("v"))
            .select(C.KEY, C.WINDOW_START, "v.*"))
