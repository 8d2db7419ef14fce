"""A13 on a stream: an alert that fires once its condition has held "for" a while, and resolves.

The windows of ST6 (errors per job and instance, emitted when they are closed)
go into a keyed state machine: a first window with errors makes an alert
*pending*, as many further ones without a gap make it *firing*, and the first
window without errors ends it. That window never arrives as a row; an
event-time timer at its end stands for it. A pending alert that ends leaves
nothing, a firing one *resolves*.

State per (job, instance) is one row: the run's first and last window and
whether it has fired. The aggregation before it runs in the JVM, so only
windows with errors reach Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kinelab.functions import not_matching
CHANGES = "job string, instance string, state string, at_s long, start_s long, end_s long, n_windows long"


class Alert(StatefulProcessor):
    """State changes of one (job, instance)."""

    def __init__(self, window_s: int, for_s: int):
        self.window_s, self.for_s = window_s, for_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "start_s long, last_s long, fired boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = sorted(w for part in rows for w in part["window_start_s"].tolist())
        old = self.run.get() if self.run.exists() else None
        start, last, fired = old or (None, None, False)
        changes = []
        for w in windows:
            if start is not None and w != last + self.window_s:
                changes += self._ended(start, last, fired)
                start = None
            if start is None:
                start, fired = w, False
            last = w
            if not fired and last - start >= self.for_s:
                fired = True
                changes.append(("firing", last + self.window_s, start, last))
        if old is not None:
            self.handle.deleteTimer(self._next_end(old[1]))
        self.run.update((start, last, fired))
        self.handle.registerTimer(self._next_end(last))
        yield self._rows(key, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, last, fired = self.run.get()
        self.run.clear()
        yield self._rows(key, self._ended(start, last, fired))

    def close(self) -> None:
        pass

    def _next_end(self, last: int) -> int:
        """The end of the window after the last one with errors, in milliseconds: by then it has arrived or has none."""
        return 1000 * (last + 2 * self.window_s)

    def _ended(self, start: int, last: int, fired: bool) -> list[tuple]:
        return [("resolved", last + self.window_s, start, last)] if fired else []

    def _rows(self, key, changes: list[tuple]) -> pd.DataFrame:
        job, instance = key
        return pd.DataFrame([(job, instance, state, at, start, last + self.window_s, (last - start) // self.window_s + 1)
                             for state, at, start, last in changes],
                            columns=["job", "instance", "state", "at_s", "start_s", "end_s", "n_windows"]).astype(
            {"at_s": "int64", "start_s": "int64", "end_s": "int64", "n_windows": "int64"})


def alert_changes(http: DataFrame, window_s: int, for_s: int, delay: str, ok_pattern: str = "200") -> DataFrame:
    """job, instance, state ("firing" or "resolved"), at_s, start_s, end_s, n_windows of a streamed HTTP log.

    A run of n windows with errors has held for (n - 1) * ``window_s`` after
    its first one, as in ``opsmetrics.sustained``; a change carries the run
    up to its time. ``delay`` is how late a log row may come.
    """
    errors = (http.withWatermark("ts", delay)
              .groupBy(F.window("ts", f"{window_s} seconds").alias("w"), "job", "instance")
              .agg(F.count_if(not_matching("code", ok_pattern)).alias("errors")).where("errors > 0")
              .select("job", "instance", F.window_time("w").alias("ts"), F.unix_seconds(F.col("w.start")).alias("window_start_s")))
    return (errors.groupBy("job", "instance")
            .transformWithStateInPandas(Alert(window_s, for_s), CHANGES, "Append", "EventTime"))
