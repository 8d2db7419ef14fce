"""ST4 with keyed state: the newest N rows of a log, kept in the state store and read from it.

Each key's state is a list of at most N rows. One key for the whole log would
be one task, so rows are dealt to ``buckets`` keys by their id: the newest N of
the log are among the newest N of the buckets, and a reader merges these
(``buckets`` x N rows at most) with ``drift.latest_n``. A row that comes late,
or again with the same id, changes nothing that it should not: rows are ordered
by their own time, whatever batch they come in, and an id is held once.

No folder is written per batch; the store's own snapshots and clean-up bound
what is on disk. Readers see the state of the last finished batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kinelab import config as C
from kinelab.operators import drift

ORDER = ("timestamp", "event_id")
BUCKETS = 32
_STATE = "latest"


class Newest(StatefulProcessor):
    """The newest ``n`` rows of a key by ``order``, whose last column is the row's id."""

    def __init__(self, n: int, schema: T.StructType, order: Sequence[str]):
        self.n, self.schema, self.order = n, schema, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState(_STATE, self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.fieldNames()
        held = [tuple(r) for r in self.rows.get()]
        best = held
        at = [names.index(c) for c in self.order]
        for part in rows:
            top = part[names].sort_values(self.order, ascending=False).drop_duplicates(self.order[-1]).head(self.n)
            new = [tuple(None if pd.isna(x) else x for x in r) for r in top.astype(object).itertuples(index=False)]
            # an id keeps its newest row
            best = sorted({r[at[-1]]: r for r in sorted(best + new, key=lambda r: [r[i] for i in at])}.values(),
                          key=lambda r: [r[i] for i in at], reverse=True)[:self.n]
        if best != held:
            self.rows.put(best)
        yield pd.DataFrame({"bucket": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def keep_newest(log: DataFrame, n: int = C.LIVE_ROWS, columns: Sequence[str] = ("timestamp", C.LABEL, "event_id"),
                order: Sequence[str] = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """A stream that returns no rows and keeps the newest ``n`` of each bucket in its state.

    Rows without a value to order by are never among the newest.
    """
    rows = log.select(*columns)
    for c in order:
        rows = rows.where(F.col(c).isNotNull())
    return (rows.withColumn("bucket", F.pmod(F.xxhash64(order[-1]), F.lit(buckets)).cast("long")).groupBy("bucket")
            .transformWithStateInPandas(Newest(n, rows.schema, order), "bucket long", "Update", "None"))


def newest(spark: SparkSession, checkpoint: str, n: int = C.LIVE_ROWS, order: Sequence[str] = ORDER,
           require_full: bool = True) -> DataFrame:
    """The newest ``n`` rows as of the last finished batch of the stream with this checkpoint."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", _STATE).load()
             .select("list_element.*"))
    return drift.latest_n(state, n, order, require_full)
