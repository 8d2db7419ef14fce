"""Sinks of streams that do not grow for ever: batch folders fold into segments, old versions go.

A sink is a folder of ``batch_id=N`` folders, one per micro-batch. A segment
``segments/from=A-to=B`` holds the rows of the batches A to B in files of about
``FILE_BYTES``. ``FAN`` batches make a segment, ``FAN`` neighbouring segments of
one level a segment of the next: a row is rewritten once per level, and at most
``FAN`` folders per level are left, so their number grows with the logarithm of
the batches.

A folder counts once its write has ended (Spark's ``_SUCCESS`` is the marker).
Readers take the widest ended segments, and the batches that these do not
cover; a segment being written is not seen, and neither is what it covers seen
twice. What a segment covers is deleted only ``grace_s`` seconds after the
segment has ended, so that readers which planned before can finish. The newest
batch, which a restarted stream may write again, is never folded, and a batch
that is covered already is not written again.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

FAN = 8
FILE_BYTES = 128 << 20
GRACE_S = 3_600


class Part(NamedTuple):
    """A folder of the sink: the batches ``low`` to ``high``, and the time at which its write ended (ms)."""

    low: int
    high: int
    path: str
    ended: int


class _Folder:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.spark = spark.sparkContext._jvm, spark
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path)] if self.fs.exists(self.path) else []

    def ended(self, name: str) -> int | None:
        marker = self.jvm.org.apache.hadoop.fs.Path(self.path, f"{name}/_SUCCESS")
        return self.fs.getFileStatus(marker).getModificationTime() if self.fs.exists(marker) else None

    def size(self) -> int:
        return self.fs.getContentSummary(self.path).getLength()

    def delete(self, name: str) -> None:
        self.fs.delete(self.jvm.org.apache.hadoop.fs.Path(self.path, name), True)


def parts(spark: SparkSession, path: str) -> list[Part]:
    """All folders whose write has ended, batches and segments."""
    out = []
    for sub, pattern in (("", r"batch_id=(\d+)()"), ("/segments", r"from=(\d+)-to=(\d+)")):
        folder = _Folder(spark, path + sub)
        for name in folder.names():
            m = re.fullmatch(pattern, name)
            ended = folder.ended(name) if m else None
            if ended is not None:
                out.append(Part(int(m[1]), int(m[2] or m[1]), f"{path}{sub}/{name}", ended))
    return out


def _covers(a: Part, b: Part) -> bool:
    """Whether ``a`` holds all of ``b`` and is another folder; of equal ranges the segment counts."""
    return a.path != b.path and a.low <= b.low and b.high <= a.high and ((a.low, a.high) != (b.low, b.high) or "/segments/" in a.path)


def current(found: list[Part]) -> list[Part]:
    """The folders that together hold each batch once, in order."""
    return sorted(p for p in found if not any(_covers(q, p) for q in found))


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all finished batches."""
    paths = [p.path for p in current(parts(spark, path))]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def fold(spark: SparkSession, path: str, schema, fan: int = FAN) -> None:
    """Fold what is due: ``fan`` neighbouring folders of one level into one of the next, the newest batch apart."""
    while True:
        now = current(parts(spark, path))
        level = lambda p: round(math.log(p.high - p.low + 1, fan))
        due = now[:-1]
        run = next((due[i:i + fan] for i in range(len(due) - fan + 1)
                    if len({level(p) for p in due[i:i + fan]}) == 1), None)
        if run is None:
            return
        size = sum(_Folder(spark, p.path).size() for p in run)
        rows = spark.read.schema(schema).parquet(*[p.path for p in run])
        (rows.coalesce(max(1, -(-size // FILE_BYTES))).write.mode("overwrite")
         .parquet(f"{path}/segments/from={run[0].low}-to={run[-1].high}"))


def clean(spark: SparkSession, path: str, grace_s: float = GRACE_S) -> None:
    """Delete the folders that a segment has covered for ``grace_s`` seconds."""
    found, now = parts(spark, path), spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    for p in found:
        if any(_covers(q, p) and q.ended + 1000 * grace_s <= now for q in found):
            _Folder(spark, p.path.rsplit("/", 1)[0]).delete(p.path.rsplit("/", 1)[1])


def compacting_writer(path: str, fan: int = FAN, grace_s: float = GRACE_S) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: a folder per batch, folded and cleaned up as it goes."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not any(p.low <= batch_id <= p.high and "/segments/" in p.path for p in parts(spark, path)):
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        fold(spark, path, batch.schema, fan)
        clean(spark, path, grace_s)
    return write


def clean_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` finished versions of a complete-mode sink (``jobs.version_writer``)."""
    folder = _Folder(spark, path)
    ended = sorted(int(n[8:]) for n in folder.names() if re.fullmatch(r"version=\d+", n) and folder.ended(n) is not None)
    for v in ended[:-keep]:
        folder.delete(f"version={v}")
