"""S8 for documents of any size: one column-oriented JSON document, read by many tasks.

A document {column: {row label: value}} is text without line feeds that a
reader could cut at. It is cut at commas instead, at any byte range:

1. pieces between commas whose string ends in a later piece are put together
   (``records.assembled``; the state of a split is whether it starts inside a string),
2. each piece is matched against the grammar of flat documents: what it opens
   (a document, a column), its entry, and what it closes,
3. the column of an entry and the number of its document come from all pieces
   before it: a running value inside each split, carried over a file's splits
   (one row each),
4. entries are grouped by (file, document, row label) into rows.

A label that a column lacks gives NULL, the last of equal labels counts, and
labels of different documents stay apart.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelab import config as C
from kinelab.session import scratch_path
from kinelab.sources.records import assembled

_STRING = r'"((?:[^"\\]|\\.)*+)"'
#: A piece: {? "column": {? "label": value? }? }?
_PIECE = (r"(?s)^\s*(\{)?\s*(?:" + _STRING + r"\s*:\s*(\{))?\s*(?:" + _STRING + r'\s*:\s*("(?:[^"\\]|\\.)*+"|[^\s{}\[\]",:]+))?\s*(\})?\s*(\})?\s*$')
#: Between two documents; a raw line feed is never inside a string.
_BETWEEN = r"(?<=\})\s*\n\s*(?=\{)"

LOG_COLUMNS = {"timestamp": "bigint", C.LABEL: "boolean"}


class ParsedLog(NamedTuple):
    """Rows (row, columns...) and the pieces (file, line) that are no part of a flat document."""

    rows: DataFrame
    rejected: DataFrame


def _plain(text: Column) -> Column:
    """The text of a JSON string's inside."""
    return F.when(text.contains("\\"), F.from_json(F.concat(F.lit('["'), text, F.lit('"]')), "array<string>")[0]).otherwise(text)


def _typed(raw: Column, kind: str) -> Column:
    quoted = raw.startswith('"')
    text = F.when(raw == "null", None).when(quoted, _plain(F.substring(raw, F.lit(2), F.length(raw) - 2))).otherwise(raw)
    if kind == "bigint":
        return F.coalesce(text.try_cast("bigint"), F.floor(text.try_cast("double")).try_cast("bigint"))
    return text if kind == "string" else text.try_cast(kind)


def parse_column_documents(spark: SparkSession, path: str, columns: Mapping[str, str] | None = None,
                           split_bytes: int | None = None) -> ParsedLog:
    """The rows of all column-oriented documents below ``path``; every split of a file is a task.

    ``split_bytes`` sets the split size for this read (default: the session's).
    """
    columns = columns or LOG_COLUMNS
    pieces = (spark.read.option("lineSep", ",").text(path)
              .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                      F.monotonically_increasing_id().alias("n")))
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), '[^"]', ""))
    entries = scratch_path(spark, "json-pieces")
    with _split_size(spark, split_bytes):
        whole = assembled(pieces, (quotes % 2).cast("int"), (1 - quotes % 2).cast("int"), ",")
        parts = whole.rows.select("file", "at", "n", F.posexplode(F.split("value", _BETWEEN)).alias("k", "part")).where(F.trim("part") != "")
        group = lambda i: F.regexp_extract("part", _PIECE, i)
        fits = F.regexp_like("part", F.lit(_PIECE))
        in_split = Window.partitionBy("file", "at").orderBy("n", "k").rowsBetween(Window.unboundedPreceding, 0)
        (parts.withColumn("fits", fits)
         .withColumns({"opens": F.col("fits") & (group(1) != ""), "column": F.when(F.col("fits") & (group(3) != ""), group(2)),
                       "label": group(4), "raw": group(5)})
         .withColumns({"documents": F.sum(F.col("opens").cast("int")).over(in_split),
                       "here": F.last("column", ignorenulls=True).over(in_split)})
         .select("file", "at", "n", "k", "fits", "documents", "here", "label", "raw", F.when(~F.col("fits"), F.col("part")).alias("part"))
         .write.parquet(entries))
        broken_path = scratch_path(spark, "json-broken")
        whole.broken.write.parquet(broken_path)
    found = spark.read.parquet(entries)

    splits = found.groupBy("file", "at").agg(F.max("documents").alias("documents"), F.max_by("here", F.struct("n", "k")).alias("last"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("file", "at", F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("earlier"),
                            F.last("last", ignorenulls=True).over(before).alias("open"))
    placed = (found.where(F.col("fits") & (F.col("raw") != "")).join(carried, ["file", "at"])
              .select("file", "at", "n", "k", (F.col("earlier") + F.col("documents")).alias("document"),
                      _plain(F.coalesce("here", "open")).alias("column"), _plain(F.col("label")).alias("row"), "raw"))
    order = F.struct("at", "n", "k")
    values = [F.max_by(F.when(F.col("column") == c, F.col("raw")), F.when(F.col("column") == c, order)).alias(f"_{i}") for i, c in enumerate(columns)]
    rows = (placed.where(F.col("column").isin(*columns)).groupBy("file", "document", "row").agg(*values)
            .select("row", *[_typed(F.col(f"_{i}"), kind).alias(c) for i, (c, kind) in enumerate(columns.items())]))
    rejected = found.where(~F.col("fits")).select("file", F.col("part").alias("line"))
    return ParsedLog(rows, rejected.unionByName(spark.read.schema(whole.broken.schema).parquet(broken_path)))


class _split_size:
    """The split size of file scans while a block runs."""

    KEYS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def __init__(self, spark: SparkSession, size: int | None):
        self.conf, self.size = spark.conf, size

    def __enter__(self) -> None:
        if self.size:
            self.old = [self.conf.get(k) for k in self.KEYS]
            for k in self.KEYS:
                self.conf.set(k, str(self.size))

    def __exit__(self, *_) -> None:
        if self.size:
            for k, v in zip(self.KEYS, self.old):
                self.conf.set(k, v)


def write_column_document(log: DataFrame, path: str, row_id: str, columns: Mapping[str, str] | None = None) -> None:
    """The whole log as one document in one file: columns one after another, rows by the unique whole number ``row_id``.

    The entries are sorted by many tasks into a file for each range. A single file has a single writer,
    which streams these in order and sorts nothing.
    """
    names = list(columns or LOG_COLUMNS)
    rid, last = F.col(row_id), len(names) - 1
    lo, hi = log.agg(F.min(rid), F.max(rid)).first()
    if lo is None:
        empty = ",".join(f'"{c}":{{}}' for c in names)
        log.sparkSession.createDataFrame([(f"{{{empty}}}",)], "value string").write.text(path)
        return
    as_json = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r'(?s)^\{"v":(.*)\}$', 1)
    entries = log.select(rid.alias("rid"), F.posexplode(F.array(*[F.struct(F.lit(c).alias("c"), as_json(c).alias("v")) for c in names])).alias("i", "x"))
    head = F.when(F.col("rid") == lo, F.concat(F.when(F.col("i") == 0, "{").otherwise(""), F.lit('"'), F.col("x.c"), F.lit('":{'))).otherwise("")
    tail = F.when(F.col("rid") < hi, ",").when(F.col("i") < last, "},").otherwise("}}")
    spark = log.sparkSession
    ranges = scratch_path(spark, "column-entries")
    (entries.orderBy("i", "rid")
     .select(F.concat(head, F.lit('"'), F.col("rid").cast("string"), F.lit('":'), F.col("x.v"), tail).alias("value"))
     .write.text(ranges))
    in_order = [spark.read.text(f) for f in sorted(spark.read.text(ranges).inputFiles())]
    reduce(DataFrame.union, in_order).coalesce(1).write.text(path)
