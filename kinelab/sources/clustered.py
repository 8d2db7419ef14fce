"""S3 and S4 for many keys: files clustered by key inside parts of time, and a manifest of their key ranges.

One folder per key makes as many files as keys. Here the folders are parts of
time (a day, say), rows are range-partitioned and sorted by (part, key, time)
before they are written, and adaptive execution merges neighbouring ranges up
to its target size: the number of files follows the bytes and the parts.

* A file holds a short range of keys, which the manifest (a small table: file,
  part, rows, smallest and largest key) tells. A read of a few keys opens only
  the files whose range may hold one, and inside them row groups by statistics.
* A rewrite replaces the folders of the parts that it writes, and no others.

The manifest is a hint, never the truth: files that it does not list are read,
listed ones that are gone are not, so a write that ended between data and
manifest costs speed only. ``write_partitioned`` (a folder per key) stays for
readers that need that layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelab import config as C

PART = "_part"
PART_S = 86_400


def write_clustered(df: DataFrame, path: str, key: str = C.KEY, time: str = "time", part_s: float = PART_S) -> None:
    """Write ``df``, replacing the parts of time (``part_s`` units of ``time``) that it has rows in.

    The range partitioner samples its input once, so pass a written (or cheap) input.
    """
    order = [F.col(PART), F.col(key), F.col(time)]
    rows = df.withColumn(PART, F.floor(F.col(time) / part_s))
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(_data(path)))
    _note(rows.sparkSession, path, key, rows.select(PART).distinct())


def _data(path: str) -> str:
    return f"{path}/data"


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their part and file; the part has a fixed type."""
    return (spark.read.parquet(_data(path)).withColumn(PART, F.col(PART).cast("long"))
            .withColumn("_file", F.col("_metadata.file_path")))


def _note(spark: SparkSession, path: str, key: str, parts: DataFrame) -> None:
    """The manifest of the parts just written; a scan of their key column alone."""
    new = _stored(spark, path).join(parts, PART, "left_semi")
    (new.groupBy(PART, F.col("_file").alias("file"))
     .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.col(key).isNull()).alias("nulls"))
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{path}/manifest"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, rows, low, high, nulls, part of the files as last written."""
    return spark.read.parquet(f"{path}/manifest").withColumn(PART, F.col(PART).cast("long"))


def files_of(spark: SparkSession, path: str, keys: Sequence) -> list[str]:
    """The files that may hold one of ``keys``."""
    there = spark.createDataFrame([(_plain(f), f) for f in spark.read.parquet(_data(path)).inputFiles()], "name string, file string")
    hit = F.lit(False)
    for k in keys:
        hit = hit | (F.col("nulls") > 0 if k is None else F.lit(k).between(F.col("low"), F.col("high")))
    noted = manifest(spark, path).select(F.regexp_replace("file", "^file:/+", "/").alias("name"), hit.alias("hit"))
    kept = there.join(noted, "name", "left").where(F.coalesce("hit", F.lit(True)))
    return sorted(r["file"] for r in kept.select("file").collect())


def _plain(uri: str) -> str:
    """Local paths have several spellings."""
    from re import sub
    return sub("^file:/+", "/", uri)


def read_clustered(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str = C.KEY,
                   keys: Sequence | None = None) -> DataFrame:
    """The rows, or those of ``keys`` alone (from the files that may hold one); columns cast to ``schema``.

    Filters on times or keys prune folders and row groups in either case.
    """
    if keys is None:
        rows = spark.read.parquet(_data(path))
    else:
        files = files_of(spark, path, keys)
        reader = spark.read.option("basePath", _data(path))
        rows = reader.parquet(*files) if files else spark.read.parquet(_data(path)).limit(0)
        wanted = F.col(key).isin([k for k in keys if k is not None])
        rows = rows.where(wanted | F.col(key).isNull() if None in keys else wanted)
    rows = rows.drop(PART)
    return rows if schema is None else rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
