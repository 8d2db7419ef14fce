"""Parquet stage tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelab import config as C

#: Tasks a core that list the folders of a table; Spark's default is a task per folder up to 10,000, each shorter than its dispatch.
LISTING_TASKS = 4


def write_partitioned(df: DataFrame, path: str, key: str = C.KEY, order: str | None = "time",
                      num_partitions: int | None = None) -> None:
    """S3: overwrite, one folder per key.

    Range-partitioning on (key, time) instead of hashing on the key: a key
    holding a third of the rows is split across several writer tasks, and
    each task still writes only a few key folders. The range partitioner
    samples its input once, so pass a written (or cheap) input.
    """
    cols = [key] + ([order] if order and order in df.columns else [])
    # The session's shuffle partitions, which the deployment sizes for its data:
    # without a count, adaptive execution merges partitions by bytes, and one
    # task then writes thousands of small key folders one after another.
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *[F.col(c) for c in cols])
     .write.mode("overwrite").partitionBy(key).parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     key: str = C.KEY) -> DataFrame:
    """Parquet with partition discovery; a filter on ``key`` prunes folders.

    With a schema, the key column gets the declared type (a key such as
    '0042' would otherwise be inferred as a number). The folders are listed
    here, by ``LISTING_TASKS`` tasks a core at most.
    """
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    with few_listing_tasks(spark):
        return reader.parquet(path)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders of the tables opened inside are listed by at most ``LISTING_TASKS`` tasks a core."""
    conf = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(conf)
    spark.conf.set(conf, min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def write_stage(df: DataFrame, path: str) -> None:
    """Stage table overwrite."""
    df.write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the path is a folder, in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether the path is one of the file system that is mounted on the machines."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
