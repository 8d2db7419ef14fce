"""The clustered layout: few files, parts rewritten alone, files picked by key ranges."""

import pytest
from pyspark.sql import functions as F

from kinelab.sources import clustered
from kinelab.sources.clustered import files_of, manifest, read_clustered, write_clustered

DAY = 86_400


def rows_of(spark, n=4000, keys=500, days=4):
    return spark.range(n).select((F.col("id") % keys).alias("pid"), ((F.col("id") % days) * DAY + F.col("id") % 1000).alias("time"), F.col("id").alias("v"))


def written(spark, path):
    return {f: tuple(r) for f, *r in spark.read.parquet(f"{path}/data").select(F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")).distinct().collect()}


@pytest.fixture
def table(spark, scratch):
    path = scratch("clustered")
    write_clustered(rows_of(spark), path)
    return path


def test_files_follow_bytes_not_keys(spark, table):
    assert len(written(spark, table)) <= 4 + 4  # days and shuffle partitions, 500 keys
    assert sorted(map(tuple, read_clustered(spark, table).collect())) == sorted(map(tuple, rows_of(spark).collect()))
    m = manifest(spark, table)
    assert m.agg(F.sum("rows")).first()[0] == 4000 and {f for f in written(spark, table)} == {r["file"] for r in m.collect()}


def test_a_key_is_read_from_few_files(spark, scratch):
    path = scratch("keys")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many small ranges
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        write_clustered(rows_of(spark, days=2), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    every = written(spark, path)
    some = files_of(spark, path, [123])
    assert len(every) >= 30 and len(some) <= 4
    got = read_clustered(spark, path, keys=[123, 7])
    assert sorted(r["v"] for r in got.collect()) == sorted(r["v"] for r in rows_of(spark, days=2).where("pid in (123, 7)").collect())
    assert len(got.inputFiles()) <= 8
    assert read_clustered(spark, path, keys=[10**9]).count() == 0


def test_a_rewritten_day_leaves_the_others(spark, table, scratch):
    before = written(spark, table)
    again = scratch("day")
    read_clustered(spark, table).where(F.col("time") < DAY).withColumn("v", F.col("v") + 10**6).write.parquet(again)
    write_clustered(spark.read.parquet(again), table)
    after = written(spark, table)
    kept = {f: t for f, t in before.items() if "_part=0" not in f}
    assert kept.items() <= after.items() and len(kept) < len(before)
    assert not {f for f in before if "_part=0" in f} & after.keys()
    want = sorted((r["pid"], r["time"], r["v"] + (10**6 if r["time"] < DAY else 0)) for r in rows_of(spark).collect())
    assert sorted(map(tuple, read_clustered(spark, table).collect())) == want
    assert sorted(r["v"] for r in read_clustered(spark, table, keys=[8]).collect()) == sorted(v for p, _, v in want if p == 8)
    assert manifest(spark, table).count() == len(after)


def test_the_manifest_is_only_a_hint(spark, table):
    """Data written without its manifest entry is read; entries of files that are gone are not."""
    extra = spark.createDataFrame([(8, 99 * DAY, -1)], "pid long, time long, v long").withColumn(clustered.PART, F.lit(99))
    extra.write.mode("append").partitionBy(clustered.PART).parquet(f"{table}/data")
    assert -1 in {r["v"] for r in read_clustered(spark, table, keys=[8]).collect()}
    gone = spark.createDataFrame([("file:/nowhere.parquet", 1, 8, 8, 0, 50)], "file string, rows long, low long, high long, nulls long, _part long")
    gone.write.mode("append").partitionBy(clustered.PART).parquet(f"{table}/manifest")
    assert read_clustered(spark, table, keys=[8]).count() == rows_of(spark).where("pid = 8").count() + 1


def test_rows_without_key_or_time(spark, scratch):
    path = scratch("nulls")
    rows = [(None, 5, 1), (3, None, 2), (None, None, 3), (4, 6, 4)]
    write_clustered(spark.createDataFrame(rows, "pid long, time long, v long"), path)
    assert sorted(map(tuple, read_clustered(spark, path).collect()), key=str) == sorted(rows, key=str)
    assert sorted(r["v"] for r in read_clustered(spark, path, keys=[None]).collect()) == [1, 3]
    assert sorted(r["v"] for r in read_clustered(spark, path, keys=[3]).collect()) == [2]
    write_clustered(spark.createDataFrame([(9, None, 7)], "pid long, time long, v long"), path)
    assert sorted(r["v"] for r in read_clustered(spark, path).collect()) == [1, 4, 7]
