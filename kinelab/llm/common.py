"""Small Spark helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinelab.session import scratch_path

#: Records and bytes per Arrow batch; keeps a batch of very long texts small.
ARROW_ROWS, ARROW_BYTES = 512, 16 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder once and read it back.

    Cuts the lineage: a lost executor re-reads files and recomputes nothing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
