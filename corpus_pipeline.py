"""Corpus pipeline: quality, near-duplicates, mixture, packing.

Each stage works on all that its predecessor kept and returns the columns of
documents; the last returns the packed pieces. Stages are handed on as written
Parquet. No stage but the mixture is expressible in SQL (a trained network,
transitive near-duplicate groups, best-fit packing), so ``ORACLE_SQL`` is None
and ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinelab.llm.common import documents, staged
from kinelab.llm.mixing import mixed_documents
from kinelab.llm.neardup import one_of_each
from kinelab.llm.packing import pack
from kinelab.llm.quality import accepted
from kinelab.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; texts decide, not ids."""
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents and their places in sequences."""
    return pack(docs, vocabulary())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicate),
    ("mixture", mixture),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
