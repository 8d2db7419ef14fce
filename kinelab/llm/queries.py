"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelab.llm.common import documents
from kinelab.llm.oracles import SQL  # noqa: F401
from kinelab.session import scratch_path


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.warc import read_archives, write_archives
    path = scratch_path(spark, "archives")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return (read_archives(spark, manifest, path, keep_payload=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.quality import classify
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.sharding import balanced_shards
    out = balanced_shards(documents(spark, sf_dir), n_shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.licenses import scan
    return scan(documents(spark, sf_dir))


def op5_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.vectordup import vector_links
    return vector_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.neighbours import nearest
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.mixing import mixture
    return mixture(documents(spark, sf_dir))[0]


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.packing import pack
    return pack(documents(spark, sf_dir), vocabulary())


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.neardup import near_duplicates
    return near_duplicates(documents(spark, sf_dir))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.wrappers import extract
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.periodic import periodic_runs, run_digests, with_planted_tails
    return run_digests(periodic_runs(with_planted_tails(documents(spark, sf_dir))))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.pieces import encode_pieces, piece_digests
    return piece_digests(encode_pieces(documents(spark, sf_dir), piece_model()))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinelab.llm.hardneg import hard_negatives, integer_vectors
    rows = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 256)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_shards": op3_shards,
    "op4_licenses": op4_licenses,
    "op5_vector_links": op5_vector_links,
    "op6_neighbours": op6_neighbours,
    "op7_mixture": op7_mixture,
    "op8_packing": op8_packing,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_main_text": op10_main_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_pieces": op12_pieces,
    "op13_hard_negatives": op13_hard_negatives,
}
