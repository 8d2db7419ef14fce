"""The corpus pipeline: each stage's decisions take effect."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from kinelab.llm.common import documents, staged
from kinelab.llm.mixing import mixture
from kinelab.llm.neardup import near_duplicates

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "mixture", "packing"]
    docs = documents(spark, SF)
    kept = staged(P.quality(spark, docs, SF), "t-quality")
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    assert sum(i in left for i, q in labels.items() if q == 1) >= 0.99 * sum(q == 1 for q in labels.values())
    assert sum(i in left for i, q in labels.items() if q == 0) <= 0.2 * sum(q == 0 for q in labels.values())

    alone = staged(P.near_duplicate(spark, kept, SF), "t-near")
    assert alone.columns == docs.columns
    groups = {r["doc_id"]: r["component_id"] for r in near_duplicates(kept).collect()}
    assert sorted(r["doc_id"] for r in alone.collect()) == sorted(set(groups.values())) and alone.count() < kept.count()

    mixed = staged(P.mixture(spark, alone, SF), "t-mix")
    assert mixed.columns == docs.columns
    whole = {r["doc_id"]: r["text"] for r in alone.collect()}
    rows = mixed.collect()
    assert all(r["text"] == whole[r["doc_id"]] for r in rows)  # no text is cut
    taken = {r["doc_id"]: r for r in mixture(alone)[0].collect()}
    total, target = sum(len(r["text"].split()) for r in rows), sum(r["taken"] for r in taken.values())
    assert abs(total - target) <= 0.05 * target

    packed = P.packing(spark, mixed, SF)
    copies = Counter(r["doc_id"] for r in rows)
    assert Counter(r["doc_id"] for r in packed.where("piece = 0").collect()) == copies
    tokens = {r["doc_id"]: r["n"] for r in P.packing(spark, alone, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    got = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == {i: n * tokens[i] for i, n in copies.items()}  # every token of a taken document, as often as it is taken
    assert P.run(spark, SF).count() == packed.count()


def test_documents_without_id_stay_apart(spark):
    docs = spark.createDataFrame([(None, "a b c d", "en", "s", 7), (None, "a b c d", "en", "s", 7), (None, "other words here", "en", "s", 16),
                                  (1, "x y z", "en", "s", 5), (1, "x y z", "en", "s", 5), (2, None, "en", None, None)],
                                 documents(spark, SF).schema)
    out = sorted((r["doc_id"] or 0, r["text"] or "") for r in P.near_duplicate(spark, docs, SF).collect())
    assert out == [(0, "a b c d"), (0, "other words here"), (1, "x y z"), (2, "")]


def test_texts_decide_and_not_ids(spark):
    """Different texts of one id stay; near copies without ids are one group."""
    long = [f"w{i}" for i in range(60)]
    rows = [(1, "a b c d e f g"), (1, "totally different words here now"), (None, " ".join(long)), (None, " ".join([*long, "more"])),
            (3, " ".join(["few", *long])), (1, " ".join([*long, "tail"])), (5, ""), (5, ""), (None, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], documents(spark, SF).schema)
    out = sorted(((r["doc_id"] or 0, r["text"]) for r in P.near_duplicate(spark, docs, SF).collect()), key=str)
    assert out == sorted([(1, "a b c d e f g"), (1, "totally different words here now"), (1, " ".join([*long, "tail"])), (5, ""), (0, " ")], key=str)


def test_stages_on_empty_and_odd_tables(spark):
    docs = documents(spark, SF)
    for name, stage in P.STAGES:
        out = stage(spark, docs.limit(0), SF)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
    odd = docs.limit(40).select("*", *[F.lit(1).alias(c) for c in ("_id", "_size", "copies", "text_key", "size", "target", "piece", "score", "h1")])
    odd = odd.drop("_id", "_size")
    for name, stage in P.STAGES:
        rows = staged(stage(spark, odd, SF), "t-odd")
        assert rows.count() > 0 and (name == "packing" or rows.columns == odd.columns)
