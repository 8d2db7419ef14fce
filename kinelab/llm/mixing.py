"""Operator 7: mixing sources to target weights by Sainte-Lague apportionment.

The words of a source lie on a line, its documents in a seeded order. The
line is cut into blocks of equally many words. Blocks are awarded one after
another to the source with the highest quotient target / (2k + 1), k being
the blocks it has; consecutive awards fill one shard, which gives each shard
integer quotas. The a-th award of a source takes the block at place
``a mod blocks`` of a seeded permutation, so a source whose target exceeds its
size repeats whole rounds of its blocks. A document takes what its stretch of
the line overlaps.

Blocks grow with the corpus, so a source of fewer than ``LEAST_BLOCKS`` of them
could miss its target widely, or get no block at all. Such a source is settled
outside the awards, to the word: whole rounds, then its blocks in the order of
the permutation, the last of them in part. Its words are dealt evenly to the
shards, and the awards share out what is left.

Everything but the document rows is small by construction: ``BLOCKS`` bounds
the blocks of the corpus, whatever its size, and the source table has a row
per source. The rest is joins and windows over bounded stretches.

Defined cases: null text has size 0 and takes 0; a null source is a source of
its own, after all others; repeated rows count like any row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelab.llm.common import staged

#: Fixed values of the mixture: weights by source rank, share of all words, most repeats.
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)
MOST = 2
#: The corpus is cut into about this many blocks.
BLOCKS = 65_536
#: Sources of fewer blocks are settled to the word; an award misses by a few blocks at most.
LEAST_BLOCKS = 512
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, rank, source_size, weight, target of (source, source_size) rows.

    Weighted water filling: sources in the order of cap / weight; those below
    the common level get their cap, the others level * weight.
    """
    caps = F.col("source_size") * float(MOST)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = (sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("weight", w).withColumn("cap", caps)
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    order = Window.orderBy("ratio", "rank")
    everything = Window.partitionBy(F.lit(1))
    level = (ranked
             .withColumn("budget", F.sum("source_size").over(everything) * (SHARE[0] / SHARE[1]))
             .withColumn("capped", F.sum("cap").over(order) - F.col("cap"))
             .withColumn("open", F.sum("weight").over(everything) - (F.sum("weight").over(order) - F.col("weight")))
             .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
             .withColumn("fits", F.col("level") <= F.col("ratio"))
             .withColumn("common", F.min(F.when(F.col("fits"), F.struct("ratio", "rank", "level"))).over(everything)["level"]))
    target = F.when(F.col("ratio") <= F.col("common"), F.col("cap")).otherwise(F.col("weight") * F.col("common"))
    return level.select("source", "rank", "source_size", "weight",
                        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target).alias("target"))


def _settled(block: int) -> Column:
    """Whether a source takes no part in the awards. Blocks of one word are exact as they are."""
    return F.lit(block > 1) & (F.ceil(F.col("source_size") / F.lit(block)) < LEAST_BLOCKS)


def _need() -> Column:
    return F.round("target").cast("long")


def awards(targets: DataFrame, block: int) -> DataFrame:
    """rank, k, award: the k-th block of a source is the award-th of the corpus."""
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    everything = Window.partitionBy(F.lit(1))
    words = F.sum("source_size").over(everything) * SHARE[0] - F.sum(F.when(_settled(block), _need()).otherwise(0)).over(everything) * SHARE[1]
    seats = F.floor((words + F.lit(block * SHARE[1] // 2)) / F.lit(block * SHARE[1])).cast("long")
    per_source = (targets.withColumn("seats", seats).where("target > 0").where(~_settled(block))
                  .select("rank", "target", "seats", F.explode(F.sequence(F.lit(0).cast("long"), (blocks * MOST - 1).cast("long"))).alias("k")))
    by_quotient = Window.orderBy((F.col("target") / (F.col("k") * 2 + 1)).desc(), "rank")
    return (per_source.withColumn("award", F.row_number().over(by_quotient) - 1)
            .where(F.col("award") < F.col("seats")).select("rank", "k", "award", "seats"))


def quotas(targets: DataFrame, awarded: DataFrame, block: int, shards: int) -> DataFrame:
    """rank, shard, blocks, words: how many blocks each shard takes from each source, or words of a settled one."""
    shard = F.floor(F.col("award") * F.lit(shards) / F.col("seats")).cast("int")
    whole = (awarded.groupBy("rank", shard.alias("shard")).agg(F.count(F.lit(1)).alias("blocks"))
             .withColumn("words", F.col("blocks") * block))
    upto = lambda j: F.floor(_need() * j / shards)
    settled = (targets.where(_settled(block)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
               .withColumn("words", upto(F.col("shard") + 1) - upto(F.col("shard"))).where("words > 0")
               .select("rank", "shard", F.lit(0).cast("long").alias("blocks"), "words"))
    return whole.unionByName(settled)


def _seeded():
    """The seeded order of a source's blocks."""
    return Window.partitionBy("rank").orderBy(F.md5(F.concat_ws("|", F.lit(SEED), F.col("rank").cast("string"), F.col("block").cast("string"))), "block")


def chosen_blocks(targets: DataFrame, awarded: DataFrame, block: int) -> DataFrame:
    """rank, block, times, part, base: how often each block is taken, its first words that are taken once more, and the words taken before it."""
    n = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    quota = awarded.groupBy("rank").agg(F.count(F.lit(1)).alias("quota"))
    every = (targets.where("source_size > 0").withColumn("n", n)
             .join(quota, "rank", "left")
             .select("rank", "source_size", "n", F.coalesce("quota", F.lit(0)).alias("quota"),
                     _settled(block).alias("settled"), _need().alias("need"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("block")))
    seeded = _seeded()
    line = Window.partitionBy("rank").orderBy("block")
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    times = F.floor(F.col("quota") / F.col("n")) + F.when(F.col("place") <= F.pmod("quota", "n"), 1).otherwise(0)
    rounds = F.floor(F.col("need") / F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("length"), F.col("need") - rounds * F.col("source_size") - F.col("before")))
    return (every.withColumn("place", F.row_number().over(seeded))
            .withColumn("length", length).withColumn("before", F.sum("length").over(seeded) - F.col("length"))
            .withColumn("times", F.when(F.col("settled"), rounds).otherwise(times).cast("long"))
            .withColumn("part", F.when(F.col("settled"), part).otherwise(0).cast("long"))
            .withColumn("words", (F.col("times") * F.col("length") + F.col("part")).cast("long"))
            .withColumn("base", F.sum("words").over(line) - F.col("words"))
            .select("rank", "block", "times", "part", "words", "base"))


def _line(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """(documents on their source's line, blocks as taken, targets, awards, words of a block)."""
    rows = staged(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix-rows")
    sizes = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, total // BLOCKS)
    targets = staged(source_targets(sizes), "mix-targets")
    awarded = staged(awards(targets, block), "mix-awards")
    blocks = staged(chosen_blocks(targets, awarded, block), "mix-blocks")

    # a row per source; null sources meet by the null-safe comparison
    here = (rows.withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source")))
            .withColumn("key", F.md5(F.concat_ws("|", F.lit(SEED), F.col("doc_id").cast("string"))))
            .withColumn("sub", F.substring("key", 1, 4)))
    before = (here.groupBy("rank", "sub").agg(F.sum("size").alias("words"))
              .withColumn("before", F.sum("words").over(Window.partitionBy("rank").orderBy("sub")) - F.col("words")).drop("words"))
    inside = Window.partitionBy("rank", "sub").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    on_line = (here.withColumn("_end", F.sum("size").over(inside)).join(before, ["rank", "sub"])
               .withColumn("end", F.col("before") + F.col("_end"))
               .withColumn("start", F.col("end") - F.col("size"))
               .withColumn("b0", F.floor(F.col("start") / block)).withColumn("b1", F.floor((F.col("end") - 1) / block)))
    return on_line, blocks, targets, awarded, block


def mixture(docs: DataFrame, shards: int = 8) -> tuple[DataFrame, DataFrame]:
    """(documents with what the mix takes of each, quotas of each shard)."""
    on_line, blocks, targets, awarded, block = _line(docs)
    first = blocks.select("rank", F.col("block").alias("b0"), F.col("times").alias("t0"), F.col("part").alias("p0"), F.col("base").alias("s0"))
    last = blocks.select("rank", F.col("block").alias("b1"), F.col("times").alias("t1"), F.col("part").alias("p1"), F.col("base").alias("s1"))
    x0, x1 = F.col("start") - F.col("b0") * block, F.col("end") - F.col("b1") * block
    taken = ((F.col("s1") + F.col("t1") * x1 + F.least(x1, F.col("p1")))
             - (F.col("s0") + F.col("t0") * x0 + F.least(x0, F.col("p0"))))
    out = (on_line.join(first, ["rank", "b0"], "left").join(last, ["rank", "b1"], "left")
           .select("doc_id", "size", "source_size", "target",
                   F.when(F.col("size") > 0, taken).otherwise(0).cast("long").alias("taken")))
    return out, quotas(targets, awarded, block, shards)


def whole_copies(docs: DataFrame) -> DataFrame:
    """doc_id, size, copies: how often the mix takes each document of any words as a whole.

    A document belongs to the block that holds its start. A source's words in
    the mix are whole rounds of its documents and a rest; the rest is filled
    with the documents of its blocks, in the blocks' seeded order, up to the
    block whose documents would exceed it by more than half of their words.
    """
    on_line, blocks, targets, _, _ = _line(docs)
    here = on_line.where("size > 0").select("rank", F.col("b0").alias("block"), "doc_id", "size")
    owned = here.groupBy("rank", "block").agg(F.sum("size").alias("owned"))
    seeded, source = _seeded(), Window.partitionBy("rank")
    per_block = (blocks.select("rank", "block", "words").join(owned, ["rank", "block"], "left")
                 .withColumn("owned", F.coalesce("owned", F.lit(0)))
                 .withColumn("all", F.sum("words").over(source)).withColumn("size_", F.sum("owned").over(source))
                 .withColumn("rounds", F.floor(F.col("all") / F.col("size_")))
                 .withColumn("rest", F.col("all") - F.col("rounds") * F.col("size_"))
                 .withColumn("middle", F.sum("owned").over(seeded) - F.col("owned") / 2)
                 .select("rank", "block", (F.col("rounds") + (F.col("middle") <= F.col("rest")).cast("int")).alias("copies")))
    return here.join(per_block, ["rank", "block"]).select("doc_id", "size", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Whole documents as often as the mix takes them, with their columns.

    No text is cut (:func:`whole_copies`): a document occurs never (then it is
    left out), once or twice, and a source's words come as near its target as
    whole documents allow. Rows that share id and size share their copies evenly.
    """
    plan = (whole_copies(docs).groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_size"))
            .agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_n")).where("_all > 0"))
    sized = docs.withColumn("_words", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)))
    more = F.pmod(F.xxhash64("text"), F.col("_n")) < F.pmod("_all", "_n")
    return (sized.join(plan, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("_words") == F.col("_size")))
            .withColumn("_copies", F.floor(F.col("_all") / F.col("_n")) + more.cast("int")).where("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
            .select(*docs.columns))
