"""Operator 3: byte-balanced shards by Karmarkar-Karp differencing.

Rows with equal texts form one indivisible group. Each group starts as a
partial partition (its bytes in one of the bins, the rest empty); the two
partial partitions with the largest spread are combined again and again,
the fullest bin of one with the emptiest of the other, until one is left.

At scale the differencing runs in steps that know of the large groups. Groups
above 1 / ``GROUPS_PER_TASK`` of all bytes, of which there are fewer than that,
are differenced first, all in one task; they leave the shards at different
levels. The others are dealt to nodes of about ``GROUPS_PER_TASK`` groups. A
node starts from its part of those levels, as one more partial partition, so its
groups fill what the large ones leave open. Nodes run in parallel, and every
``FAN_IN``-th only after those between it and the next, whose sums it starts
from: it levels what they left uneven, and node 0 does so for all. A task holds
the groups of a node and ``n_shards`` sums.

Defined cases: null text counts as empty (size 8 with the fixed 8 bytes per
row); repeated rows belong to one group; null ids are ordinary rows; an empty
table gives an empty result; columns other than doc_id and text are ignored.
A group larger than a fair share (all bytes / n_shards) cannot sit in one of
near-equal shards, so only such a group is cut, by the rank of its rows, into the
fewest pieces that fit a share.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelab.llm.common import staged

GROUPS_PER_TASK = 20_000
FAN_IN = 512
ROW_BYTES = 8
SLOT_ROWS = 50_000
#: Rows of a group to be cut that are ranked together.
RANK_ROWS = 1_000
#: The piece number of a row that holds a sum which a node starts from; h1 is its shard.
START = -1


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over partial partitions, one per row of ``sums``.

    Returns (place, total): bin j of input i ends in bin ``place[i, j]`` of the
    result, whose bins hold ``total``. Ties go to the earlier input.
    """
    n, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")          # rank -> own bin
    ranked = np.take_along_axis(sums, order, axis=1)          # descending sums
    child = np.empty((max(n - 1, 0), 2), np.int64)
    perm = np.empty((max(n - 1, 0), k), np.int64)             # result rank -> rank in the first child
    vals: list[np.ndarray | None] = list(ranked)
    heap = [(int(r[-1] - r[0]), i) for i, r in enumerate(ranked)]
    heapq.heapify(heap)
    for t in range(n - 1):
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        s = vals[a] + vals[b][::-1]
        vals[a] = vals[b] = None
        p = np.argsort(-s, kind="stable")
        s = s[p]
        child[t] = a, b
        perm[t] = p
        vals.append(s)
        heapq.heappush(heap, (int(s[-1] - s[0]), n + t))
    at = np.empty((2 * n - 1, k), np.int64)                   # rank in a node -> final bin
    at[2 * n - 2] = np.arange(k)
    for t in range(n - 2, -1, -1):
        a, b = child[t]
        at[a, perm[t]] = at[n + t]
        at[b, k - 1 - perm[t]] = at[n + t]
    place = np.empty((n, k), np.int64)
    np.put_along_axis(place, order, at[:n], axis=1)
    return place, vals[-1]


def _difference_groups(n_shards: int):
    """Shards of a node's groups, counted from the sums that it starts from."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        begun = pdf["piece"] == START
        start = np.zeros(n_shards, np.int64)
        np.add.at(start, pdf.loc[begun, "h1"].to_numpy(), pdf.loc[begun, "bytes"].to_numpy())
        pdf = pdf[~begun].sort_values(["bytes", "h1", "h2", "piece"], ascending=[False, True, True, True], kind="stable")
        sums = np.zeros((len(pdf) + 1, n_shards), np.int64)
        sums[0] = start
        sums[1:, 0] = pdf["bytes"].to_numpy()
        place, _ = difference(sums)
        shard_of = np.argsort(place[0])                       # bin of the result -> shard of the start
        return pdf.assign(bin=shard_of[place[1:, 0]].astype(np.int32))[["h1", "h2", "piece", "node", "bytes", "bin"]]
    return run


def _cut(rows: DataFrame, large: DataFrame) -> DataFrame:
    """``piece`` of every row: groups of ``large`` in pieces of equally many rows, the others in one.

    Rows are ranked inside hashed sub-blocks of a group and shifted by the sizes
    of the sub-blocks before, so no task sorts a whole group.
    """
    group = ["h1", "h2"]
    here = rows.join(large, group).withColumn("_sub", F.pmod(F.xxhash64("at"), F.ceil(F.col("rows") / RANK_ROWS)))
    before = (here.groupBy(*group, "_sub").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy(*group).orderBy("_sub")) - F.col("_n")).drop("_n"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(*group, "_sub").orderBy("at")) - 1
    pieces = (here.join(F.broadcast(before), [*group, "_sub"])
              .withColumn("piece", F.floor(rank * F.col("pieces") / F.col("rows")).cast("int")).select(*rows.columns, "piece"))
    return rows.join(large, group, "left_anti").withColumn("piece", F.lit(0)).unionByName(pieces)


def balanced_shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row (see the module)."""
    rows = staged(docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h1"),
    ).withColumn("h2", F.xxhash64("text_crc32", "size")).withColumn("at", F.monotonically_increasing_id()), "shard-rows")

    by_text = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    total, n_rows = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n_rows:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    share = total / n_shards
    # fewer than n_shards groups can be larger than a share each
    large = staged(by_text.where(F.col("bytes") > share).select(
        "h1", "h2", "rows", F.ceil(F.col("bytes") / share).cast("int").alias("pieces")), "shard-large")
    if not large.isEmpty():
        rows = staged(_cut(rows, F.broadcast(large)), "shard-pieces")
    else:
        rows = rows.withColumn("piece", F.lit(0))

    n_nodes = max(1, -(-n_rows // GROUPS_PER_TASK))
    above = F.lit(n_nodes > 1) & (F.col("bytes") * GROUPS_PER_TASK > total)
    groups = staged(rows.groupBy("h1", "h2", "piece").agg(F.sum("size").alias("bytes"))
                    .withColumn("node", F.when(above, -1).otherwise(F.pmod(F.xxhash64("h1", "h2", "piece"), F.lit(n_nodes)))), "shard-groups")
    placed = _placed(groups, n_nodes, n_shards)

    shard_of = placed.select("h1", "h2", "piece", F.col("bin").alias("shard"))
    out = rows.join(shard_of, ["h1", "h2", "piece"]).select("doc_id", "size", "text_crc32", "shard")
    return with_slots(staged(out, "shard-placed"), n_rows, n_shards)


def _placed(groups: DataFrame, n_nodes: int, n_shards: int) -> DataFrame:
    """h1, h2, piece, node, bytes, bin of every group: large ones (node -1), then the nodes, node 0 last."""
    def run(part: DataFrame, n: int) -> DataFrame:
        return staged(part.repartition(n, "node").groupBy("node").applyInPandas(
            _difference_groups(n_shards), "h1 long, h2 long, piece int, node long, bytes long, bin int"), "shard-nodes")

    levels = [0] * n_shards
    done = run(groups.where("node < 0"), 1) if n_nodes > 1 else None
    if done is not None:
        for r in done.groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect():  # n_shards rows
            levels[r["bin"]] = r["bytes"]
    small = groups.where("node >= 0")
    sizes = staged(small.groupBy("node").agg(F.sum("bytes").alias("bytes")), "shard-node-sizes")
    everything = sizes.agg(F.sum("bytes")).first()[0] or 1

    step = 1
    while True:
        # a node speaks for itself and the step - 1 nodes after it, which are placed
        last = step >= n_nodes
        here = F.col("node") == 0 if last else (F.col("node") % step == 0) & (F.col("node") % (step * FAN_IN) != 0)
        block = (F.floor(F.col("node") / step) * step).alias("node")
        level = F.posexplode(F.array(*[F.lit(x).cast("long") for x in levels]))
        start = (sizes.groupBy(block).agg((F.sum("bytes") / everything).alias("part")).select("node", "part", level.alias("h1", "level"))
                 .select("node", F.col("h1").cast("long"), F.floor(F.col("level") * F.col("part")).alias("bytes")))
        if done is not None:
            start = start.unionByName(done.where("node >= 0").groupBy(block, F.col("bin").cast("long").alias("h1")).agg(F.sum("bytes").alias("bytes")))
        start = start.where(here).select("h1", F.lit(0).cast("long").alias("h2"), F.lit(START).alias("piece"), "bytes", "node")
        found = run(small.where(here).unionByName(start), 1 if last else -(-n_nodes // step))
        done = found if done is None else done.unionByName(found)
        if last:
            return done
        step *= FAN_IN


def with_slots(rows: DataFrame, n_rows: int, n_shards: int) -> DataFrame:
    """Gapless numbers from 0 within each shard, by (sub-block, doc_id).

    Rows are numbered inside hashed sub-blocks of a shard and shifted by the
    sizes of the sub-blocks before, so no task sorts a whole shard.
    """
    subs = max(1, -(-n_rows // (n_shards * SLOT_ROWS)))
    rows = rows.withColumn("_sub", F.pmod(F.xxhash64("doc_id"), F.lit(subs)))
    before = (rows.groupBy("shard", "_sub").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("shard").orderBy("_sub")) - F.col("_n"))
              .drop("_n"))
    inside = Window.partitionBy("shard", "_sub").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("_rank", F.row_number().over(inside) - 1)
            .join(before, ["shard", "_sub"])
            .withColumn("slot", (F.col("_before") + F.col("_rank")).cast("long"))
            .drop("_sub", "_rank", "_before"))
