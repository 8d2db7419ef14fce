"""Streams of whole groups inside one task, and grids over large groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by ``keys`` so that no group spans two tables."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = last_start(batch, keys)
        if cut == 0 and rest and same_key(rest[-1], batch, keys):
            rest.append(batch)
            continue
        if rest:
            first = first_end(batch, keys) if same_key(rest[-1], batch, keys) else 0
            yield pa.Table.from_batches([*rest, batch.slice(0, first)] if first else rest)
            batch = batch.slice(first)
            cut -= first
        if cut > 0:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        rest = [batch.slice(max(cut, 0))]
    if rest:
        yield pa.Table.from_batches(rest)


def _keys(batch: pa.RecordBatch, keys: list[str]) -> list[np.ndarray]:
    return [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]


def starts_of(cols: list[np.ndarray]) -> np.ndarray:
    """Positions at which a new group starts."""
    n = len(cols[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def last_start(batch: pa.RecordBatch, keys: list[str]) -> int:
    return int(starts_of(_keys(batch, keys))[-1])


def first_end(batch: pa.RecordBatch, keys: list[str]) -> int:
    s = starts_of(_keys(batch, keys))
    return int(s[1]) if len(s) > 1 else batch.num_rows


def same_key(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[a.num_rows - 1].as_py() == b.column(k)[0].as_py() for k in keys)


def triangle(rows: DataFrame, size: Column, salt: Column, per_block: int) -> DataFrame:
    """Deal each group's rows to the cells (bi <= bj) of a triangle of blocks.

    A group of up to ``per_block`` rows is one cell; a larger one is cut into
    blocks by ``salt``, and every pair of blocks is a cell, so each pair of
    rows meets in exactly one cell (``side`` tells the two blocks apart) and
    no task holds more than two blocks of a group.
    """
    n = F.ceil(size / F.lit(per_block)).cast("int")
    b = F.pmod(salt, F.col("_n")).cast("int")
    cell = F.explode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                                 lambda o: F.struct(F.least(F.col("_b"), o).alias("bi"), F.greatest(F.col("_b"), o).alias("bj"),
                                                    (o < F.col("_b")).alias("side"))))
    return (rows.withColumn("_n", n).withColumn("_b", b).withColumn("_c", cell)
            .select(*rows.columns, "_c.bi", "_c.bj", "_c.side"))
