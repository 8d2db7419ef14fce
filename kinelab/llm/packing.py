"""Operator 8: best-fit-decreasing packing of token sequences.

Documents become token ids (plus an end id). Those longer than a sequence are
cut into full sequences from the back, so only the first piece is shorter.
Pieces are placed longest first, each into the open sequence with the least
room that still fits it.

Lengths are whole numbers of at most ``capacity``, so equal pieces are
interchangeable: the placement is computed over the histogram of lengths
(``capacity`` counts, whatever the corpus size) with a segment tree over the
remaining capacities, and gives exactly what best-fit decreasing gives piece
by piece. Pieces get their place by their rank among pieces of equal length.

Defined cases: null text is empty and gives a piece holding only the end id;
repeated rows are packed as often as they occur; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches, staged

CAPACITY = 1024
END_ID = 2
#: Rows ranked in one window partition, about.
RANK_ROWS = 50_000
#: Chunks whose ids a worker remembers; beyond, it starts afresh.
MEMO = 400_000

# A text whose white space is only single blanks and line feeds between other
# characters splits at them into chunks that the tokenizer treats separately.
_CHUNK = re.compile(r"\n| ?[^ \n]+")
_ODD = ("  ", " \n", "\n ", "\n\n", "<|", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
_ODD_WIDE = tuple("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _odd(text: str) -> bool:
    """Whether a text holds other white space, white space in a row or at its end, or may hold a special token."""
    return (text.endswith(" ") or any(x in text for x in _ODD)
            or not text.isascii() and any(x in text for x in _ODD_WIDE))


# A blank between two letters always starts a new chunk: very long texts are cut there.
_CUT = re.compile(r"(?<=[a-zA-Z]) (?=[a-zA-Z])")
CUT_CHARS = 1 << 20


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Chunks(dict):
    """Ids of the chunks met so far; a new one is encoded when it is looked up."""

    def __init__(self, encoding):
        self.encode = encoding.encode_ordinary

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        ids = self[chunk] = array.array("I", self.encode(chunk)).tobytes()
        return ids


class Encoder:
    """Little-endian uint32 token ids of texts, equal to those of ``tokenizers``.

    Ordinary texts are cut into chunks, and each chunk met for the first time
    is encoded from the vocabulary's own entries and ranks; a text with any
    other white space or with a special token goes whole to ``tokenizers``.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.memo = Chunks(tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))

    def __call__(self, text: str) -> bytes:
        if len(text) <= 2 * CUT_CHARS:
            return self._ids(text)
        parts, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + CUT_CHARS)
            end = cut.start() if cut else len(text)
            parts.append(self._ids(text[at:end]))
            at = end
        return b"".join(parts)

    def _ids(self, text: str) -> bytes:
        if _odd(text):
            return array.array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.memo.__getitem__, _CHUNK.findall(text)))


_ENCODERS: dict[str, Encoder] = {}


def _pieces(vocabulary: str, capacity: int, end_id: int, keep_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = Encoder(vocabulary)
        encode = _ENCODERS[vocabulary]
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, text in enumerate(batch.column(1)):
                raw = memoryview(encode(text.as_py() or "") + end)
                n = len(raw) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(r)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw[4 * a:4 * b]))
                    if keep_ids:
                        ids.append(np.frombuffer(raw[4 * a:4 * b], "<u4").astype(np.int32))
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


class OpenBins:
    """Open sequences by room left: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, n: int) -> None:
        if n > 0:
            self.runs[room].append((first, n))
            self._change(room, n)

    def pop(self, room: int) -> tuple[int, int]:
        first, n = self.runs[room].pop()
        self._change(room, -n)
        return first, n

    def _change(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += n
            i //= 2

    def tightest(self, length: int) -> int | None:
        """The least room >= length among open sequences, in logarithmic time."""
        i = length + self.leaves
        if not self.count[i]:
            while i > 1 and (i % 2 or not self.count[i + 1]):  # climb until a right neighbour holds some
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit(histogram: dict[int, int], capacity: int) -> pd.DataFrame:
    """Placement of ``histogram[length]`` pieces of each length.

    Rows (length, rank, n, bin, per_bin, offset): the n pieces of that length
    from that rank on go to sequences bin, bin + 1, ..., per_bin in each, from
    that offset on.
    """
    open_bins, n_bins, steps = OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = open_bins.tightest(length)
            if room is None:
                room, first = capacity, n_bins
                have = -(-left // (capacity // length))
                n_bins += have
            else:
                first, have = open_bins.pop(room)
            per = room // length
            n = min(left, have * per)
            full, rest = divmod(n, per)
            steps.append((length, rank, n, first, per, capacity - room))
            open_bins.add(room, first + full + (rest > 0), have - full - (rest > 0))
            open_bins.add(room - per * length, first, full)
            if rest:
                open_bins.add(room - rest * length, first + full, 1)
            rank += n
            left -= n
    return pd.DataFrame(steps, columns=["length", "rank", "n", "bin", "per_bin", "offset"], dtype="int64")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece."""
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    pieces = staged(docs.select("doc_id", "text").mapInArrow(_pieces(vocabulary, capacity, end_id, keep_ids), schema), "pack-pieces")

    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    plan = best_fit(counts, capacity).sort_values(["length", "rank"])
    key = plan["length"].to_numpy() * (1 << 44) + plan["rank"].to_numpy()
    first, per, at, base = (plan[c].to_numpy() for c in ("bin", "per_bin", "offset", "rank"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        s = np.searchsorted(key, n * (1 << 44) + r, side="right") - 1
        i = r - base[s]
        return pd.DataFrame({"sequence_id": first[s] + i // per[s], "offset": at[s] + (i % per[s]) * n})

    subs = max(1, -(-sum(counts.values()) // RANK_ROWS))
    rows = pieces.withColumn("_sub", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(subs)))
    before = (rows.groupBy("length", "_sub").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_sub")) - F.col("_n")).drop("_n"))
    inside = Window.partitionBy("length", "_sub").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (rows.withColumn("_rank", F.row_number().over(inside) - 1).join(before, ["length", "_sub"])
              .withColumn("_p", place("length", F.col("_rank") + F.col("_before"))))
    return ranked.select(*pieces.columns, "_p.sequence_id", "_p.offset")
