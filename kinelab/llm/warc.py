"""Operator 1: deterministic sharded WARC writer, and its reader.

Records are sorted by page_id and cut into shards at exact byte quantiles of
that order, so the same pages give the same files whatever the cluster did.
Each task writes its shards' files (gzip, one member per record), starting a
new file once the compressed size reaches ``file_bytes``. Headers, record ids
and digests are regenerated from the rows.

Commit: tasks write under names of their own attempt in ``_temporary`` and
return manifest rows; the rows of the attempts that succeeded are stored as a
table, and only the files it names are moved to their final names (moving
twice is harmless). A lost executor or a repeated attempt leaves orphans in
``_temporary``, which is removed at the end.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one
with the smallest page_id is a response and the others are revisits of it.

Defined cases: null html is an empty payload; a null url becomes
``urn:page:<id>``, characters that a header cannot hold are percent-encoded;
repeated rows are records of their own, one of them the response; a null
page_id sorts first and is a revisit where its payload occurs under an id; an
empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches, staged

REVISIT_BYTES = 100
#: Records are dealt to shards of about this many payload bytes, larger ones where there would be more than MOST_SHARDS.
SHARD_BYTES, MOST_SHARDS = 32 << 20, 100_000
#: A file is closed once its compressed size reaches this.
FILE_BYTES = 16 << 20
#: Tasks that read archives at a time, at most.
MOST_READERS = 20_000
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_MANIFEST = "file string, temporary string, records long, bytes long, sha256 string"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def _id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ':'.join(map(str, parts)))}>"


def _page_record(page_id, url, digest: str, payload: bytes, nth: int, refers_to, length: int) -> bytes:
    """``refers_to`` is None for a response, else a 1-tuple of the response's page_id."""
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
    head = [("WARC-Record-ID", _id(page_id, digest, nth)), ("WARC-Date", DATE), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if refers_to is None:
        block = http + payload
        return _record("response", [*head, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")], block)
    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to[0], digest, 0)), ("X-Refers-To-Page-ID", str(refers_to[0])),
             ("WARC-Block-Digest", f"sha256:{hashlib.sha256(http).hexdigest()}")]
    return _record("revisit", head, http)


class _Files:
    """The files of one task, in the order of its records."""

    def __init__(self, root: str, limit: int):
        self.fs, self.root = pafs.FileSystem.from_uri(root)
        self.temp, self.limit, self.out, self.shard = f"{self.root}/_temporary/{uuid.uuid4().hex}", limit, None, None
        self.done: list[tuple] = []
        self.fs.create_dir(self.temp, recursive=True)

    def add(self, shard: int, record: bytes) -> None:
        if self.out is not None and (shard != self.shard or self.size >= self.limit):
            self.close()
        if self.out is None:
            self.number = self.number + 1 if shard == self.shard else 0
            self.shard, self.size, self.records, self.sha = shard, 0, 0, hashlib.sha256()
            self.name = f"part-{shard:06d}-{self.number:05d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.temp}/{self.name}", compression=None)
            self._write(_record("warcinfo", [("WARC-Record-ID", _id("info", self.name)), ("WARC-Date", DATE), ("WARC-Filename", self.name),
                                             ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._write(record)
        self.records += 1

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.sha.update(raw)
        self.size += len(raw)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, f"{self.temp}/{self.name}", self.records, self.size, self.sha.hexdigest()))
            self.out = None


def _write(root: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = decided = last = None
        nth, response_left = 0, False
        for batch in batches:
            cols = [batch.column(c) for c in ("shard", "page_id", "digest", "kind", "first", "url", "html")]
            for shard, page_id, digest, kind, first, url, html in zip(*cols):
                page_id, digest = page_id.as_py(), digest.as_py()
                if not kind.as_py():  # a decision row stands before the page rows it is about
                    decided, response_left = (page_id, digest, first.as_py()), page_id == first.as_py()
                    continue
                nth = nth + 1 if last == (page_id, digest) else 0
                last = (page_id, digest)
                refers_to = (decided[2],) if decided is not None and decided[:2] == last else None
                if refers_to and response_left:
                    refers_to, response_left = None, False
                payload = (html.as_py() or "").encode()
                files = files or _Files(root, limit)
                files.add(shard.as_py(), _page_record(page_id, url.as_py(), digest, payload, nth, refers_to, len(payload)))
        if files:
            files.close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*files.done)], ["file", "temporary", "records", "bytes", "sha256"])
    return run


def _commit(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for name, temp in zip(batch.column("file").to_pylist(), batch.column("temporary").to_pylist()):
                if fs.get_file_info(temp).type == pafs.FileType.File:
                    fs.move(temp, f"{base}/{name}")
            yield batch
    return run


def write_archives(pages: DataFrame, path: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write page_id, url, html rows as archives under ``path``; returns the manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    text = F.coalesce("html", F.lit(""))
    digest = F.sha2(F.encode(text, "UTF-8"), 256)
    narrow = staged(pages.select("page_id", digest.alias("digest"), F.octet_length(text).cast("long").alias("n"))
                    .repartitionByRange("page_id", "digest").withColumn("part", F.spark_partition_id()), "warc-pages")

    # running bytes in the global order: exact, whatever the partition cuts were
    parts = (narrow.groupBy("part").agg(F.sum("n").alias("t"))
             .withColumn("before", F.sum("t").over(Window.orderBy("part")) - F.col("t")).drop("t"))
    run = F.sum("n").over(Window.partitionBy("part").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, 0))
    total = narrow.agg(F.sum("n")).first()[0] or 0
    shard = F.floor((F.col("before") + run - F.col("n")) / max(shard_bytes, total / MOST_SHARDS))
    place = F.struct(F.coalesce(F.col("page_id").cast("long"), F.lit(-1 << 63)).alias("page_id"), "digest")
    lows = (narrow.join(F.broadcast(parts), "part").withColumn("shard", shard)
            .groupBy("shard").agg(F.min(place).alias("low")).orderBy("shard").collect())  # MOST_SHARDS rows at most
    bounds = sorted({tuple(r["low"]) for r in lows})
    ids = np.array([p for p, _ in bounds], np.int64)

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series, digest: pd.Series) -> pd.Series:
        p = page_id.fillna(-1 << 63).astype("int64").to_numpy()
        at = np.searchsorted(ids, p, side="right") - 1
        for i in np.flatnonzero(np.searchsorted(ids, p, side="left") <= at):  # rows of a page at which a shard starts
            at[i] = bisect_right(bounds, (int(p[i]), digest.iat[i])) - 1
        return pd.Series(np.maximum(at, 0).astype(np.int32))

    shared = (narrow.where(F.col("n") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1 and first is not null").drop("c"))
    decisions = (narrow.join(shared, "digest").select("page_id", "digest", F.lit(0).alias("kind"), "first").distinct()
                 .withColumn("url", F.lit(None).cast("string")).withColumn("html", F.lit(None).cast("string")))
    rows = pages.select("page_id", digest.alias("digest"), F.lit(1).alias("kind"), F.lit(None).cast(narrow.schema["page_id"].dataType).alias("first"), "url", "html")
    dealt = (rows.unionByName(decisions).withColumn("shard", shard_of("page_id", "digest"))
             .repartitionById(max(1, len(bounds)), "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url"))
    manifest = staged(dealt.mapInArrow(_write(path, file_bytes), _MANIFEST), "warc-manifest")
    committed = staged(manifest.mapInArrow(_commit(path), _MANIFEST).drop("temporary"), "warc-committed")
    fs, base = pafs.FileSystem.from_uri(path)
    if fs.get_file_info(f"{base}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_temporary")
    return committed


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one after another."""
    gz, parts = zlib.decompressobj(31), []
    raw = stream.read(chunk)
    while raw:
        parts.append(gz.decompress(raw))
        raw = gz.unused_data
        if gz.eof:
            yield b"".join(parts)
            gz, parts = zlib.decompressobj(31), []
        if not raw:
            raw = stream.read(chunk)


def _read(root: str, keep_payload: bool):
    def number(x):
        return None if x is None else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        end = raw.index(b"\r\n\r\n")
                        head = dict(x.split(": ", 1) for x in raw[:end].decode().split("\r\n")[1:])
                        if head["WARC-Type"] == "warcinfo":
                            continue
                        block = raw[end + 4:end + 4 + int(head["Content-Length"])]
                        if head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                            raise ValueError(f"block digest of {head['WARC-Record-ID']} in {name}")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        if head["WARC-Type"] == "response":
                            size = len(payload)
                            if hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"payload digest of {head['WARC-Record-ID']} in {name}")
                        else:
                            size = int(http.rpartition(b"Content-Length: ")[2])
                        rows.append((number(head.get("X-Page-ID")), head["WARC-Target-URI"], size, digest, head["WARC-Type"],
                                     number(head.get("X-Refers-To-Page-ID")), payload.decode() if keep_payload and head["WARC-Type"] == "response" else None))
                        held += len(rows[-1][-1] or "")
                        if len(rows) >= 4096 or held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return run


def read_archives(spark: SparkSession, manifest: DataFrame, path: str, keep_payload: bool = True) -> DataFrame:
    """A row per page record of the manifest's files; digests are checked while reading."""
    files = manifest.select("file")
    # a number, so that adaptive execution does not merge the tasks: names are small, files are not
    return (files.repartition(min(max(1, files.count()), MOST_READERS), "file")
            .mapInArrow(_read(path, keep_payload), "page_id long, url string, payload_bytes long, payload_digest string, "
                                                   "record_type string, refers_to long, payload string"))
