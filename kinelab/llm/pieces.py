"""Operator 12: SentencePiece encoding and decoding that keeps byte offsets.

A text is normalised first: at each place the longest prefix that the model's
compiled character map knows is replaced, other characters stay; blanks are
treated as the model says. The normaliser records, for every byte of its
output, the byte of the source it comes from, so that each piece is projected
back to a span of source bytes.

The normalised text is then merged pair by pair, best score first, leftmost
first among equals. No merge crosses two neighbouring characters that no entry
of the vocabulary holds next to each other, so the text is cut there, and a
chunk met before is not merged again. Characters outside the vocabulary become
byte pieces where the model has them (the last one carries the span), else the
unknown piece, one for a row of them.

Decoding joins the pieces, puts byte pieces together as UTF-8 (U+FFFD for each
byte that is none) and takes back the blank that the normaliser put in front.

Ids, spans and decoded texts equal those of the ``sentencepiece`` library; the
tests compare them. Models are of the kind BPE without user-defined symbols;
others are refused.

Defined cases: null and empty texts have no pieces and decode to an empty
text; repeated rows, null ids and ties count like any row; an empty table gives
an empty result; other columns are ignored, whatever their names. One text must
fit a task.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches

#: Fixed values of the format: the mark that stands for a blank, kinds of pieces, the kind of model.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: Chunks kept per worker, and the longest that is kept.
MEMO, MEMO_CHARS = 400_000, 64
_NEVER = float("inf")
#: Ways to cut normalised text, the finest first; a model takes the first that cuts none of its neighbouring characters.
_CHUNKS = [re.compile(x, re.DOTALL) for x in (rf"{MARK}*[^\W\d_]+|{MARK}*(?:(?!{MARK})[\W\d_])+|{MARK}+", f"{MARK}*[^{MARK}]+|{MARK}+", ".+")]


class CharacterMap:
    """Longest-prefix lookup in a compiled character map.

    The map is a little-endian length, a double-array trie of 32-bit units over
    UTF-8 bytes, and zero-ended replacements that the trie's values point to.
    """

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.texts = compiled[4 + size:]
        self.root = self._child(self.units[0]) if size else 0
        self.memo: dict[bytes, bytes] = {}

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << (8 if unit & 0x200 else 0)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest known prefix of ``data[at:]``."""
        if not self.units:
            return None
        node, value, length = self.root, -1, 0
        for k in range(at, len(data)):
            node ^= data[k]
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= self._child(unit)
            if unit & 0x100:
                value, length = self.units[node] & 0x7FFFFFFF, k + 1 - at
        if not length:
            return None
        return length, self.texts[value:self.texts.index(b"\0", value)]


def _character(data: bytes, at: int) -> int:
    """Length of the valid UTF-8 character at ``at``; 0 if there is none."""
    for n in (1, 2, 3, 4):
        try:
            if len(data[at:at + n].decode()) == 1:
                return n
        except UnicodeDecodeError:
            pass
    return 0


class Normalizer:
    """Source bytes -> (normalised bytes, source place of each of them and of the end)."""

    def __init__(self, spec, suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.blank = MARK.encode() if spec.escape_whitespaces else b" "
        self.prefix, self.tight, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, suffix

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not self.map.units and not self.tight and not self.suffix and _valid(data):
            return self._plain(data)
        return self._mapped(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No map and no blanks to remove: only the marks are wider than their sources."""
        if not data:
            return b"", np.zeros(1, np.int64)
        front = self.blank if self.prefix else b""
        source = np.frombuffer(data, np.uint8)
        places = np.repeat(np.arange(len(data)), np.where(source == 32, len(self.blank), 1))
        return (front + data.replace(b" ", self.blank),
                np.concatenate([np.zeros(len(front), np.int64), places, [len(data)]]))

    def _next(self, data: bytes, at: int) -> tuple[int, bytes]:
        known = self.map.longest(data, at)
        if known:
            return known
        n = _character(data, at)
        return (n, data[at:at + n]) if n else (1, "�".encode())

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, places, at = bytearray(), [], 0
        if self.tight:
            while at < len(data):
                n, text = self._next(data, at)
                if text != b" ":
                    break
                at += n
        if at == len(data):
            return b"", np.zeros(1, np.int64)

        def put(text: bytes) -> None:
            out.extend(text)
            places.extend([at] * len(text))

        if self.prefix and not self.suffix:
            put(self.blank)
        after_blank = self.tight
        while at < len(data):
            n, text = self._next(data, at)
            if after_blank:
                text = text.lstrip(b" ")
            if text:
                put(text.replace(b" ", self.blank))
                after_blank = text.endswith(b" ")
            if not self.tight:
                after_blank = False
            at += n
        if self.tight:
            while out.endswith(self.blank):
                del out[-len(self.blank):]
                at = places[len(out)]
                del places[len(out):]
        if self.prefix and self.suffix:
            put(self.blank)
        return bytes(out), np.array([*places, at], np.int64)


def _valid(data: bytes) -> bool:
    try:
        data.decode()
        return True
    except UnicodeDecodeError:
        return False


class Chunks(dict):
    """Chunk -> (id, normalised bytes) of its pieces as int32 pairs; merged when it is first looked up.

    When ``MEMO`` chunks are held they become the old ones, and those held
    before leave; a chunk that is looked up among the old ones is held again.
    """

    def __init__(self, model: PieceModel):
        self.model, self.old = model, {}

    def __missing__(self, chunk: str) -> bytes:
        packed = self.old.get(chunk)
        if packed is None:
            if len(chunk) > MEMO_CHARS:
                return array("i", [x for part in self.model.cut(chunk) for x in self.model.merge(part)]).tobytes()
            packed = array("i", self.model.merge(chunk)).tobytes()
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[chunk] = packed
        return packed


class PieceModel:
    """A model file: encodes and decodes with byte spans."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != BPE or USER in kinds:
            raise ValueError("only BPE models without user-defined symbols are supported")
        self.normalize = Normalizer(proto.normalizer_spec, proto.trainer_spec.treat_whitespace_as_suffix)
        self.back = Normalizer(proto.denormalizer_spec) if proto.denormalizer_spec.precompiled_charsmap else None
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.front = proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces
        self.tight = proto.normalizer_spec.remove_extra_whitespaces
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type in (NORMAL, UNUSED)}
        self.ids = {p.piece: (i, len(p.piece.encode())) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, UNUSED)}
        self.unused = {p.piece for p in proto.pieces if p.type == UNUSED}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.kind = [p.type for p in proto.pieces]
        blank = lambda text: text.replace(MARK, " ").encode()
        surface = {CONTROL: lambda p: b"", UNKNOWN: lambda p: proto.trainer_spec.unk_surface.encode(), BYTE: lambda p: bytes([int(p.piece[3:5], 16)])}
        self.surface = [surface.get(p.type, lambda p: blank(p.piece))(p) for p in proto.pieces]
        self.empty = {i for i, x in enumerate(self.surface) if not x}
        self.marked = [p.type in (NORMAL, UNUSED) and p.piece.startswith(MARK) for p in proto.pieces]
        self.near = {p.piece[i:i + 2] for p in proto.pieces if p.type in (NORMAL, UNUSED) for i in range(len(p.piece) - 1)}
        self.parts = next(p for p in _CHUNKS if all(len(p.findall(ab)) == 1 for ab in self.near))
        self.chunks = Chunks(self)

    def cut(self, text: str) -> Iterator[str]:
        """Parts of ``text`` that no merge crosses."""
        start = 0
        for i in range(1, len(text)):
            if text[i - 1:i + 1] not in self.near:
                yield text[start:i]
                start = i
        if text:
            yield text[start:]

    def merge(self, text: str) -> list[int]:
        """id, normalised bytes, id, normalised bytes, ... of the pieces of a part."""
        part = list(text)
        halves: dict[str, tuple[str, str]] = {}
        if len(part) > MEMO_CHARS:
            part = self._merge_long(part, halves)
        elif len(part) > 1:
            rank, unused = self.rank.get, self.unused
            ranks = [rank(both, _NEVER) for both in map(add, part, part[1:])]
            ranks.append(_NEVER)  # one for each piece with its right neighbour
            while (best := min(ranks)) < _NEVER:
                i = ranks.index(best)
                right = part.pop(i + 1)
                del ranks[i]
                both = part[i] + right
                if unused and both in unused:
                    halves[both] = (part[i], right)
                part[i] = both
                if i:
                    ranks[i - 1] = rank(part[i - 1] + both, _NEVER)
                if i + 1 < len(part):
                    ranks[i] = rank(both + part[i + 1], _NEVER)
        if halves:
            part = [x for piece in part for x in self._split(piece, halves)]
        out = []
        for piece in part:
            known = self.ids.get(piece)
            if known is not None:
                out += known
            elif self.byte_id:
                raw = piece.encode()
                for x in raw[:-1]:
                    out += (self.byte_id[x], 0)
                out += (self.byte_id[raw[-1]], len(raw))
            else:
                out += (self.unknown, len(piece.encode()))
        return out

    def _merge_long(self, part: list[str], halves: dict[str, tuple[str, str]]) -> list[str]:
        """The merges of a long part, with a heap of the pairs on offer."""
        left, right = list(range(-1, len(part) - 1)), [*range(1, len(part)), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (rank := self.rank.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (rank, a, b, part[a] + part[b]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if right[a] != b or not part[a] or part[a] + part[b] != both:
                continue
            if both in self.unused:
                halves[both] = (part[a], part[b])
            part[a], part[b] = both, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [x for x in part if x]

    def _split(self, piece: str, halves: dict[str, tuple[str, str]]) -> list[str]:
        """Unused pieces only lead to longer ones; those left go back to their halves."""
        if piece not in self.unused or piece not in halves:
            return [piece]
        a, b = halves[piece]
        return self._split(a, halves) + self._split(b, halves)

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first byte, end byte) of the pieces of a text in UTF-8."""
        norm, places = self.normalize(text)
        parts = self.parts.findall(norm.decode())
        if not parts:
            return (np.zeros(0, np.int32),) * 3
        ids, sizes = np.frombuffer(b"".join([self.chunks[c] for c in parts]), np.int32).reshape(-1, 2).T
        ends = np.cumsum(sizes, dtype=np.int64)
        starts = ends - sizes
        if not self.byte_id:  # a row of unknown pieces is one
            again = np.zeros(len(ids), bool)
            again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
            last = np.append(~again[1:], True)
            ids, starts, ends = ids[~again], starts[~again], ends[last]
        a = places[starts].astype(np.int32)
        return ids, a, np.where(ends > starts, places[ends], a).astype(np.int32)

    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids, in UTF-8."""
        if ids and not (self.tight or self.suffix or self.back) and self.empty.isdisjoint(ids):
            text = b"".join([self.surface[i] for i in ids])
            if _valid(text):  # so is every row of byte pieces, as all pieces between them are
                return text[1:] if self.front and self.marked[ids[0]] else text
        out, waiting, front, marked = bytearray(), bytearray(), True, False
        for i in ids:
            if self.kind[i] == BYTE:
                waiting += self.surface[i]
                continue
            if waiting:
                out += _repaired(waiting)
                waiting.clear()
            if front and (marked or out):
                front = False
            text = self.surface[i]
            if front and self.front and not self.suffix and self.marked[i]:
                text, marked = text[1:], not self.tight
            out += text
        out += _repaired(waiting)
        if self.suffix and self.front and out.endswith(b" "):
            del out[-1:]
        return self.back(bytes(out))[0] if self.back else bytes(out)


def _repaired(raw: bytes) -> bytes:
    """Bytes as UTF-8; each one that belongs to no character becomes U+FFFD."""
    raw = bytes(raw)
    if _valid(raw):
        return raw
    out, at = bytearray(), 0
    while at < len(raw):
        n = _character(raw, at)
        out += raw[at:at + n] if n else "�".encode()
        at += n or 1
    return bytes(out)


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model per worker and path."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _pieces(path: str):
    def lists(parts: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
        flat = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            got = [m.encode(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            decoded = [m.decode(ids.tolist()) for ids, _, _ in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(lists([g[k] for g in got]) for k in range(3)), pa.array(decoded, pa.binary()).cast(pa.string())],
                ["doc_id", "ids", "starts", "ends", "decoded"])
    return run


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, starts, ends (source bytes of each piece) and the decoded text of every document.

    ``path`` names the model on every worker. One pass over the table, no shuffle.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(path), f"doc_id {id_type}, ids array<int>, starts array<int>, ends array<int>, decoded string")


def piece_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`encode_pieces`."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
