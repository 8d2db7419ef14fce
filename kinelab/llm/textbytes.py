"""Vectorised word splitting and hashing over the UTF-8 bytes of many texts.

Helpers that run inside Arrow tasks. Texts arrive as one byte buffer with
offsets; words are runs of "word" bytes, so any rule made of ASCII byte
classes can be used (bytes of multi-byte characters are always 0x80 and up).
Every function handles empty texts, and texts of any length: a slice holds
whole texts up to ``SLICE_BYTES``, and a longer text is hashed in windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; the temporary arrays are a small multiple of it.
SLICE_BYTES = 1 << 20

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_POW = np.ones(0, np.uint64)
_INV = np.ones(0, np.uint64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry table, True outside the given inclusive byte ranges."""
    t = np.ones(256, bool)
    for a, b in ranges:
        t[a:b + 1] = False
    return t


#: Words are runs of anything but ASCII white space: ``[^\x20\x09-\x0D]+``.
NON_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> None:
    global _POW, _INV
    if len(_POW) < n:
        with np.errstate(over="ignore"):
            inv = np.uint64(pow(int(_R), -1, 1 << 64))
            _POW = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _R)]), dtype=np.uint64)
            _INV = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inv)]), dtype=np.uint64)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is an empty text."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    col = col.fill_null("") if col.null_count else col
    n = len(col)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts add up to about ``limit`` bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _window_hashes(data: np.ndarray, off: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = classes[data]
    prev = np.zeros(n, w.dtype)
    prev[1:] = w[:-1]
    cuts = off[(off > 0) & (off < n)]
    prev[cuts] = 0
    nxt = np.zeros(n, w.dtype)
    nxt[:-1] = w[1:]
    nxt[cuts - 1] = 0
    starts = np.flatnonzero((w != 0) & (w != prev))
    ends = np.flatnonzero((w != 0) & (w != nxt)) + 1
    _powers(n + 1)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POW[:n], out=acc[1:])
    h = (acc[ends] - acc[starts]) * _INV[starts]
    return starts, ends, mix(h)


def word_hashes(data: np.ndarray, off: np.ndarray, classes: np.ndarray,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, 64-bit hash of each word), in text order.

    A word is a run of bytes of one class, 0 being no class at all.
    ``data``/``off`` are a slice from :func:`slices` with ``off[0] == 0``.
    """
    if len(data) <= 2 * SLICE_BYTES:
        d = _LOWER[data] if lower else data
        s, _, h = _window_hashes(d, off, classes)
        return np.searchsorted(off, s, side="right") - 1, h
    rows, hashes = [], []
    for r in range(len(off) - 1):  # a slice this large holds one very long text
        a, b = int(off[r]), int(off[r + 1])
        while a < b:
            e = min(a + SLICE_BYTES, b)
            while e < b and classes[data[e]] and classes[data[e - 1]] == classes[data[e]]:  # do not cut a word
                e += 1
            d = _LOWER[data[a:e]] if lower else data[a:e]
            h = _window_hashes(d, np.array([0, e - a]), classes)[2]
            rows.append(np.full(len(h), r, np.int64))
            hashes.append(h)
            a = e
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def shingle_sets(rows: np.ndarray, words: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles per row: (offsets of the rows, sorted hashes).

    A row with fewer than k words, but some, has one shingle: its whole
    sequence. A row without words has none.
    """
    n = len(words)
    counts = np.bincount(rows, minlength=n_rows) if n else np.zeros(n_rows, np.int64)
    m = max(n - k + 1, 0)
    with np.errstate(over="ignore"):
        acc = np.zeros(m, np.uint64)
        for j in range(k):
            acc = acc * _R + words[j:j + m]
        same = rows[:m] == rows[k - 1:k - 1 + m] if m else np.zeros(0, bool)
        h, r = mix(acc[same]), rows[:m][same]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            first = np.concatenate([[0], np.cumsum(counts)])[short]
            acc = np.full(len(short), len(words) * 0 + 1, np.uint64)
            for j in range(k - 1):
                has = counts[short] > j
                acc[has] = acc[has] * _R + words[(first + j)[has]]
            h, r = np.concatenate([h, mix(acc)]), np.concatenate([r, short])
    order = np.argsort(h, kind="stable")
    rr = r[order]
    if n_rows <= 1 << 16:
        rr = rr.astype(np.uint16)
    order = order[np.argsort(rr, kind="stable")]
    h, r = h[order], r[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[keep], r[keep]
    off = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n_rows))]).astype(np.int64)
    return off, h
