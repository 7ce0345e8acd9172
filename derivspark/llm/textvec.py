"""Word and shingle hashes of Arrow text arrays, computed with numpy only.

A batch's bytes are hashed at once: prefix sums of ``T[byte] * r^i`` modulo
2^64 give every word's polynomial hash as one difference, then a finaliser
mixes it. A-Z count as a-z. Equal words have equal hashes in every batch and
process; different words collide with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
R = 0x9E3779B97F4A7C15 | 1
SEGMENT = 1 << 19  # bytes hashed at once
BATCH_BYTES = 4 << 20  # bytes of text handled at once


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_LOW = np.arange(256)
_LOW[65:91] += 32
T_EXACT = mix(np.arange(1, 257, dtype=U) * U(R))
T_LOWER = T_EXACT[_LOW]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_pow = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _pow.get("n", 0) < n:
        a, b = np.full(n, R, U), np.full(n, pow(R, -1, 1 << 64), U)
        a[:1] = b[:1] = 1
        _pow.update(n=n, p=np.multiply.accumulate(a), q=np.multiply.accumulate(b))
    return _pow["p"], _pow["q"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = T_LOWER) -> np.ndarray:
    """64-bit hashes of the byte spans [starts, ends), which ascend and don't overlap."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        p, q = _powers(max(hi - lo, SEGMENT))
        acc = np.empty(hi - lo + 1, U)
        acc[0] = 0
        np.cumsum(table[data[lo:hi]] * p[:hi - lo], out=acc[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((acc[e] - acc[s]) * q[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
        i = j
    return out


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string array; nulls are empty."""
    arr = arr.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and len(off) else np.empty(0, np.uint8)
    return data, off - off[0]


def bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    word = ~SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[off[:-1][off[:-1] < len(data)]] = False
    last = off[1:] - 1
    after[last[last >= 0]] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def words(arr: pa.Array, table: np.ndarray = T_LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the position of each
    text's first word in them (one more entry than texts)."""
    data, off = buffers(arr)
    starts, ends = bounds(data, off)
    return span_hashes(data, starts, ends, table), np.searchsorted(starts, off)


def heads(arr: pa.Array, k: int, table: np.ndarray = T_LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``k`` code points of all words longer than that, and the
    index of each one's text."""
    data, off = buffers(arr)
    starts, ends = bounds(data, off)
    doc = np.searchsorted(off, starts, "right") - 1
    points = np.flatnonzero((data & 0xC0) != 0x80)  # where code points start
    cut = np.searchsorted(points, starts) + k
    cut = np.append(points, len(data))[np.minimum(cut, len(points))]
    longer = cut < ends
    return span_hashes(data, starts[longer], cut[longer], table), doc[longer]


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles (a shorter non-empty text: its whole
    sequence) and the position of each text's first shingle."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    at = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    pos = first[:-1][doc] + np.arange(at[-1]) - at[:-1][doc]
    width = np.minimum(n, k)[doc]
    out = width.astype(U) * U(0xA0761D6478BD642F)
    for j in range(k):
        take = j < width
        out[take] = (out[take] ^ h[pos[take] + j]) * U(0xE7037ED1A0B428DB) + U(j + 1)
        out ^= out >> U(29)
    return mix(out), at


def pieces(batch: pa.RecordBatch, text: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that its text column stays near ``limit`` bytes a piece."""
    size = buffers(batch.column(text))[1]
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(size, size[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


class Lookup:
    """Positions of 64-bit hashes in a fixed sorted key array (-1: absent): the top
    bits give the place to start, a few steps along the keys find the rest."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, ~U(0))  # the last stops every search
        self.bits = max(1, int(np.ceil(np.log2(max(len(keys), 2)))) + 1)
        edges = np.arange(1 << self.bits, dtype=U) << U(64 - self.bits)
        self.start = np.searchsorted(keys, edges).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self.start[h >> U(64 - self.bits)].astype(np.int64)
        key = self.keys[at]
        left = np.flatnonzero(key < h)
        while len(left):
            at[left] += 1
            key[left] = self.keys[at[left]]
            left = left[key[left] < h[left]]
        at[(key != h) | (at == len(self.keys) - 1)] = -1
        return at
