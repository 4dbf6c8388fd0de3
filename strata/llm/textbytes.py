"""Words and hashes of whole text batches, vectorised over the UTF-8 bytes.

A *word* is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D`` (the
pattern ``[^\\x20\\x09-\\x0D]+``; those bytes never occur inside a multi-byte
UTF-8 character, so splitting bytes equals splitting code points).

``chunks`` walks an Arrow string column in pieces of bounded bytes, so the
temporaries of a task stay small whatever the batch or document size (a single
text longer than the bound is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_GAP_A, _GAP_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= _GAP_A
    x ^= x >> U64(27)
    x *= _GAP_B
    x ^= x >> U64(31)
    return x


def _byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95) + U64(seed))


_TABLES = {0: _byte_table(1), 1: _byte_table(0x5851F42D4C957F2D)}
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2**64."""
    have = len(_POW["p"]) if _POW else 0
    if have <= n:
        size = 1 << max(16, int(n).bit_length())
        for k, b in (("p", _BASE), ("i", _INV)):
            a = np.full(size, b, U64)
            a[0] = 1
            _POW[k] = np.cumprod(a)
    return _POW["p"], _POW["i"]


@dataclass
class Chunk:
    """Some consecutive rows of a batch: rows[lo:hi], their bytes and offsets."""

    lo: int
    hi: int
    buf: np.ndarray      # uint8 bytes of these rows
    off: np.ndarray      # int64, hi - lo + 1 offsets into buf

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string column; nulls read as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64, n + 1, col.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def chunks(col: pa.Array, limit: int = CHUNK_BYTES, lower: bool = False) -> Iterator[Chunk]:
    """Consecutive row ranges of at most ``limit`` bytes (or one longer row)."""
    buf, off = column_bytes(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        part = buf[off[lo]:off[hi]]
        if lower:
            part = LOWER[part]
        yield Chunk(lo, hi, part, off[lo:hi + 1] - off[lo])
        lo = hi


@dataclass
class Words:
    """The words of a chunk, in order, and the row each belongs to."""

    start: np.ndarray    # int64 byte positions
    end: np.ndarray
    first: np.ndarray    # int64, rows + 1: index of each row's first word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(c: Chunk) -> Words:
    """Word boundaries; a word never crosses a row boundary."""
    if not len(c.buf):
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(c.rows + 1, np.int64))
    ink = ~SPACE[c.buf]
    edge = np.empty(len(ink), bool)
    edge[0] = ink[0]
    np.greater(ink[1:], ink[:-1], out=edge[1:])
    stop = np.empty(len(ink), bool)
    stop[-1] = ink[-1]
    np.greater(ink[:-1], ink[1:], out=stop[:-1])
    cuts = c.off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(ink))]
    inner = cuts[ink[cuts] & ink[cuts - 1]]
    edge[inner] = True
    stop[inner - 1] = True
    start = np.flatnonzero(edge)
    end = np.flatnonzero(stop) + 1
    return Words(start, end, np.searchsorted(start, c.off))


def word_hashes(c: Chunk, w: Words, table: int = 0) -> np.ndarray:
    """A 64-bit hash of every word's bytes, from one prefix sum over the chunk."""
    if not len(w.start):
        return np.zeros(0, U64)
    p, inv = _powers(len(c.buf))
    acc = np.zeros(len(c.buf) + 1, U64)
    np.cumsum(_TABLES[table][c.buf] * p[:len(c.buf)], out=acc[1:])
    h = (acc[w.end] - acc[w.start]) * inv[w.start]
    return mix(h + (w.end - w.start).astype(U64) * U64(0xA0761D6478BD642F))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive values (length len(h) - n + 1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    p, inv = _powers(len(h))
    acc = np.zeros(len(h) + 1, U64)
    np.cumsum(h * p[:len(h)], out=acc[1:])
    return mix((acc[n:] - acc[:m]) * inv[:m] + U64(n))


def window_starts(w: Words, n: int) -> np.ndarray:
    """Word indexes at which n words of one row start."""
    total = int(w.first[-1])
    left = np.repeat(w.first[1:], w.counts) - np.arange(total)
    return np.flatnonzero(left >= n)
