"""A count-min sketch over 64-bit values, merged by Spark from partition sketches.

Every task sketches its own rows: the occupied cells, with their counts, in
bounded flushes.  A flush is cut into ranges of ``RANGE`` cells; Spark shuffles
the pieces by range and adds them up, so no task and no driver step ever holds
more than one range of counts.  The merged counts are reduced to a few bits per
cell (a *plane*); since a cell only ever adds what falls into it, a value's
plane entry never understates its count.

The plane is the only thing gathered and broadcast.  Its size is a parameter:
``cells`` follows the input up to ``MAX_CELLS``; past that the sketch tells less
apart (more values look repeated) but never loses one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import kept_table, python_ready

RANGE = 1 << 20
BLOCK = 1 << 15           # bits that Spark's bitmap aggregates hold
MAX_CELLS = 1 << 29
FLUSH = 1 << 21


def pack(a: np.ndarray) -> bytes:
    """Bytes of an integer array, most similar bytes together (for compression)."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""


def unpack(b, dtype) -> np.ndarray:
    d = np.dtype(dtype)
    raw = np.frombuffer(b, np.uint8)
    return np.ascontiguousarray(raw.reshape(d.itemsize, -1).T).reshape(-1).view(d)


def pack_sorted(a: np.ndarray) -> bytes:
    """An ascending integer array as packed differences."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b, dtype=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(b, dtype), dtype=dtype)


def pack_gaps(a: np.ndarray) -> bytes:
    """An ascending uint32 array below RANGE as byte-sized gaps (255: skip on)."""
    gap = np.diff(a.astype(np.int64), prepend=-1) - 1
    skips = gap // 255
    out = np.full(len(a) + int(skips.sum()), 255, np.uint8)
    out[np.cumsum(skips + 1) - 1] = gap % 255
    return out.tobytes()


def unpack_gaps(b) -> np.ndarray:
    g = np.frombuffer(b, np.uint8)
    step = np.where(g == 255, 255, g.astype(np.int64) + 1)
    return (np.cumsum(step) - 1)[g != 255]


def cells_for(values: int, per_value: float) -> int:
    """Cells for an expected number of values: whole ranges, bounded."""
    want = int(min(max(values * per_value, RANGE), MAX_CELLS))
    return -(-want // RANGE) * RANGE


def cell_of(h: np.ndarray, cells: int, row: int = 0) -> np.ndarray:
    """The cell of each value in one row of the sketch."""
    x = (h >> np.uint64(32)) if row == 0 else (T.mix(h + np.uint64(row)) >> np.uint64(32))
    return ((x * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)


def merged(docs: DataFrame, values: Callable[[T.Chunk], np.ndarray], cells: int, rows: int = 1, cap: int = 255,
           lower: bool = False, levels: tuple[int, ...] = (2,)) -> bytearray:
    """Count the values of all texts (column ``text``) and return the plane.

    ``levels``: ascending count thresholds; a cell's entry is how many it
    reaches (1 bit for one threshold, 2 bits for up to three).  ``rows``:
    independent sketch rows of ``cells`` cells each.
    """
    python_ready(docs.sparkSession)
    bits = 1 if len(levels) == 1 else 2
    per_row = cells // RANGE

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.concatenate(held)
            held.clear()
            out: dict[str, list] = {"part": [], "cells": [], "more": []}
            for r in range(rows):
                pos = np.sort(cell_of(h, cells, r))
                first = np.flatnonzero(np.diff(pos, prepend=-1))
                count = np.minimum(np.diff(np.append(first, len(pos))), cap).astype(np.uint8)
                pos = pos[first]
                cut = np.searchsorted(pos, np.arange(per_row + 1) * RANGE)
                for k in np.flatnonzero(np.diff(cut)):
                    p, c = pos[cut[k]:cut[k + 1]] - k * RANGE, count[cut[k]:cut[k + 1]]
                    big = np.flatnonzero(c > 1).astype(np.uint32)
                    out["part"].append(r * per_row + int(k))
                    out["cells"].append(pack_gaps(p))
                    out["more"].append(big.tobytes() + c[big].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["part"], pa.int32()), pa.array(out["cells"], pa.binary()), pa.array(out["more"], pa.binary())],
                names=["part", "cells", "more"])

        for b in batches:
            for c in T.chunks(b.column(0), lower=lower):
                v = values(c)
                if len(v):
                    held.append(v)
                    size += len(v)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def add(table: pa.Table) -> pa.Table:
        count = np.zeros(RANGE, np.uint16)
        for b, m in zip(table["cells"].to_pylist(), table["more"].to_pylist()):
            p = unpack_gaps(b)
            n = np.ones(len(p), np.uint16)
            k = len(m) // 5
            n[np.frombuffer(m, np.uint32, k)] = np.frombuffer(m, np.uint8, k, 4 * k)
            count[p] = np.minimum(count[p] + n, cap)
        level = np.zeros(RANGE, np.uint8)
        for t in levels:
            level += count >= t
        plane = np.packbits(level, bitorder="little") if bits == 1 else \
            (level[0::4] | (level[1::4] << 2) | (level[2::4] << 4) | (level[3::4] << 6))
        return pa.table({"part": table["part"].slice(0, 1).combine_chunks(), "plane": pa.array([plane.tobytes()], pa.binary())})

    parts = kept_table(docs.select("text").mapInArrow(partials, "part int, cells binary, more binary")
                       .groupBy("part").applyInArrow(add, "part int, plane binary"), "sketch")
    size = RANGE * bits // 8
    plane = bytearray(size * per_row * rows)
    for r in parts.toLocalIterator():  # one file's parts at a time beside the plane itself
        plane[r["part"] * size:(r["part"] + 1) * size] = r["plane"]
    return plane


def plane_of(values: DataFrame, cells: int, rows: int = 1) -> bytearray:
    """The plane (1 bit a cell) of the values in the column ``h`` (long, read as 64
    bits): set is every cell that a value falls into.  Spark builds it in blocks."""
    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate([cell_of(h, cells, r) + r * cells for r in range(rows)])
            yield pa.RecordBatch.from_arrays([pa.array(at // BLOCK), pa.array(at % BLOCK)], names=["block", "bit"])

    python_ready(values.sparkSession)
    blocks = kept_table(values.select("h").mapInArrow(spots, "block long, bit long").groupBy("block")
                        .agg(F.bitmap_construct_agg("bit").alias("bits")), "plane")
    size = BLOCK // 8
    plane = bytearray(cells * rows // 8)
    for r in blocks.toLocalIterator():
        plane[r["block"] * size:(r["block"] + 1) * size] = r["bits"]
    return plane


class Plane:
    """Lookups in a merged plane (inside a task)."""

    def __init__(self, raw: bytes | bytearray, cells: int, rows: int = 1, bits: int = 1):
        self.raw, self.cells, self.rows, self.bits = np.frombuffer(raw, np.uint8), cells, rows, bits

    def level(self, h: np.ndarray) -> np.ndarray:
        """The smallest entry over the rows: never below the value's true level."""
        best = None
        per = 8 // self.bits
        for r in range(self.rows):
            pos = cell_of(h, self.cells, r) + r * self.cells
            got = (self.raw[pos // per] >> ((pos % per) * self.bits).astype(np.uint8)) & ((1 << self.bits) - 1)
            best = got if best is None else np.minimum(best, got)
        return best if best is not None else np.zeros(0, np.uint8)
