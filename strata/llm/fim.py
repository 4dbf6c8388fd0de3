"""Fill-in-middle transformation: a text is cut at two unit boundaries and its
parts are reordered around sentinels.

A *unit* is white space and the word after it; white space at the end of a text
is a unit of its own.  A text of n units has n + 1 boundaries, rank 0 to n.

The offset of a boundary comes from a learned rank index, fitted to all
boundaries of every text: piecewise-linear segments map rank to offset with an
error of at most ``EPSILON`` bytes, and the error of each boundary is stored in
one byte.  A cut is predicted by its segment and then corrected exactly by its
residual, so the index is as small as one byte a unit and a few numbers a
segment, whatever the length of a text.  Segments start as whole texts and are
halved until they meet the bound; a segment of two boundaries always does.

Which form a text takes, and where it is cut, follows from a hash of its id and
a seed, so a rerun or a recomputed task gives the same rows.

Defined results: null text counts as empty; an empty text and one that holds a
sentinel stay ``plain``; a null id hashes as the empty string; rows are handled
one by one, so repeated rows give repeated results; other columns are ignored
unless carried.  Rows must fit in memory one at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, map_chunks, pick

EPSILON = 127                      # what a residual of one byte can hold
SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle


def boundaries(c: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, first): the byte offsets at which each row's units begin or
    end, rank by rank, and the index of each row's rank 0."""
    w = T.words(c)
    ends_at = np.where(w.counts > 0, w.end[np.maximum(w.first[1:] - 1, 0)] if len(w.end) else 0, c.off[:-1])
    tail = ends_at < c.off[1:]
    n = w.counts + tail
    first = np.zeros(c.rows + 1, np.int64)
    np.cumsum(n + 1, out=first[1:])
    at = np.empty(first[-1], np.int64)
    at[first[:-1]] = c.off[:-1]
    at[np.arange(len(w.end)) + 1 + (first[:-1] - w.first[:-1])[w.row]] = w.end
    at[first[1:][tail] - 1] = c.off[1:][tail]
    return at, first


@dataclass
class RankIndex:
    """Rank to offset, for the concatenated boundary lists of many texts."""

    start: np.ndarray      # first rank of each segment
    base: np.ndarray       # offset at that rank
    slope: np.ndarray      # bytes a rank
    residual: np.ndarray   # int8, what the line misses at each rank

    def lookup(self, rank: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.start, rank, side="right") - 1
        return _line(self.base[s], self.slope[s], rank - self.start[s]) + self.residual[rank]


def _line(base: np.ndarray, slope: np.ndarray, step: np.ndarray) -> np.ndarray:
    return base + np.rint(slope * step).astype(np.int64)


def fit(at: np.ndarray, first: np.ndarray, epsilon: int = EPSILON) -> RankIndex:
    """Segments of at most ``epsilon`` error over every boundary of every text.

    A segment's line passes through its first and last boundary.  Only the
    segments that were split are looked at again."""
    if not 0 <= epsilon <= EPSILON:
        raise ValueError(f"a residual is one byte: epsilon must be 0 to {EPSILON}")
    residual = np.zeros(len(at), np.int8)
    lo, hi = first[:-1], first[1:]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(lo):
        size = hi - lo
        slope = (at[hi - 1] - at[lo]) / np.maximum(size - 1, 1)
        head = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(head, size)
        rank = np.repeat(lo, size) + step
        miss = at[rank] - _line(np.repeat(at[lo], size), np.repeat(slope, size), step)
        good = np.maximum.reduceat(np.abs(miss), head) <= epsilon
        held = np.repeat(good, size)
        residual[rank[held]] = miss[held]
        done.append((lo[good], slope[good]))
        lo, hi = lo[~good], hi[~good]
        mid = (lo + hi) // 2
        lo, hi = np.concatenate([lo, mid]), np.concatenate([mid, hi])
    start = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    slope = np.concatenate([d[1] for d in done]) if done else np.zeros(0)
    order = np.argsort(start)
    start = start[order]
    return RankIndex(start, at[start], slope[order], residual)


def _draw(seed: int, doc_id: Column, k: int) -> Column:
    """The k-th group of 8 hex digits of sha256("seed:id") as a number."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long")


def transform(docs: DataFrame, carry: list[str] | None = None, doc_id: str = "doc_id", text: str = "text", seed: int = 42,
              rate: int = 50, spm: int = 80, sentinels: tuple[str, str, str] = SENTINELS, epsilon: int = EPSILON) -> DataFrame:
    """The carried columns (doc_id), n, form, prefix_chars, middle_chars, output
    of every whole text.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of those into the order
    suffix, prefix, middle, the others into prefix, suffix, middle."""
    body = F.coalesce(docs[text], F.lit(""))
    plain = (body == "") | (_draw(seed, docs[doc_id], 2) % 100 >= rate)
    for s in sentinels:
        plain = plain | F.contains(body, F.lit(s))
    form = F.when(plain, 0).when(_draw(seed, docs[doc_id], 3) % 100 < spm, 2).otherwise(1)
    src = pick(docs, row=F.struct(*[docs[c] for c in carry or [doc_id]]), text=body, form=form,
               h1=_draw(seed, docs[doc_id], 0), h2=_draw(seed, docs[doc_id], 1))
    marks = [s.encode() for s in sentinels]

    def run(rows: pa.RecordBatch, c: T.Chunk) -> dict:
        at, first = boundaries(c)
        index = fit(at, first, epsilon)
        n = np.diff(first) - 1
        form = column(rows, "form").to_numpy()
        a, b = (column(rows, h).to_numpy() % (n + 1) for h in ("h1", "h2"))
        cut = [index.lookup(first[:-1] + r) for r in (np.minimum(a, b), np.maximum(a, b))]
        p, s, m = marks
        out = []
        for f, lo, x, y, hi in zip(form, c.off[:-1], *cut, c.off[1:]):
            pre, mid, suf = (c.buf[i:j].tobytes() for i, j in ((lo, x), (x, y), (y, hi)))
            out.append(pre + mid + suf if f == 0 else p + pre + s + suf + m + mid if f == 1 else s + suf + p + pre + m + mid)
        points = np.zeros(len(c.buf) + 1, np.int64)  # code points before each byte
        np.cumsum((c.buf & 0xC0) != 0x80, out=points[1:])
        chars = [pa.array(points[j] - points[i], pa.int64(), mask=form == 0) for i, j in ((c.off[:-1], cut[0]), cut)]
        return {"row": column(rows, "row"), "n": n, "form": pa.array(["plain", "psm", "spm"]).take(pa.array(form)),
                "prefix_chars": chars[0], "middle_chars": chars[1], "output": pa.array(out, pa.binary()).cast(pa.string())}

    kind = src.schema["row"].dataType.simpleString()
    return map_chunks(src, run, f"row {kind}, n long, form string, prefix_chars long, middle_chars long, output string") \
        .select("row.*", "n", "form", "prefix_chars", "middle_chars", "output")


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that was transformed.  A transformed text holds each sentinel
    once, so it splits into exactly three parts."""
    part = F.split(output, "|".join(re.escape(s) for s in sentinels), -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])) \
        .otherwise(F.concat(part[2], part[3], part[1]))
