"""Removal of repeated passages: every window of ``n`` words that starts twice.

1. Of every window the run of ``GRAM`` words with the smallest hash is its anchor
   (the leftmost of equal ones).  Equal windows have equal anchors at different
   places, so a window whose anchor stands at one place only is single.
   Neighbours share anchors: there are some 0.1 a word.  Spark counts them.
2. Only windows whose anchor repeats are grouped exactly, by a 96-bit hash, in
   hash ranges.  A window repeated inside one task's flush is decided there: one
   entry stands for it in the exchange, so a window that a third of all
   documents share reaches its range once per flush, not once per occurrence.
3. The repeated windows return to their documents as word ranges.  Documents
   without any are finished in one pass; only the others are joined (by id and,
   where an id may be shared, 64-bit text hash) with their ranges.  Equal rows of one id share them, and
   each flush and range sends a position of theirs once.

Windows are judged on the input.  What is broadcast: a filter of the repeated
anchors (a plane of at most ``sketch.MAX_CELLS`` bits a row, sized by these anchors
and not by the text) and one of the affected documents (32 MB).  Past these bounds
more windows and documents take the exact path; nothing is lost.

Defined results: a null or empty text has no words and keeps the empty text;
texts shorter than n words lose nothing; repeated rows are separate documents,
so each one's windows start elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, kept_table, map_chunks, marked_apart, pick, python_ready
from strata.llm.sketch import Plane, cells_for, pack, pack_sorted, plane_of, unpack, unpack_sorted

WINDOW = 35
GRAM = 16                 # words of an anchor, at most the window
PLANE_ROWS = 2
CELLS_PER_ANCHOR = 8      # per plane row and repeated anchor
PER_RANGE = 1 << 20       # windows per exact-grouping range, about
PER_BUCKET = 1 << 13      # documents per bucket of returned ranges, about
FLUSH = 1 << 20
_SEED = np.uint64(0xA24BAED4963EE407)


def _leftmost_smallest(g: np.ndarray, m: int) -> np.ndarray:
    """Position of the smallest of every m consecutive values (the leftmost of equal ones)."""
    def smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(g[b] < g[a], b, a)

    at, width = np.arange(len(g)), 1
    while 2 * width <= m:
        at, width = smaller(at[:-width], at[width:]), 2 * width
    return smaller(at[:len(at) - (m - width)], at[m - width:]) if m > width else at


def _anchors(h: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hashes, how many consecutive windows each serves), one per place."""
    k = min(n, GRAM)
    g = T.window_hashes(h, k)
    at = _leftmost_smallest(g, n - k + 1)[starts]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return g[at[first]], np.diff(np.append(first, len(at)))


def repeated_anchors(rows: DataFrame, n: int = WINDOW) -> DataFrame:
    """Column ``h``: the anchors that stand at more than one place of all texts."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in T.chunks(b.column(0)):
                w = T.words(c)
                s = T.window_starts(w, n)
                if len(s):
                    a, _ = _anchors(T.word_hashes(c, w), s, n)
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64))], names=["h"])

    python_ready(rows.sparkSession)
    places = rows.select("text").mapInArrow(found, "h long")
    return places.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")


def _second(c: T.Chunk, w: T.Words, n: int, starts: np.ndarray) -> np.ndarray:
    """A second, independent hash of the given windows (32 bits)."""
    h = T.word_hashes(c, w, table=1)
    return (T.window_hashes(T.mix(h + _SEED), n)[starts] >> np.uint64(32)).astype(np.uint32)


def _flush(held: list[tuple], ranges: int, buckets: int) -> pa.RecordBatch:
    """Rows (kind, part, a..e) of one flush.

    Kind 0, by hash range: windows to group exactly (h1, h2, doc, text hash,
    position; a position of -1 marks a window already known to repeat).
    Kind 1, by document bucket: occurrences already known to repeat.
    """
    h1, h2, doc, th, pos = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((h2, h1))
    h1, h2, doc, th, pos = h1[order], h2[order], doc[order], th[order], pos[order]
    same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    known = np.zeros(len(h1), bool)
    known[1:] |= same
    known[:-1] |= same
    lead = np.ones(len(h1), bool)
    lead[1:] = ~same
    rows: list[tuple] = []
    part = ((h1 >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    send = np.flatnonzero(lead)
    cut = np.searchsorted(part[send], np.arange(ranges + 1))
    for k in np.flatnonzero(np.diff(cut)):
        i = send[cut[k]:cut[k + 1]]
        own = i[~known[i]]
        rows.append((0, int(k), pack_sorted(h1[i]), pack(h2[i]), np.packbits(known[i]).tobytes(),
                     pack(doc[own]) + pack(th[own]), pack(pos[own])))
    rows += _by_document(doc[known], th[known], pos[known], buckets)
    names = ["kind", "part", "a", "b", "c", "d", "e"]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows), types)], names=names)


def _bucket_of(doc: np.ndarray, th: np.ndarray, buckets: int) -> np.ndarray:
    h = T.mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + th)
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _by_document(doc: np.ndarray, th: np.ndarray, pos: np.ndarray, buckets: int) -> list[tuple]:
    if not len(doc):
        return []
    b = _bucket_of(doc, th, buckets)
    order = np.lexsort((pos, th, doc, b))
    b, doc, th, pos = b[order], doc[order], th[order], pos[order]
    new = np.ones(len(b), bool)  # equal rows of one id give each position once
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (pos[1:] != pos[:-1])
    b, doc, th, pos = b[new], doc[new], th[new], pos[new]
    cut = np.searchsorted(b, np.arange(buckets + 1))
    return [(1, int(k), pack(doc[cut[k]:cut[k + 1]]), pack(th[cut[k]:cut[k + 1]]), pack(pos[cut[k]:cut[k + 1]]), b"", b"")
            for k in np.flatnonzero(np.diff(cut))]


def _exact(table: pa.Table, buckets: int) -> list[tuple]:
    """Group one hash range exactly; the repeated occurrences, by document."""
    h1, h2, known, doc, th, pos = [], [], [], [], [], []
    for a, b, c, d, e in zip(*(table[x].to_pylist() for x in "abcde")):
        x = unpack_sorted(a)
        k = np.unpackbits(np.frombuffer(c, np.uint8), count=len(x)).astype(bool)
        own = len(e) // 4
        dd, tt, pp = np.zeros(len(x), np.int64), np.zeros(len(x), np.uint64), np.full(len(x), -1, np.int32)
        dd[~k], tt[~k], pp[~k] = unpack(d[:8 * own], np.int64), unpack(d[8 * own:], np.uint64), unpack(e, np.int32)
        for lst, v in zip((h1, h2, known, doc, th, pos), (x, unpack(b, np.uint32), k, dd, tt, pp)):
            lst.append(v)
    h1, h2, known, doc, th, pos = (np.concatenate(x) for x in (h1, h2, known, doc, th, pos))
    order = np.lexsort((h2, h1))
    h1, h2 = h1[order], h2[order]
    same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    hit = np.zeros(len(h1), bool)
    hit[1:] |= same
    hit[:-1] |= same
    take = order[hit]
    take = take[~known[take]]
    return _by_document(doc[take], th[take], pos[take], buckets)


def _step(key: tuple, table: pa.Table, buckets: int) -> pa.Table:
    kind = key[0].as_py()
    rows = _exact(table, buckets) if kind == 0 else list(zip(*(table[x].to_pylist() for x in ("kind", "part", "a", "b", "c", "d", "e"))))
    cols = list(zip(*rows))[1:5] if rows else [[], [], [], []]
    return pa.table([pa.array(cols[0], pa.int32()), *(pa.array(x, pa.binary()) for x in cols[1:])], names=["part", "a", "b", "c"])


def _ranges(table: pa.Table, n: int) -> pa.Table:
    """Word ranges to remove, per document of one bucket."""
    doc = np.concatenate([unpack(x, np.int64) for x in table["a"].to_pylist()])
    th = np.concatenate([unpack(x, np.uint64) for x in table["b"].to_pylist()])
    pos = np.concatenate([unpack(x, np.int32) for x in table["c"].to_pylist()])
    order = np.lexsort((pos, th, doc))
    doc, th, pos = doc[order], th[order], pos[order]
    new_doc = np.ones(len(doc), bool)
    new_doc[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
    new_run = new_doc.copy()
    new_run[1:] |= pos[1:] > pos[:-1] + n
    first = np.flatnonzero(new_run)
    last = np.append(first[1:], len(doc)) - 1
    flat = np.stack([pos[first], pos[last] + n], 1).ravel().astype(np.int32)
    head = np.flatnonzero(new_doc)
    off = np.append(np.searchsorted(first, head) * 2, len(flat)).astype(np.int32)
    return pa.table([pa.array(doc[head]), pa.array(th[head].view(np.int64)), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))],
                    names=["doc", "th", "cuts"])


def repeated_ranges(rows: DataFrame, plane: Broadcast, cells: int, words: int, docs: int, n: int = WINDOW) -> DataFrame:
    """(doc, th, cuts): the word ranges [start, end, ...] covered by windows that
    start more than once.  ``rows`` has doc (long), th (text hash) and text."""
    ranges = max(1, -(-words // PER_RANGE))
    buckets = max(1, -(-docs // PER_BUCKET))

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Plane(plane.value, cells, PLANE_ROWS)
        held: list[tuple] = []
        size = 0
        for b in batches:
            ids = column(b, "doc").to_numpy(zero_copy_only=False)
            ths = column(b, "th").to_numpy(zero_copy_only=False).view(np.uint64)
            for c in T.chunks(column(b, "text")):
                w = T.words(c)
                s = T.window_starts(w, n)
                if not len(s):
                    continue
                h = T.word_hashes(c, w)
                a, serves = _anchors(h, s, n)
                keep = np.flatnonzero(np.repeat(look.level(a), serves))
                if not len(keep):
                    continue
                s = s[keep]
                h = T.window_hashes(h, n)[s]
                row = w.row[s]
                held.append((h, _second(c, w, n, s), ids[c.lo + row], ths[c.lo + row], (s - w.first[row]).astype(np.int32)))
                size += len(keep)
                if size >= FLUSH:
                    yield _flush(held, ranges, buckets)
                    held, size = [], 0
        if size:
            yield _flush(held, ranges, buckets)

    found = rows.select("doc", "th", "text").mapInArrow(
        flagged, "kind int, part int, a binary, b binary, c binary, d binary, e binary")
    by_doc = found.groupBy("kind", "part").applyInArrow(lambda key, t: _step(key, t, buckets), "part int, a binary, b binary, c binary")
    return by_doc.groupBy("part").applyInArrow(lambda t: _ranges(t, n), "doc long, th long, cuts array<int>")


def _kept_text(buf: np.ndarray, start: np.ndarray, end: np.ndarray, cuts) -> tuple[int, bytes]:
    """(words removed, kept words joined by one space)."""
    keep = np.ones(len(start), bool)
    for a, b in zip(cuts[0::2], cuts[1::2]):
        keep[a:b] = False
    raw = buf.tobytes()
    return int((~keep).sum()), b" ".join(raw[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist()))


def _finish(rows: pa.RecordBatch, c: T.Chunk) -> dict:
    """Digest columns of each row; ``cuts`` may be null (nothing to remove)."""
    w = T.words(c)
    cuts = column(rows, "cuts").to_pylist() if "cuts" in rows.schema.names else [None] * c.rows
    removed, kept = [], []
    for r in range(c.rows):
        i, j = w.first[r], w.first[r + 1]
        lo, hi = c.off[r], c.off[r + 1]
        k, body = _kept_text(c.buf[lo:hi], w.start[i:j] - lo, w.end[i:j] - lo, cuts[r] or ())
        removed.append(k)
        kept.append(body)
    return {"row": column(rows, "row"), "n_words": w.counts, "n_removed": removed, "kept": pa.array(kept, pa.binary())}


def remove(docs: DataFrame, carry: list[str] | None = None, n: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``row`` (the carried columns), n_words, n_removed
    and ``kept`` (the kept words joined by one space, UTF-8 bytes)."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    rows = pick(docs, row=F.struct(*[docs[c] for c in carry]), doc=F.coalesce(docs[doc_id].cast("long"), F.lit(-1)),
                text=F.coalesce(docs[text], F.lit("")))
    stat = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    repeated = kept_table(repeated_anchors(rows, n), "anchors")
    cells = cells_for(repeated.count(), CELLS_PER_ANCHOR)
    plane = spark.sparkContext.broadcast(plane_of(repeated, cells, PLANE_ROWS))
    # only rows that share their id need the text hash beside it; 0 costs no space in the exchanges
    shared = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc")
    alone, rest = marked_apart(rows, ["doc"], shared, stat["n"])
    rows = alone.withColumn("th", F.lit(0).cast("long")).unionByName(rest.withColumn("th", F.xxhash64("text")))
    words = (stat["b"] or 0) // 6
    cuts = kept_table(repeated_ranges(rows, plane, cells, words, stat["n"], n), "passages")
    plane.unpersist()

    row_type = rows.schema["row"].dataType.simpleString()
    out = f"row {row_type}, n_words long, n_removed long, kept binary"
    clean, others = marked_apart(rows, ["doc", "th"], cuts, stat["n"])
    # merge: the ranges grow with the input and are not to pass through the driver
    rest = others.join(cuts.hint("merge"), ["doc", "th"], "left").select("row", "text", "cuts")
    return map_chunks(clean, _finish, out).unionByName(map_chunks(rest, _finish, out))
