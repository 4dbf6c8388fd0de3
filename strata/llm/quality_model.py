"""Quality classifier: naive-Bayes support vectors over n-gram indicators.

A text becomes the set of its n-grams, hashed into ``BUCKETS`` indicators:

* byte 3-grams,
* 1- to 4-grams of word *shapes* (letter case, digits, attached marks, whether
  the word equals the one before, whether its 3-word window occurred earlier in
  the text) and of runs of such repeats.

Each indicator is scaled by the log-count ratio of the two classes (the
naive-Bayes part), rows are scaled to unit length of the indicator vector, and a
linear hinge-loss model is fitted by dual coordinate descent.  A logistic curve
fitted on a held-back part of the sample, weighted to the class shares of all
learnable labels, turns margins into scores.

The fit uses a bounded sample: ``per_class`` labelled rows of each class (the
smallest hashes of the id).  Scoring reads whole texts.

Defined results: null and empty texts have no indicators and score by the
intercept; without labels of both classes every score is the share of class 1
(0.5 without any label).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, map_chunks, pick, smallest

BITS = 18
BUCKETS = 1 << BITS
SHAPES = 4            # shape n-grams up to this length
_M = np.uint64(0x9E3779B97F4A7C15)


def _bucket(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) * _M) >> np.uint64(64 - BITS)


def _class_table() -> np.ndarray:
    """A bit per kind of byte: lower, upper, digit, beyond ASCII, then marks."""
    t = np.zeros(256, np.uint16)
    t[97:123] = 1
    t[65:91] = 2
    t[48:58] = 4
    t[128:] = 8
    for bit, marks in ((16, b".,;:'\"-()"), (32, b"!?"), (64, b"#*$%&|<>"), (128, b"=+/\\@_~^{}[]`")):
        t[list(marks)] = bit
    return t


_CLASSES = _class_table()


def shapes(c: T.Chunk, w: T.Words, h: np.ndarray) -> np.ndarray:
    """A small integer per word: which kinds of byte it has, and repeats."""
    if not len(h):
        return np.zeros(0, np.uint64)
    padded = np.append(_CLASSES[c.buf], np.uint16(0))  # a word may end with the chunk
    kinds = np.bitwise_or.reduceat(padded, np.stack([w.start, w.end], 1).ravel())[::2]
    row = w.row
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    again = np.zeros(len(h), bool)
    s = T.window_starts(w, 3)
    if len(s):
        key = T.mix(T.window_hashes(h, 3)[s] + row[s].astype(np.uint64) * _M)
        order = np.argsort(key, kind="stable")
        later = np.zeros(len(s), bool)
        later[order[1:]] = key[order[1:]] == key[order[:-1]]
        again[s] = later
    return kinds.astype(np.uint64) | (same.astype(np.uint64) << np.uint64(8)) | (again.astype(np.uint64) << np.uint64(9))


def indicators(c: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every distinct indicator of the chunk's texts, sorted."""
    w = T.words(c)
    h = T.word_hashes(c, w)
    keys = []
    if len(c.buf) > 2:
        b = c.buf.astype(np.uint64)
        tri = b[:-2] | (b[1:-1] << np.uint64(8)) | (b[2:] << np.uint64(16))
        at = np.arange(len(tri))
        row = np.repeat(np.arange(c.rows), np.diff(c.off))
        inside = row[at] == row[at + 2]
        keys.append((row[:-2][inside].astype(np.uint64) << np.uint64(BITS)) | _bucket(tri[inside]))
    sh = shapes(c, w, h)
    row = w.row.astype(np.uint64)
    for n in (*range(1, SHAPES + 1), 12):
        s = T.window_starts(w, n)
        if len(s):
            keys.append((row[s] << np.uint64(BITS)) | _bucket(T.window_hashes(T.mix(sh + np.uint64(n)), n)[s]))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = np.unique(np.concatenate(keys))
    return (got >> np.uint64(BITS)).astype(np.int64), (got & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    """Weights per bucket (ratio times hinge weight), intercept, logistic curve."""

    weight: np.ndarray
    intercept: float
    slope: float
    shift: float

    def scores(self, c: T.Chunk) -> np.ndarray:
        row, bucket = indicators(c)
        margin = np.bincount(row, self.weight[bucket], c.rows) / np.sqrt(np.maximum(np.bincount(row, minlength=c.rows), 1))
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.intercept) + self.shift, -40, 40)))


def sample(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int) -> DataFrame:
    """(quality, buckets) of a bounded number of labelled rows of each class.

    The sample is drawn from the narrow label table; its at most 2 * per_class
    rows are broadcast to the scan of the documents.
    """
    lab = labels.select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id", F.lit(11)).alias("h")) \
        .filter(learn & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = smallest(lab, "quality", "h", per_class).select("doc_id", "quality")
    rows = pick(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id").select("quality", "text")

    def run(batch: pa.RecordBatch, c: T.Chunk) -> dict:
        row, bucket = indicators(c)
        off = np.searchsorted(row, np.arange(c.rows + 1)).astype(np.int32)
        return {"quality": column(batch, "quality"),
                "buckets": pa.ListArray.from_arrays(pa.array(off), pa.array(bucket.astype(np.int32)))}

    return map_chunks(rows, run, "quality int, buckets array<int>")


def hinge(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of the linear hinge-loss model (squared hinge, as
    its dual has no upper bound), by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    val = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    diag = np.array([v @ v + 1.0 for v in val]) + 0.5 / cost
    w, b, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ val[i] + b) - 1 + alpha[i] * 0.5 / cost[i]
            new = max(alpha[i] - g / diag[i], 0.0)
            d = (new - alpha[i]) * y[i]
            if d:
                w[rows[i]] += d * val[i]
                b += d
                alpha[i] = new
                moved = max(moved, abs(d))
        if moved < 1e-3:
            break
    return w, b


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with a small ridge."""
    p = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -40, 40)))
        grad = x.T @ (weight * (q - y)) + 0.01 * (p - [1.0, 0.0])
        hess = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        p -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(p[0], 1e-3)), float(p[1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 2500, epochs: int = 15, seed: int = 3) -> Model:
    """Learn from the label rows where ``learn`` (on labels.doc_id) holds."""
    share = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(learn & F.col("quality").isin(0, 1)) \
        .groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r["quality"]: r["n"] for r in share}
    prior = n.get(1, 0) / max(sum(n.values()), 1) if n else 0.5
    got = sample(docs, labels, learn, per_class).collect()
    got = sorted((r["quality"], tuple(r["buckets"])) for r in got)
    y = np.array([r[0] for r in got])
    if len(set(y.tolist())) < 2:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS), 0.0, 1.0, float(np.log(p / (1 - p))))
    rows = [np.array(r[1], np.int64) for r in got]
    rng = np.random.default_rng(seed)
    held = rng.random(len(rows)) < 0.2
    held[[np.flatnonzero(y == k)[0] for k in (0, 1)]] = True
    for k in (0, 1):  # both classes must stay on the fitting side
        if not (~held & (y == k)).any():
            held[y == k] = False
    use = np.flatnonzero(~held)
    count = {k: 1.0 + np.bincount(np.concatenate([rows[i] for i in use if y[i] == k] or [np.zeros(0, np.int64)]), minlength=BUCKETS)
             for k in (0, 1)}
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    sign = np.where(y == 1, 1.0, -1.0)
    per = np.array([len(use) / (2 * max((y[use] == k).sum(), 1)) for k in (0, 1)])
    w, b = hinge([rows[i] for i in use], sign[use], ratio, per[y[use]], epochs, seed)
    check = np.flatnonzero(held) if held.any() else use
    margin = np.array([w[rows[i]] @ ratio[rows[i]] / np.sqrt(max(len(rows[i]), 1)) + b for i in check])
    balance = {1: prior / max((y[check] == 1).mean(), 1e-9), 0: (1 - prior) / max((y[check] == 0).mean(), 1e-9)}
    slope, shift = logistic(margin, y[check].astype(float), np.where(y[check] == 1, balance[1], balance[0]))
    return Model(w * ratio, b, slope, shift)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    src = pick(docs, doc_id=doc_id, text=text)
    kind = src.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB: one weight per bucket

    def run(rows: pa.RecordBatch, c: T.Chunk) -> dict:
        return {"doc_id": column(rows, "doc_id"), "score": shared.value.scores(c)}

    return map_chunks(src, run, f"doc_id {kind}, score double")
