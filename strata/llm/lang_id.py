"""Language identification by a byte convolutional network.

Texts are read as UTF-8 bytes (A-Z lower-cased) in windows of a fixed length.
Filters of several widths slide over a window, each filter's largest response
is kept, and a softmax layer turns the pooled responses into class scores.  A
document's score is the byte-weighted mean of its windows' probabilities, so
every byte of the text counts.

Training runs in numpy on the driver, on a bounded sample: ``per_lang``
documents per language (the smallest hashes of the id) and ``PER_DOC`` windows
of each.  Only the text and the label are used.  A max-pooled filter only gets
a gradient at its winning position, which keeps the backward pass a sparse
scatter.

In inference a filter of width 3 or 4 is looked up by byte pairs, so a position
costs five table rows instead of nine.

Defined results: a text that is null or holds no letter is ``und`` with score
0; so is every text when nothing can be learned (no labelled rows).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, map_chunks, pick, smallest

WINDOW = 256          # bytes per window
WIDTHS = (2, 3, 4)    # filter widths
FILTERS = 16          # filters per width
PER_DOC = 4           # training windows per sampled document
UNKNOWN = "und"
_ROWS = 64            # windows per inference block (16 K positions: stays in cache)
_TABLES: dict[bytes, list[np.ndarray]] = {}


@dataclass
class Model:
    """Weights: one (width, 256, filters) array per width, and the output layer."""

    langs: list[str]
    conv: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    key: bytes = field(default=b"")

    def pair_tables(self) -> list[np.ndarray]:
        """Filters as rows indexed by a byte pair (or the last byte), once per process."""
        if self.key not in _TABLES:
            tabs = []
            for w in self.conv:
                for k in range(0, len(w), 2):
                    two = k + 1 < len(w)
                    tabs.append((w[k][:, None, :] + w[k + 1][None, :, :]).reshape(65536, -1) if two else w[k])
            _TABLES[self.key] = [np.ascontiguousarray(t, np.float32) for t in tabs]
        return _TABLES[self.key]

    def probabilities(self, win: np.ndarray) -> np.ndarray:
        """(windows, classes) softmax scores of a uint8 (windows, WINDOW) array."""
        tabs = self.pair_tables()
        pooled = np.empty((len(win), FILTERS * len(WIDTHS)), np.float32)
        for lo in range(0, len(win), _ROWS):
            b = win[lo:lo + _ROWS]
            pair = b[:, :-1].astype(np.intp) * 256 + b[:, 1:]
            at = 0
            for i, w in enumerate(WIDTHS):
                n = WINDOW - w + 1
                resp = tabs[at].take(pair[:, :n], axis=0)
                at += 1
                for k in range(2, w, 2):
                    idx = pair[:, k:k + n] if k + 1 < w else b[:, k:k + n]
                    resp += tabs[at].take(idx, axis=0)
                    at += 1
                pooled[lo:lo + _ROWS, i * FILTERS:(i + 1) * FILTERS] = resp.max(axis=1)
        return softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def to_windows(c: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-overlapping windows of every row, padded with spaces: (windows,
    row of each, bytes of text in each).  An empty row has no window."""
    size = np.diff(c.off)
    n_win = -(-size // WINDOW)
    first = np.concatenate([[0], np.cumsum(n_win)])
    win = np.full(int(first[-1]) * WINDOW, 32, np.uint8)
    win[np.arange(len(c.buf)) + np.repeat(first[:-1] * WINDOW - c.off[:-1], size)] = c.buf
    row = np.repeat(np.arange(c.rows), n_win)
    used = np.minimum(size[row] - (np.arange(len(row)) - first[row]) * WINDOW, WINDOW)
    return win.reshape(-1, WINDOW), row, used


def encode_windows(texts: list[str]) -> np.ndarray:
    """Training windows: the leading bytes of each text, padded with spaces."""
    out = np.full((len(texts), WINDOW), 32, np.uint8)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode()[:WINDOW], np.uint8)
        out[i, :len(b)] = T.LOWER[b]
    return out


def sample(docs: DataFrame, learn: Column, per_lang: int, text: str = "text", lang: str = "lang",
           doc_id: str = "doc_id") -> DataFrame:
    """(lang, windows): at most ``per_lang`` documents of each language."""
    start = [F.lit(1) + F.pmod(F.xxhash64(F.col(doc_id), F.lit(i)), F.greatest(F.length(text) - WINDOW, F.lit(1))).cast("int")
             for i in range(PER_DOC)]
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id), F.lit(-1)).alias("h"),
        F.array_distinct(F.array(*[F.substring(F.col(text), s, F.lit(WINDOW)) for s in start])).alias("windows"))
    return smallest(rows, "lang", "h", per_lang).select("lang", "windows")


def train(texts: list[str], labels: list[str], epochs: int = 4, batch: int = 64, rate: float = 4e-3,
          seed: int = 7) -> Model | None:
    """Fit the network with Adam on (window, label) pairs; None without labels."""
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    order = np.lexsort((np.array(texts, object), np.array(labels, object)))
    x = encode_windows([texts[i] for i in order])
    y = np.searchsorted(langs, np.array([labels[i] for i in order], object))
    weight = (len(y) / (len(langs) * np.bincount(y, minlength=len(langs))))[y].astype(np.float32)
    n_f, total = FILTERS, FILTERS * len(WIDTHS)
    par = [rng.normal(0, 0.3, (w, 256, n_f)).astype(np.float32) for w in WIDTHS]
    par += [np.zeros(total, np.float32), rng.normal(0, 0.1, (total, len(langs))).astype(np.float32),
            np.zeros(len(langs), np.float32)]
    m1, m2, step = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    cols = np.arange(n_f)
    for _ in range(epochs):
        perm = rng.permutation(len(y))
        for lo in range(0, len(perm), batch):
            ix = perm[lo:lo + batch]
            b = x[ix].copy()
            # some windows are shortened, so that short texts are learned too
            cut = np.where(rng.random(len(ix)) < 0.3, rng.integers(12, WINDOW, len(ix)), WINDOW)
            b[np.arange(WINDOW)[None, :] >= cut[:, None]] = 32
            pooled, best = [], []
            for w, p in zip(WIDTHS, par):
                n = WINDOW - w + 1
                resp = p[0].take(b[:, :n], axis=0)
                for k in range(1, w):
                    resp += p[k].take(b[:, k:k + n], axis=0)
                best.append(resp.argmax(axis=1))
                pooled.append(np.take_along_axis(resp, best[-1][:, None, :], 1)[:, 0])
            z = np.concatenate(pooled, 1) + par[-3]
            h = np.maximum(z, 0)
            prob = softmax(h @ par[-2] + par[-1])
            prob[np.arange(len(ix)), y[ix]] -= 1
            d = prob * weight[ix][:, None] / len(ix)
            dh = (d @ par[-2].T) * (z > 0)
            grad = []
            for i, w in enumerate(WIDTHS):
                g = dh[:, i * n_f:(i + 1) * n_f]
                gw = np.empty_like(par[i])
                for k in range(w):
                    byte = np.take_along_axis(b, best[i] + k, 1).astype(np.intp)
                    gw[k] = np.bincount((byte * n_f + cols).ravel(), g.ravel(), 256 * n_f).reshape(256, n_f)
                grad.append(gw)
            grad += [dh.sum(0), h.T @ d, d.sum(0)]
            step += 1
            lr = rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for p, g, a, v in zip(par, grad, m1, m2):
                a += 0.1 * (g - a)
                v += 0.001 * (g * g - v)
                p -= lr * a / (np.sqrt(v) + 1e-7)
    key = b"".join(p.tobytes()[:64] for p in par)
    return Model(langs, par[:len(WIDTHS)], par[-3], par[-2], par[-1], key)


def fit(docs: DataFrame, learn: Column, per_lang: int = 1500) -> Model | None:
    """Learn from the rows where ``learn`` holds; the sample is bounded."""
    got = sample(docs, learn, per_lang).collect()
    return train([w for r in got for w in r["windows"]], [r["lang"] for r in got for _ in r["windows"]])


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    src = pick(docs, doc_id=doc_id, text=text, letters=F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False)))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(rows: pa.RecordBatch, c: T.Chunk) -> dict:
        known = column(rows, "letters").to_numpy(zero_copy_only=False).astype(bool)
        names, score = np.full(c.rows, UNKNOWN, object), np.zeros(c.rows)
        if model is not None and known.any():
            win, row, used = to_windows(c)
            p = model.probabilities(win).astype(np.float64) * used[:, None]
            total = np.zeros((c.rows, len(model.langs)))
            for k in range(len(model.langs)):
                total[:, k] = np.bincount(row, p[:, k], c.rows)
            total /= np.maximum(np.diff(c.off), 1)[:, None]
            best = total.argmax(axis=1)
            names = np.where(known, np.array(model.langs, object)[best], UNKNOWN)
            score = np.where(known, np.clip(total[np.arange(c.rows), best], 0, 1), 0.0)
        return {"doc_id": column(rows, "doc_id"), "lang_pred": pa.array(names, pa.string()), "score": score}

    return map_chunks(src, run, f"doc_id {kind}, lang_pred string, score double", lower=True)
