"""Interpolated modified Kneser-Ney language model, counted in Spark.

A text's tokens are its words (A-Z lower-cased) and one end.  The model is a
bigram model, interpolated with the continuation unigram and that with the
uniform distribution over the vocabulary and one unknown word:

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v.) + g(v) * p1(w)
    p1(w)    = max(k(w) - D(k(w)), 0) / k(.)   + g1   / (V + 1)

with k(w) the number of different words before w and, at both levels, modified
Kneser-Ney discounts D(1), D(2), D(3+) estimated from counts of counts.

Counting: every task reduces its texts to (word, count) and then (pair, count)
in bounded flushes, cut into ranges of the word hash; Spark shuffles the pieces
by range and one grouped call per range adds them up.  Pieces are distinct per
flush, so a word of any frequency reaches its range once per flush.  The pairs
of a first word seen fewer than ``HOT`` times stay in that word's range; those of
a more frequent one are spread over all ranges by a hash of the pair, so that no
range grows with the share of one word.  Context totals are added up per word
in a second, small step, where a word is one entry per range.

Storage: each range becomes a file of sorted arrays in the cluster's shared
folder: word hashes with their statistics, and pairs packed as (rank of first
word, rank of second word), ascending.  Workers memory-map the files and look
words and pairs up by binary search over sorted needles.  Where the folder is a
store that is not mounted, a worker reads the files it needs into memory
instead; no machine-local copy is made.  The driver only sees one row of totals
per range.

Defined results: a null or empty text is one token, the end.  Without training
texts every probability is uniform over one unknown word (log 0).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, map_chunks, pick, python_ready
from strata.llm.sketch import pack, pack_sorted, unpack, unpack_sorted
from strata.session import shared_dir

END = np.uint64(0x2545F4914F6CDD1D)   # stands for the end in hash space
FLUSH = 1 << 21
BYTES_PER_RANGE = 16 << 20            # text bytes per range, about
HOT = 1 << 16                         # a first word's pairs are spread from this count on
_SHIFT = np.uint64(32)
TOTAL, CONTEXT, BEFORE = range(3)     # kinds of rows between the two steps of counting pairs
_OPEN: dict[str, "Store"] = {}


def _tokens(c: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows (words, then the end) and each row's first."""
    w = T.words(c)
    h = T.word_hashes(c, w)
    first = w.first + np.arange(c.rows + 1)
    out = np.full(int(first[-1]), END, np.uint64)
    word = np.ones(len(out), bool)
    word[first[1:] - 1] = False
    out[word] = h
    return out, first


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> _SHIFT) * np.uint64(parts) >> _SHIFT).astype(np.int64)


def _pieces(keys: np.ndarray, counts: np.ndarray, part: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, keys, counts) of ascending distinct keys whose parts ascend too."""
    cut = np.searchsorted(part, np.arange(parts + 1))
    full = np.flatnonzero(np.diff(cut))
    return pa.RecordBatch.from_arrays(
        [pa.array(full.astype(np.int32)), pa.array([pack_sorted(keys[cut[k]:cut[k + 1]]) for k in full], pa.binary()),
         pa.array([pack(counts[cut[k]:cut[k + 1]].astype(np.uint32)) for k in full], pa.binary())], names=["part", "a", "b"])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c, first)


def _narrow(c: np.ndarray) -> np.ndarray:
    """Counts in 4 bytes where they fit, else in 8."""
    return c.astype(np.uint32 if not len(c) or c.max() < 1 << 32 else np.uint64)


def _counts(raw: np.ndarray, n: int) -> np.ndarray:
    """n counts as _narrow stored them."""
    return raw.view(np.uint32 if raw.size == 4 * n else np.uint64)


def _put(base: str, name: str, *arrays: np.ndarray) -> None:
    """Write arrays one after the other as one file; a retry replaces it."""
    fs, path = pafs.FileSystem.from_uri(base)
    temp = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(temp) as f:
        for a in arrays:
            f.write(memoryview(np.ascontiguousarray(a)).cast("B") if len(a) else b"")
    fs.move(temp, f"{path}/{name}")


def _map(base: str, name: str) -> np.ndarray:
    """The bytes of a file: memory-mapped, or read where it cannot be mapped."""
    fs, path = pafs.FileSystem.from_uri(base)
    path = f"{path}/{name}"
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with fs.open_input_stream(path) as f:
        return np.frombuffer(f.read(), np.uint8)


class Store:
    """The files of one model, as a worker sees them."""

    def __init__(self, base: str, words: list[int], hot: int, pairs: list[int] | None = None):
        self.base = base
        self.hot = hot
        self.n = np.array(words, np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.n)])
        self.pair_n = pairs
        self._w: dict[int, np.ndarray] = {}
        self._p: dict[int, tuple] = {}
        self._s: dict[int, tuple] = {}

    @classmethod
    def open(cls, base: str, words: list[int], hot: int, pairs: list[int] | None = None) -> "Store":
        key = f"{base}?{pairs is not None}"
        if key not in _OPEN:
            _OPEN.clear()
            _OPEN[key] = cls(base, words, hot, pairs)
        return _OPEN[key]

    def words(self, part: int) -> np.ndarray:
        if part not in self._w:
            self._w[part] = _map(self.base, f"words-{part}")
        return self._w[part]

    def rank(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or -1, training count) of ascending distinct word hashes."""
        rank, count = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        part = _part(h, len(self.n))
        cut = np.searchsorted(part, np.arange(len(self.n) + 1))
        for k in np.flatnonzero(np.diff(cut)):
            n = self.n[k]
            if n:
                raw = self.words(k)
                own, need = raw[:8 * n].view(np.uint64), h[cut[k]:cut[k + 1]]
                at = np.minimum(np.searchsorted(own, need), n - 1)
                hit = own[at] == need
                rank[cut[k]:cut[k + 1]] = np.where(hit, self.offset[k] + at, -1)
                count[cut[k]:cut[k + 1]] = np.where(hit, _counts(raw[8 * n:], n)[at], 0)
        return rank, count

    def seen(self, rank: np.ndarray) -> np.ndarray:
        """Training count of ascending ranks."""
        out = np.zeros(len(rank), np.int64)
        cut = np.searchsorted(rank, self.offset)
        for k in np.flatnonzero(np.diff(cut)):
            n = self.n[k]
            out[cut[k]:cut[k + 1]] = _counts(self.words(k)[8 * n:], n)[rank[cut[k]:cut[k + 1]] - self.offset[k]]
        return out

    def part_of(self, rank: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offset, rank, side="right") - 1

    def pair_part(self, key: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The range of each pair key; ``count`` is that of its first word."""
        home = self.part_of((key >> _SHIFT).astype(np.int64))
        return np.where(count >= self.hot, _part(T.mix(key), len(self.n)), home)

    def pairs(self, key: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Training count of ascending pair keys (0 where absent), given the
        counts of their first words."""
        out = np.zeros(len(key), np.int64)
        part = self.pair_part(key, count)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(len(self.n) + 1))
        for k in np.flatnonzero(np.diff(cut)):
            n = self.pair_n[k]
            if n:
                if k not in self._p:
                    raw = _map(self.base, f"pairs-{k}")
                    self._p[k] = raw[:8 * n].view(np.uint64), _counts(raw[8 * n:], n)
                own, counts = self._p[k]
                i = order[cut[k]:cut[k + 1]]
                at = np.minimum(np.searchsorted(own, key[i]), n - 1)
                out[i] = np.where(own[at] == key[i], counts[at], 0)
        return out

    def stats(self, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(context total, N1, N2, N3+, continuation count) of ranks; 0 for -1."""
        out = np.zeros((5, len(rank)), np.int64)
        order = np.argsort(rank, kind="stable")
        sort = rank[order]
        cut = np.searchsorted(self.part_of(sort), np.arange(len(self.n) + 1))
        for k in np.flatnonzero(np.diff(cut)):
            if k not in self._s:
                n = self.n[k]
                self._s[k] = (_counts(_map(self.base, f"context-{k}"), 4 * n).reshape(4, n),
                              _counts(_map(self.base, f"before-{k}"), n))
            context, before = self._s[k]
            i = order[cut[k]:cut[k + 1]]
            at = rank[i] - self.offset[k]
            out[:4, i] = context[:, at]
            out[4, i] = before[at]
        return tuple(out)


@dataclass
class Model:
    """What scoring needs: where the files are and the few global numbers."""

    base: str
    words: list[int]
    pairs: list[int]
    hot: int                  # count from which a first word's pairs are spread
    tokens: int               # N: tokens of the training texts
    vocab: int                # V: distinct training tokens
    pair_discount: list[float]
    word_discount: list[float]
    before_total: int         # distinct pairs
    word_gamma: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, each within
    0 and its count; where counts of counts are missing, 0.5, 0.75 and 0.9."""
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return [min(max(x, 1e-3), k - 1e-3) for k, x in enumerate(d, 1)]


def _count_words(train: DataFrame, base: str, parts: int) -> tuple[list[int], int]:
    """Write words-<part> (hashes, counts); the words of each part and all tokens."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            k, c = _summed(keys, counts)
            keys.clear()
            counts.clear()
            return _pieces(k, c, _part(k, parts), parts)

        for b in batches:
            for c in T.chunks(column(b, "text"), lower=True):
                k, n = np.unique(_tokens(c)[0], return_counts=True)
                keys.append(k)
                counts.append(n)
                size += len(k)
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def add(key: tuple, t: pa.Table) -> pa.Table:
        k, c = _summed([unpack_sorted(x) for x in t["a"].to_pylist()], [unpack(x, np.uint32) for x in t["b"].to_pylist()])
        _put(base, f"words-{key[0].as_py()}", k, _narrow(c))
        return pa.table({"part": t["part"].slice(0, 1).combine_chunks(), "n": pa.array([len(k)], pa.int64()),
                         "total": pa.array([int(c.sum())], pa.int64())})

    got = train.mapInArrow(partial, "part int, a binary, b binary").groupBy("part") \
        .applyInArrow(add, "part int, n long, total long").collect()
    n = [0] * parts
    for r in got:
        n[r["part"]] = r["n"]
    return n, sum(r["total"] for r in got)


def _count_pairs(train: DataFrame, base: str, words: list[int], hot: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Write pairs-<part>, context-<part> and before-<part>.

    Returns the pairs of each part, the pairs seen 1, 2, 3 and 4 times, and of
    the continuation counts their sum, how many are 3 or more, and how many are
    1, 2, 3 and 4; the statistics of single words stay in the files.
    """
    parts = len(words)
    offset = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store.open(base, words, hot)
        keys, counts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            k, c = _summed(keys, counts)
            keys.clear()
            counts.clear()
            first = (k >> _SHIFT).astype(np.int64)
            head = np.flatnonzero(np.diff(first, prepend=-1))
            part = store.pair_part(k, np.repeat(store.seen(first[head]), np.diff(np.append(head, len(k)))))
            order = np.argsort(part, kind="stable")
            return _pieces(k[order], c[order], part[order], parts)

        for b in batches:
            for c in T.chunks(column(b, "text"), lower=True):
                tok, first = _tokens(c)
                u, inv = np.unique(tok, return_inverse=True)
                rank = store.rank(u)[0][inv].astype(np.uint64)
                k, n = np.unique(_pair_keys(rank, first), return_counts=True)
                keys.append(k)
                counts.append(n)
                size += len(k)
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def add(key: tuple, t: pa.Table) -> pa.Table:
        """One range of pairs: its file; what it holds of first and of second
        words goes on as pieces for the ranges of those words."""
        part = key[0].as_py()
        k, c = _summed([unpack_sorted(x) for x in t["a"].to_pylist()], [unpack(x, np.uint32) for x in t["b"].to_pylist()])
        _put(base, f"pairs-{part}", k, _narrow(c))
        first = (k >> _SHIFT).astype(np.int64)
        head = np.flatnonzero(np.diff(first, prepend=-1))
        context = np.stack([np.add.reduceat(x.astype(np.int64), head) for x in (c, c == 1, c == 2, c >= 3)])
        first = first[head]
        cut = np.searchsorted(first, offset)
        full = np.flatnonzero(np.diff(cut))
        contexts = pa.table({"kind": pa.array([CONTEXT] * len(full), pa.int32()), "part": pa.array(full, pa.int32()),
                             "a": pa.array([pack_sorted(first[cut[i]:cut[i + 1]].astype(np.uint64)) for i in full], pa.binary()),
                             "b": pa.array([pack(context[:, cut[i]:cut[i + 1]].ravel()) for i in full], pa.binary())})
        second, before = np.unique((k & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        spread = np.searchsorted(offset, second, side="right") - 1
        pieces = _pieces(second.astype(np.uint64), before, spread, parts)
        befores = pa.table({"kind": pa.array([BEFORE] * len(pieces), pa.int32()), "part": pieces.column(0), "a": pieces.column(1),
                            "b": pieces.column(2)})
        coc = [int((c == i).sum()) for i in (1, 2, 3, 4)]
        total = pa.table({"kind": pa.array([TOTAL], pa.int32()), "part": pa.array([part], pa.int32()), "a": pa.array([b""], pa.binary()),
                          "b": pa.array([np.array([len(k), *coc], np.int64).tobytes()], pa.binary())})
        return pa.concat_tables([contexts, befores, total])

    def gather(key: tuple, t: pa.Table) -> pa.Table:
        """One range of words: its context statistics or its continuation counts."""
        kind, part = key[0].as_py(), key[1].as_py()
        if kind == TOTAL:
            return t.select(["kind", "part", "b"]).rename_columns(["kind", "part", "c"])
        at = [unpack_sorted(x).astype(np.int64) - offset[part] for x in t["a"].to_pylist()]
        out = b""
        if kind == CONTEXT:
            context = np.zeros((4, words[part]), np.int64)
            for i, x in zip(at, t["b"].to_pylist()):
                context[:, i] += unpack(x, np.int64).reshape(4, -1)
            _put(base, f"context-{part}", _narrow(context.ravel()))
        else:
            full = np.zeros(words[part], np.int64)
            for i, x in zip(at, t["b"].to_pylist()):
                full[i] += unpack(x, np.uint32)
            _put(base, f"before-{part}", _narrow(full))
            coc = [int((full == i).sum()) for i in (1, 2, 3, 4)]
            out = np.array([int(full.sum()), int((full >= 3).sum()), *coc], np.int64).tobytes()
        return pa.table({"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32()), "c": pa.array([out], pa.binary())})

    pairs = train.mapInArrow(partial, "part int, a binary, b binary").groupBy("part") \
        .applyInArrow(add, "kind int, part int, a binary, b binary")
    got = pairs.groupBy("kind", "part").applyInArrow(gather, "kind int, part int, c binary").collect()
    n, pair_coc, word_coc = [0] * parts, np.zeros(4, np.int64), np.zeros(6, np.int64)
    for r in got:
        v = np.frombuffer(r["c"], np.int64)
        if r["kind"] == TOTAL:
            n[r["part"]] = int(v[0])
            pair_coc += v[1:]
        elif r["kind"] == BEFORE:
            word_coc += v
    return n, pair_coc, word_coc


def _pair_keys(rank: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(rank before << 32 | rank) of every token; the end token's rank also
    stands before a text's first token (an end only ever precedes a text)."""
    prev = np.empty_like(rank)
    prev[1:] = rank[:-1]
    starts = first[:-1]
    prev[starts] = rank[first[1:] - 1]
    return (prev << _SHIFT) | rank


def fit(docs: DataFrame, learn: Column, text: str = "text") -> Model:
    """Count the texts of all rows where ``learn`` holds and store the model."""
    spark = docs.sparkSession
    python_ready(spark)
    train = docs.filter(learn).select(F.coalesce(docs[text], F.lit("")).alias("text"))
    base = shared_dir(spark, "language-model")
    fs, path = pafs.FileSystem.from_uri(base if "://" in base or base.startswith("file:") else f"file://{base}")
    base = base if "://" in base or base.startswith("file:") else f"file://{base}"
    fs.create_dir(path, recursive=True)
    mass = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-mass // BYTES_PER_RANGE))
    words, tokens = _count_words(train, base, parts)
    for k in range(parts):
        if not words[k]:
            _put(base, f"words-{k}")
            _put(base, f"context-{k}")
            _put(base, f"before-{k}")
    hot = HOT
    pairs, pair_coc, word_coc = _count_pairs(train, base, words, hot)
    pd_, wd = discounts(*map(int, pair_coc)), discounts(*map(int, word_coc[2:]))
    total = int(word_coc[0])
    gamma = (wd[0] * word_coc[2] + wd[1] * word_coc[3] + wd[2] * word_coc[1]) / total if total else 1.0
    return Model(base, words, pairs, hot, tokens, sum(words), pd_, wd, total, float(gamma))


def _discount(c: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    src = pick(docs, doc_id=doc_id, text=F.coalesce(docs[text], F.lit("")))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(rows: pa.RecordBatch, c: T.Chunk) -> dict:
        store = Store.open(model.base, model.words, model.hot, model.pairs)
        tok, first = _tokens(c)
        u, inv = np.unique(tok, return_inverse=True)
        rank_u, count_u = store.rank(u)
        total_u, n1, n2, n3, before_u = store.stats(rank_u)
        d = model.pair_discount
        gamma_u = np.where(total_u > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / np.maximum(total_u, 1), 1.0)
        uniform = model.word_gamma / (model.vocab + 1)
        p1_u = np.maximum(before_u - _discount(before_u, model.word_discount), 0) / max(model.before_total, 1) + uniform

        prev = np.empty_like(inv)
        prev[1:] = inv[:-1]
        prev[first[:-1]] = inv[first[1:] - 1]
        known = (rank_u[inv] >= 0) & (rank_u[prev] >= 0)
        key = (rank_u[prev].astype(np.uint64) << _SHIFT) | rank_u[inv].astype(np.uint64)
        seen, at, back = np.unique(key[known], return_index=True, return_inverse=True)
        first_count = count_u[prev[known]][at]
        pair = np.zeros(len(tok), np.int64)
        pair[known] = store.pairs(seen, first_count)[back]
        high = np.maximum(pair - _discount(pair, d), 0) / np.maximum(total_u[prev], 1)
        p = high + gamma_u[prev] * p1_u[inv]
        base = np.log10((count_u + 1) / (model.tokens + 1 * (model.vocab + 1)))
        return {"doc_id": column(rows, "doc_id"), "n_tokens": np.diff(first),
                "n_known": np.add.reduceat((count_u > 0)[inv].astype(np.int64), first[:-1]),
                "train_tokens": np.full(c.rows, model.tokens), "base_score": np.add.reduceat(base[inv], first[:-1]),
                "score": np.add.reduceat(np.log10(p), first[:-1])}

    return map_chunks(src, run, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
                      lower=True)
