"""Alignment of two tokenizers: which tokens cover the same bytes of a text.

Both token lists of a text spell the same bytes.  The end of every token is a
key: one dictionary maps the ends of the A tokens to their indexes, one those of
the B tokens.  The keys that both hold, sorted, slice the two id lists into
groups; within a group every A token is linked with every B token.  (Ends are
small integers, so each dictionary is an array addressed by the end.)

A text is cut before single spaces inside other text.  Neither tokenizer has a
token across such a place (for B this is checked on its vocabulary; otherwise
texts stay whole), so what a stretch between two cuts aligns to depends on that
stretch alone: each worker aligns a stretch once and remembers it, up to a bound.

How often a pair of ids is linked is counted over all documents in three steps:

1. The texts are written once, with the number of the *block* they lie in: some
   ``BLOCK_BYTES`` of consecutive text of one input partition.  A task counts the
   documents that hold each pair, block by block.
2. Spark sums the counts of a pair over all blocks and finds the largest count of
   each A id.
3. Each block is joined with the counts of its own pairs, and no others, so a
   task holds one block of texts and what that block needs, however large the
   corpus and its set of pairs are.

Defined results: a text that is null or empty, or whose tokens of either kind do
not spell it (B writes U+2581 as a space), has no tokens: counts of zero and the
groups ``''``.  Rows are handled one by one: repeated rows and repeated ids are
documents of their own, also in the counts.  Other columns are ignored unless
carried.  A single text must fit in a task's memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm import bpe
from strata.llm.common import column, kept_table, pick, python_ready

BLOCK_BYTES = 8 << 20
CACHE = 1 << 19          # stretches after which a worker starts anew (some 150 MB)
WIDE_GROUP = 4096        # links of a group from which they are counted, not listed
RUN_BYTES = 1 << 22      # text that is aligned at a time
FLUSH = 1 << 20          # entries that a task gathers before it merges them
B_BITS = 24              # a pair of ids is a << B_BITS | b
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s|\s\Z")
_CUT_INSIDE = regex.compile("[^▁]▁")
_ALIGNERS: dict[tuple[str, str, bool], "Aligner"] = {}


class Stretches:
    """What the stretches seen so far align to, one row each, in columns."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.ok = np.zeros(0, bool)                # tokens of both kinds spell it
        self.totals = np.zeros((0, 4), np.int64)   # n_a, n_b, n_groups, n_links
        self.groups: list[str] = []
        self.first = np.zeros(0, np.int64)         # its distinct pairs: the first, how many
        self.size = np.zeros(0, np.int64)
        self.pair = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)         # links of a pair within its stretch


class Aligner:
    """Two vocabularies and the stretches seen so far."""

    def __init__(self, path_a: str, path_b: str, named: bool = True):
        import sentencepiece
        self.named = named                         # write the groups out
        self.a = bpe.codec(path_a).enc
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        if size > 1 << B_BITS:
            raise ValueError(f"{path_b}: more than 2**{B_BITS} pieces")
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.b_len = np.array([len(p) for p in self.b_bytes], np.int64)
        self.splits = not any(_CUT_INSIDE.search(p) for p in pieces)
        self.a_len = np.zeros(self.a.n_vocab, np.int64)
        for i in self.a._mergeable_ranks.values():
            self.a_len[i] = len(self.a.decode_single_token_bytes(i))
        self.name = [str(i) for i in range(max(self.a.n_vocab, size))]
        self.name_bar = [f"{n}|" for n in self.name]
        self.seen = Stretches()

    def stretches(self, text: str) -> list[str]:
        """Space + text, cut where both tokenizers always split."""
        text = " " + text
        if not self.splits or "▁" in text:
            return [text]
        if not _WIDE.search(text):  # every space stands between two words
            return [" " + p for p in text.split(" ")[1:]]
        at = [m.start() for m in _CUT.finditer(text)]
        return [text[i:j] for i, j in zip([0, *at], [*at, len(text)])]

    def learn(self, new: list[str]) -> None:
        """Align stretches that were not seen yet."""
        if not new:
            return
        plain = [s for s in new if self.splits and not _WIDE.search(s) and s[0] == " " and "▁" not in s]
        apart = set(new).difference(plain)
        # stretches that begin and end plainly are split alike when they stand one after the other
        some = ["".join(plain[i:i + 500])[1:] for i in range(0, len(plain), 500)]
        self._learn(plain, self.a.encode_ordinary("".join(plain)), [*chain.from_iterable(self.b.encode(some, num_threads=1))] if some else [])
        for s in new:
            if s in apart:
                self._learn([s], self.a.encode_ordinary(s), self.b.encode(s[1:]))

    def _learn(self, new: list[str], a: list[int], b: list[int]) -> None:
        raw = "".join(new).encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw or self.a.decode_bytes(a) != raw:
            if len(new) > 1:  # find those that are not spelled
                for s in new:
                    self._learn([s], self.a.encode_ordinary(s), self.b.encode(s[1:]))
            else:
                self._add(new, np.zeros(1, bool), np.zeros((1, 4), np.int64), [""], np.zeros(1, np.int64), *[np.zeros(0, np.int64)] * 2)
            return
        if not new:
            return
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        cut = np.cumsum([len(s.encode()) for s in new])
        ends, a_lo, a_hi, b_lo, b_hi = slices(self.a_len[a], self.b_len[b])
        of = np.searchsorted(cut, ends)  # the stretch of each group: every cut is a shared end
        n_a, n_b = a_hi - a_lo, b_hi - b_lo
        pair, times, owner = self._pairs(a, b, a_lo, b_lo, n_a, n_b, of)
        per = [np.bincount(of, w, len(new)) for w in (n_a, n_b, np.ones(len(of)), n_a * n_b)]
        texts = self._names(a, b, a_lo, a_hi, b_lo, b_hi, of, len(new)) if self.named else []
        self._add(new, np.ones(len(new), bool), np.stack(per, 1).astype(np.int64), texts, np.bincount(owner, minlength=len(new)), pair, times)

    def _names(self, a, b, a_lo, a_hi, b_lo, b_hi, of, n: int) -> list[str]:
        """The groups of each stretch as text."""
        name = list(map(add, map(self.name_bar.__getitem__, a[a_lo].tolist()), map(self.name.__getitem__, b[b_lo].tolist())))
        for g in np.flatnonzero((a_hi - a_lo > 1) | (b_hi - b_lo > 1)).tolist():
            name[g] = ",".join([self.name[x] for x in a[a_lo[g]:a_hi[g]]]) + "|" + ",".join([self.name[y] for y in b[b_lo[g]:b_hi[g]]])
        at = np.searchsorted(of, np.arange(n + 1)).tolist()
        return [";".join(name[i:j]) for i, j in zip(at, at[1:])]

    def _pairs(self, a, b, a_lo, b_lo, n_a, n_b, of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of each stretch, how often each is linked, the stretch."""
        n = n_a * n_b
        small = np.flatnonzero(n <= WIDE_GROUP)
        m = n[small]
        step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        i, j = np.divmod(step, np.repeat(n_b[small], m))
        pair = [a[np.repeat(a_lo[small], m) + i] << B_BITS | b[np.repeat(b_lo[small], m) + j]]
        owner, times = [np.repeat(of[small], m)], [np.ones(len(step), np.int64)]
        for g in np.flatnonzero(n > WIDE_GROUP):  # few ids, many times: no list of all links
            x, k = np.unique(a[a_lo[g]:a_lo[g] + n_a[g]], return_counts=True)
            y, l = np.unique(b[b_lo[g]:b_lo[g] + n_b[g]], return_counts=True)
            pair.append((x[:, None] << B_BITS | y).ravel())
            times.append((k[:, None] * l).ravel())
            owner.append(np.full(len(x) * len(y), of[g]))
        pair, owner, times = np.concatenate(pair), np.concatenate(owner), np.concatenate(times)
        order = np.lexsort((pair, owner))
        pair, owner = pair[order], owner[order]
        first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])]) if len(pair) else np.zeros(0, np.int64)
        return pair[first], np.add.reduceat(times[order], first) if len(pair) else times, owner[first]

    def _add(self, new, ok, totals, groups, size, pair, times) -> None:
        s = self.seen
        s.index.update(zip(new, range(len(s.ok), len(s.ok) + len(new))))
        s.groups += groups
        first = len(s.pair) + np.cumsum(size) - size
        s.ok, s.totals, s.first, s.size, s.pair, s.times = (np.concatenate(x) for x in (
            (s.ok, ok), (s.totals, totals), (s.first, first), (s.size, size), (s.pair, pair), (s.times, times)))


def slices(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, ...]:
    """(ends, a_lo, a_hi, b_lo, b_hi): the shared ends in order, and the ranges of
    A and B tokens that they cut.

    The two dictionaries from an end to its token's index are addressed by the
    end itself, so their common keys come out sorted."""
    size = int(a_len.sum()) + 1
    index = []
    for n in (a_len, b_len):
        d = np.zeros(size, np.int64)
        d[np.cumsum(n)] = np.arange(1, len(n) + 1)
        index.append(d)
    ends = np.flatnonzero((index[0] > 0) & (index[1] > 0))
    a_hi, b_hi = index[0][ends], index[1][ends]
    return ends, np.r_[0, a_hi[:-1]], a_hi, np.r_[0, b_hi[:-1]], b_hi


def aligner(path_a: str, path_b: str, named: bool) -> Aligner:
    key = (path_a, path_b, named)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()  # one set of stretches in a worker
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


@dataclass
class Texts:
    """Some texts as lists of stretches (rows of ``Aligner.seen``)."""

    n: int
    text: np.ndarray         # the text of each stretch
    stretch: np.ndarray

    def sums(self, per_stretch: np.ndarray) -> np.ndarray:
        """The sum of a figure of the stretches over each text."""
        return np.bincount(self.text, per_stretch[self.stretch], self.n).astype(np.int64)


def read_texts(al: Aligner, texts: list[str | None]) -> Texts:
    """Cut the texts and align what was not seen before; a text with a stretch
    that its tokens do not spell has no stretches."""
    if len(al.seen.ok) > CACHE or len(al.seen.pair) > 8 * CACHE:
        al.seen = Stretches()
    cut = [al.stretches(t) if t else [] for t in texts]
    flat = list(chain.from_iterable(cut))
    al.learn([*set(flat).difference(al.seen.index)])
    stretch = np.array(list(map(al.seen.index.__getitem__, flat)), np.int64)
    text = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
    bad = np.unique(text[~al.seen.ok[stretch]])
    if len(bad):
        good = ~np.isin(text, bad)
        text, stretch = text[good], stretch[good]
    return Texts(len(cut), text, stretch)


def texts_with_pair(al: Aligner, t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(pair, number of these texts that hold it)."""
    seen = al.seen
    used, stretch = np.unique(t.stretch, return_inverse=True)
    key = np.unique(t.text * max(len(used), 1) + stretch)   # each text's distinct stretches
    text, stretch = np.divmod(key, max(len(used), 1))
    size = seen.size[used]
    pairs, local = np.unique(seen.pair[_spread(seen.first[used], size)], return_inverse=True)
    at = _spread((np.cumsum(size) - size)[stretch], size[stretch])
    key = np.unique(np.repeat(text, size[stretch]) * max(len(pairs), 1) + local[at])
    return pairs, np.bincount(key % max(len(pairs), 1), minlength=len(pairs)).astype(np.int64)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them), for all starts in turn."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each (or one larger row)."""
    lo, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > limit:
            yield lo, i
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        yield lo, len(sizes)


def _lengths(col: pa.Array) -> np.ndarray:
    return pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def blocks(docs: DataFrame, carry: list[str], text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, text, block), written to the shared folder: a block is at most
    ``block_bytes`` of consecutive texts of one input partition, or one text."""
    src = pick(docs, row=F.struct(*[docs[c] for c in carry]), text=text, part=F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, room = -1, 0
        for b in batches:
            ids = np.empty(b.num_rows, np.int64)
            for i, n in enumerate(_lengths(column(b, "text"))):
                if block < 0 or n > room:
                    block, room = block + 1, block_bytes
                room -= n
                ids[i] = block
            ids += column(b, "part").to_numpy().astype(np.int64) << 32
            yield pa.RecordBatch.from_arrays([column(b, "row"), column(b, "text"), pa.array(ids)], names=["row", "text", "block"])

    python_ready(docs.sparkSession)
    schema = StructType([*src.schema.fields[:2], StructField("block", LongType(), False)])
    return kept_table(src.mapInArrow(run, schema), "align-texts")


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pair, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return pair, np.bincount(back, np.concatenate([f[1] for f in found])).astype(np.int64)


def block_counts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(block, pair, n): documents of the block that hold the pair (in parts)."""
    def rows(block: int, found: list) -> pa.RecordBatch:
        pair, n = _merged(found)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(n)], names=["block", "pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b, False)
        now, found, held = None, [], 0
        for b in batches:
            block = column(b, "block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for lo, hi in zip(edges, edges[1:]):
                if lo < hi and block[lo] != now:
                    if found:
                        yield rows(now, found)
                    now, found, held = block[lo], [], 0
                texts = column(b, "text").slice(lo, hi - lo)
                for i, j in _runs(_lengths(texts), RUN_BYTES):
                    found.append(texts_with_pair(al, read_texts(al, texts.slice(i, j - i).to_pylist())))
                    held += len(found[-1][0])
                    if held > FLUSH:
                        found = [_merged(found)]
                        held = len(found[0][0])
        if found:
            yield rows(now, found)

    return texts.select("block", "text").mapInArrow(run, "block long, pair long, n long")


def pair_counts(per_block: DataFrame) -> DataFrame:
    """(pair, n_docs, is_best): documents that hold each pair, and whether no
    other pair of the same A id is held by more."""
    total = per_block.groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn("a", F.shiftright("pair", B_BITS))
    most = total.groupBy("a").agg(F.max("n_docs").alias("most"))  # at most one row for each id of vocabulary A
    return total.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def align(docs: DataFrame, path_a: str, path_b: str, carry: list[str] | None = None, text: str = "text",
          block_bytes: int = BLOCK_BYTES, hashed: bool = False) -> DataFrame:
    """The carried columns (doc_id), n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups of every whole text.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of A and B, group by group; with
    ``hashed`` its sha256 in hex takes its place (``''`` stays as it is).
    ``n_best`` counts the links whose pair is among the most frequent of its A
    id, ``count_sum`` sums the pairs' document counts over the links."""
    texts = blocks(docs, carry or ["doc_id"], text, block_bytes)
    per_block = kept_table(block_counts(texts, path_a, path_b), "align-counts")
    need = per_block.select("block", "pair").distinct().join(pair_counts(per_block), "pair")
    row_type = texts.schema["row"].dataType.simpleString()

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        al = aligner(path_a, path_b, True)
        pair = right["pair"].to_numpy()
        order = np.argsort(pair)
        pair, count, best = pair[order], right["n_docs"].to_numpy()[order], right["is_best"].to_numpy()[order]
        out = []
        for i, j in _runs(_lengths(left["text"].combine_chunks()), RUN_BYTES):
            part = left.slice(i, j - i).combine_chunks()
            t, seen = read_texts(al, part["text"].to_pylist()), al.seen
            used, t.stretch = np.unique(t.stretch, return_inverse=True)
            size = seen.size[used]
            links = _spread(seen.first[used], size)
            at = np.searchsorted(pair, seen.pair[links])
            owner = np.repeat(np.arange(len(used)), size)
            cols = [t.sums(seen.totals[used, k]) for k in range(4)]
            cols += [t.sums(np.bincount(owner, seen.times[links] * w[at], len(used))) for w in (best, count)]
            names = [seen.groups[k] for k in used.tolist()]
            ends = np.searchsorted(t.text, np.arange(t.n + 1)).tolist()
            groups = [";".join([names[k] for k in t.stretch[x:y].tolist()]) for x, y in zip(ends, ends[1:])]
            if hashed:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            out.append(pa.Table.from_arrays([part["row"], *[pa.array(c) for c in cols], pa.array(groups, pa.string())],
                                            names=["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]))
        return pa.concat_tables(out)

    schema = f"row {row_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return texts.groupBy("block").cogroup(need.groupBy("block")).applyInArrow(whole, schema) \
        .select("row.*", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
