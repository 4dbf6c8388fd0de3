"""Toxicity: a support vector machine on a subsequence string kernel.

A text is a bag of sentences, a sentence a bag of *windows*: its words, reduced
to letters (other characters count as inserted and are skipped), and runs of
three or more single letters as one window, so ``i.d.i.o.t`` and ``i d i o t``
read like ``idiot``.

The kernel of two windows counts their common subsequences of ``ORDERS`` letters
(the ends of a window are symbols too).  A subsequence that skips letters counts
``DECAY`` for each, at most ``GAPS``, so one with letters inserted or left out
still shares most of its subsequences with the word it hides.  Windows are scaled
to unit length, each occurrence of a subsequence counting by itself.

Training (multiple-instance, in numpy, on a bounded sample of labelled texts):
every sentence has the label of its text.  A toxic text must have at least one
window on the toxic side, its *witness*; all windows of a clean text must lie on
the other.  Witnesses first come from the log-odds of letter sequences, then
from the model itself, round by round.  *Landmarks* are frequent, mutually
unlike witnesses and the clean windows most like them.  The Nyström map of the
landmarks gives every window a short vector, and a linear hinge-loss model is
fitted on the vectors of witnesses, of copies of them with a letter inserted,
doubled or left out, and of the hardest clean windows.

The kernel is a sum over subsequences, so the model of landmarks and weights
collapses into one weight per subsequence: scoring a window is a few table
lookups a letter and needs no landmark.  A text's score is a logistic curve of
its highest window, placed by texts held back from training.

Bounds (parameters): ``per_class`` labelled texts of each class, those with the
smallest hashes of the id, of at most ``max_chars`` characters.  Scoring reads
whole texts.

Defined results: a text without letters (null and empty too) scores as one whose
windows are as far on the clean side as any in training; without labels of both
classes every score is the share of class 1 (0.5 without any label).  Rows are
scored one by one; ids may repeat or be null; other columns are ignored unless
carried.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbytes as T
from strata.llm.common import column, map_chunks, pick, smallest

ORDERS = (3, 4)
GAPS = 2
DECAY = 0.6
LANDMARKS = 256
ALIKE = 0.7            # kernel value from which two landmarks are too much alike
COST = 20_000          # of all errors of one class
SYMBOLS = 32
EDGE = 27              # before and after a window
CHUNK_BYTES = 1 << 22


def _code_table() -> np.ndarray:
    """Letters a-z (either case) are 1 to 26, bytes beyond ASCII 28 to 31 by their
    low bits, which upper and lower case letters share; 0 is skipped."""
    t = np.zeros(256, np.uint8)
    t[97:123] = t[65:91] = np.arange(1, 27)
    t[128:] = 28 + (np.arange(128) & 3)
    return t


CODES = _code_table()


def patterns() -> list[tuple[tuple[int, ...], float]]:
    """(offsets of the letters of a subsequence, its weight)."""
    out = []
    for n in ORDERS:
        for steps in product(range(1, GAPS + 2), repeat=n - 1):
            skipped = sum(steps) - (n - 1)
            if skipped <= GAPS:
                out.append(((0, *np.cumsum(steps).tolist()), DECAY ** skipped))
    return out


PATTERNS = patterns()
BASE = {n: sum(SYMBOLS ** k for k in ORDERS if k < n) for n in ORDERS}  # where the ids of an order begin
FEATURES = sum(SYMBOLS ** n for n in ORDERS)


@dataclass
class Windows:
    """Distinct windows as one run of symbols, and where each begins."""

    symbols: np.ndarray     # uint8: per window EDGE, letters, EDGE, then GAPS + 1 zeros
    start: np.ndarray
    size: np.ndarray        # letters and edges

    @property
    def scale(self) -> np.ndarray:
        """1 / length of each window's vector of occurrences."""
        square = sum(w * w * np.maximum(self.size - at[-1], 0) for at, w in PATTERNS)
        return 1 / np.sqrt(np.maximum(square, 1e-9))

    def occurrences(self):
        """(positions, feature ids, weight) of each pattern."""
        s = self.symbols.astype(np.int32)
        for at, w in PATTERNS:
            n = len(s) - at[-1]
            if n <= 0:
                continue
            ids = s[:n].copy()
            whole = s[:n] > 0
            for a in at[1:]:
                ids *= SYMBOLS
                ids += s[a:a + n]
                whole &= s[a:a + n] > 0
            p = np.flatnonzero(whole)  # a window is followed by more zeros than a pattern can skip
            yield p, ids[p] + BASE[len(at)], w

    def take(self, which: np.ndarray) -> "Windows":
        return windows_of([self.symbols[i:i + n] for i, n in zip(self.start[which], self.size[which])])

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """The sum of a weight per feature over each window's occurrences."""
        if not len(self.start):
            return np.zeros(0)
        total = np.zeros(len(self.symbols))
        for p, ids, w in self.occurrences():
            total[p] += w * weight[ids]
        return np.add.reduceat(total, self.start)


def windows_of(parts: list[np.ndarray]) -> Windows:
    """Windows from symbol runs that have their edges."""
    size = np.array([len(p) for p in parts], np.int64)
    start = np.cumsum(size + GAPS + 1) - (size + GAPS + 1)
    out = np.zeros(int((size + GAPS + 1).sum()), np.uint8)
    for p, i in zip(parts, start):
        out[i:i + len(p)] = p
    return Windows(out, start, size)


@dataclass
class Read:
    """The windows of a chunk: distinct ones, and every occurrence in order."""

    distinct: Windows
    which: np.ndarray      # distinct window of each occurrence
    row: np.ndarray
    start: np.ndarray      # bytes of the chunk
    end: np.ndarray


def read(c: T.Chunk) -> Read:
    w = T.words(c)
    sym = CODES[c.buf]
    ink = sym > 0
    before = np.zeros(len(ink) + 1, np.int64)
    np.cumsum(ink, out=before[1:])
    lo, hi, row = before[w.start], before[w.end], w.row
    start, end = w.start, w.end
    # runs of at least three single letters of one row are one window
    n = hi - lo
    some = n > 0
    lo, hi, row, start, end, n = lo[some], hi[some], row[some], start[some], end[some], n[some]
    if len(n):
        single = n == 1
        fresh = np.r_[True, ~(single[1:] & single[:-1] & (row[1:] == row[:-1]))]
        run = np.cumsum(fresh) - 1
        long = np.bincount(run)[run] >= 3
        head = fresh | ~long
        last = np.r_[head[1:], True]
        lo, hi, row, start, end = lo[head], hi[last], row[head], start[head], end[last]
    letters = sym[ink]
    words = T.Words(lo, hi, np.array([0, len(lo)]))
    h = T.word_hashes(T.Chunk(0, 1, letters, np.array([0, len(letters)])), words)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    a, size = lo[first], (hi - lo)[first]
    full = size + 2 + GAPS + 1
    at = np.cumsum(full) - full
    symbols = np.zeros(int(full.sum()), np.uint8)
    symbols[at] = symbols[at + size + 1] = EDGE
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    symbols[np.repeat(at + 1, size) + step] = letters[np.repeat(a, size) + step]
    return Read(Windows(symbols, at, size + 2), which, row, start, end)


@dataclass
class Model:
    """A weight per subsequence, an intercept, and the logistic curve."""

    weight: np.ndarray
    intercept: float
    slope: float
    shift: float
    lowest: float          # the margin of a text without windows

    def margins(self, w: Windows) -> np.ndarray:
        return w.sums(self.weight) * w.scale + self.intercept

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))

    def best(self, c: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(margin, start, end) of each row's highest window."""
        r = read(c)
        margin = np.full(c.rows, self.lowest)
        start = np.zeros(c.rows, np.int64)
        end = np.zeros(c.rows, np.int64)
        if len(r.row):
            m = self.margins(r.distinct)[r.which]
            rows, first = np.unique(r.row, return_index=True)
            top = np.maximum.reduceat(m, first)
            hit = np.flatnonzero(m == np.repeat(top, np.diff(np.r_[first, len(m)])))
            _, at = np.unique(r.row[hit], return_index=True)  # the first of ties
            margin[rows], start[rows], end[rows] = top, r.start[hit[at]], r.end[hit[at]]
        return margin, start, end


def kernel(w: Windows, landmarks: Windows) -> np.ndarray:
    """Windows x landmarks."""
    ids = [np.concatenate([np.stack([p, f]) for p, f, _ in landmarks.occurrences()], 1),
           np.concatenate([np.full(len(p), x) for p, _, x in landmarks.occurrences()])]
    owner = np.searchsorted(landmarks.start, ids[0][0], side="right") - 1
    used, col = np.unique(ids[0][1], return_inverse=True)
    share = np.zeros((len(used) + 1, len(landmarks.start)))
    np.add.at(share, (col, owner), ids[1] * landmarks.scale[owner])
    place = np.full(FEATURES, len(used), np.int32)  # the last row of share is zero
    place[used] = np.arange(len(used))
    out = np.zeros((len(w.start), len(landmarks.start)))
    for p, f, x in w.occurrences():
        c = place[f]
        hit = c < len(used)
        own = np.searchsorted(w.start, p[hit], side="right") - 1
        rows, first = np.unique(own, return_index=True)
        for lo in range(0, len(rows), 2000):
            hi = min(lo + 2000, len(rows))
            a, b = first[lo], first[hi] if hi < len(rows) else len(own)
            out[rows[lo:hi]] += x * np.add.reduceat(share[c[hit][a:b]], first[lo:hi] - a)
    return out * w.scale[:, None]


def hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise |w|^2 / 2 + sum cost * max(0, 1 - y f)^2,
    by Newton steps on the rows inside the margin."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        inside = 1 - y * (x1 @ w) > 0
        a = x1[inside]
        new = np.linalg.solve(ridge + 2 * (a * cost[inside, None]).T @ a, 2 * (a * cost[inside, None]).T @ y[inside])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w[:-1], float(w[-1])


def curve(margin: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve: a half where the fewest texts, weighted
    to the class shares, are on the wrong side (the middle of the widest such
    gap); its width follows the distance of the class medians."""
    order = np.argsort(margin, kind="stable")
    m, one = margin[order], y[order] == 1
    missed = np.r_[0.0, np.cumsum(one)] * prior / max(one.sum(), 1)
    false = np.r_[np.cumsum(~one[::-1])[::-1], 0.0] * (1 - prior) / max((~one).sum(), 1)
    at = np.flatnonzero(np.isclose(missed + false, (missed + false).min()))
    low, high = np.r_[m[0] - 1, m][at], np.r_[m, m[-1] + 1][at]
    k = int(np.argmax(high - low))
    slope = 6 / max(float(np.median(m[one]) - np.median(m[~one])), 0.5)
    return slope, -slope * float(low[k] + high[k]) / 2


@dataclass
class Sample:
    """Labelled texts as sets of windows."""

    windows: Windows
    text: np.ndarray       # the distinct windows of each text, by text
    window: np.ndarray
    y: np.ndarray

    def top(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest value among each text's windows, and that window."""
        order = np.lexsort((value[self.window], self.text))
        last = np.searchsorted(self.text[order], np.arange(len(self.y)), side="right") - 1
        return value[self.window[order][last]], self.window[order][last]


def sample_of(texts: list[str], y: list[int]) -> Sample:
    [c] = T.chunks(pa.array(texts, pa.large_string()), 1 << 62)
    r = read(c)
    n = max(len(r.distinct.start), 1)
    text, window = np.divmod(np.unique(r.row * n + r.which), n)
    have = np.unique(text)  # texts without any letter teach nothing
    return Sample(r.distinct, np.searchsorted(have, text), window, np.array(y)[have])


def log_odds(s: Sample, use: np.ndarray) -> np.ndarray:
    """A first value of each window: how much more often its letter sequences
    occur in toxic texts (texts are counted, not occurrences)."""
    sym = s.windows.symbols.astype(np.int64)
    n = max(ORDERS)
    ids, whole = np.zeros(max(len(sym) - n + 1, 0), np.int64), np.ones(max(len(sym) - n + 1, 0), bool)
    for a in range(n):
        part = sym[a:a + len(ids)]
        ids, whole = ids * SYMBOLS + part, whole & (part > 0)
    at = np.flatnonzero(whole)
    owner = np.searchsorted(s.windows.start, at, side="right") - 1
    used, f = np.unique(ids[at], return_inverse=True)
    count = np.bincount(owner, minlength=len(s.windows.start))
    begin = np.cumsum(count) - count
    toxic = np.zeros((2, len(used)))
    for k in (0, 1):
        rows = (s.y[s.text] == k) & use[s.text]
        w, t = s.window[rows], s.text[rows]
        m = count[w]
        pos = np.repeat(begin[w] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        key = np.unique(np.repeat(t, m) * len(used) + f[pos])
        toxic[k] = np.bincount(key % len(used), minlength=len(used))
    n1, n0 = max((s.y[use] == 1).sum(), 1), max((s.y[use] == 0).sum(), 1)
    odds = np.log((toxic[1] + 0.5) / (n1 + 1)) - np.log((toxic[0] + 0.5) / (n0 + 1))
    odds[toxic[1] < 2] = 0.0
    return np.bincount(owner, odds[f], len(s.windows.start)) / np.sqrt(np.maximum(count, 1))


def unlike(s: Sample, ids: np.ndarray, n: int) -> np.ndarray:
    """The first n of some windows, in the given order, none much like one before."""
    ids = ids[:8 * n]
    w = s.windows.take(ids)
    k = kernel(w, w)
    chosen: list[int] = []
    for i in range(len(ids)):
        if len(chosen) < n and all(k[i, j] < ALIKE for j in chosen):
            chosen.append(i)
    return ids[chosen]


def witnesses(s: Sample, value: np.ndarray, use: np.ndarray) -> np.ndarray:
    """The highest window of each toxic text."""
    return s.top(value)[1][use & (s.y == 1)]


def set_apart(s: Sample, value: np.ndarray, clean: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Windows of toxic texts (with repeats) that no clean text has and that lie
    above all but one in 10,000 of the clean texts' windows."""
    high = np.quantile(value[clean], 0.9999)
    fresh = ~np.isin(np.arange(len(value)), clean) & (value > high)
    return s.window[use[s.text] & (s.y[s.text] == 1) & fresh[s.window]]


def altered(w: Windows, rng: np.random.Generator) -> tuple[Windows, np.ndarray]:
    """Copies of windows with one letter inserted, doubled or left out, and the
    window that each is a copy of."""
    out, owner = [], []
    for k, (i, n) in enumerate(zip(w.start, w.size)):
        run = w.symbols[i:i + n]
        if n < 6:  # too short to stay itself
            continue
        for at in rng.integers(2, n - 1, 3).tolist():
            out.append(np.insert(run, at, rng.integers(1, 27)))
        out.append(np.insert(run, at, run[at - 1]))
        if n > 6:
            out.append(np.delete(run, at - 1))
        owner += [k] * (len(out) - len(owner))
    return windows_of(out), np.array(owner, np.int64)


def train(s: Sample, prior: float, landmarks: int = LANDMARKS, rounds: int = 3, hard: int = 8000, seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    held = rng.random(len(s.y)) < 0.2
    for k in (0, 1):  # both classes on both sides where there are two texts of each
        of = np.flatnonzero(s.y == k)
        held[of[0]] = len(of) > 1
        if held[of].all():
            held[of[1:]] = False
    use = ~held
    value = log_odds(s, use)
    clean = np.unique(s.window[(s.y[s.text] == 0) & use[s.text]])
    model, first = None, set_apart(s, value, clean, use)
    for _ in range(rounds):
        witness = np.r_[first, witnesses(s, value, use)]  # what the log-odds set apart stays
        often, times = np.unique(witness, return_counts=True)
        good = unlike(s, often[np.lexsort((often, -times))], landmarks // 2)
        near = Model(np.bincount(np.concatenate([f for _, f, _ in s.windows.take(good).occurrences()]),
                                 minlength=FEATURES).clip(0, 1).astype(float), 0.0, 1.0, 0.0, 0.0) if model is None else model
        order = np.argsort(-near.margins(s.windows)[clean], kind="stable")
        negative = np.unique(np.r_[clean[order[:hard]], rng.choice(clean, min(hard // 3, len(clean)), replace=False)])
        marks = s.windows.take(np.r_[good, unlike(s, clean[order], landmarks - landmarks // 2)])
        scale, axes = np.linalg.eigh(kernel(marks, marks))
        keep = scale > 1e-3
        nystrom = axes[:, keep] / np.sqrt(scale[keep])
        seen, times = np.unique(witness[~np.isin(witness, clean)], return_counts=True)
        copies, source = altered(s.windows.take(seen), rng)
        k = np.concatenate([kernel(w, marks) for w in (s.windows.take(seen), copies, s.windows.take(negative))])
        y = np.r_[np.ones(len(seen) + len(copies.start)), -np.ones(len(negative))]
        cost = np.r_[np.sqrt(times), 0.3 * np.sqrt(times[source]), np.full(len(negative), 1.0)]
        for sign in (1, -1):
            cost[y == sign] *= COST / max(cost[y == sign].sum(), 1e-9)
        v, b = hinge(k @ nystrom, y, cost)
        beta = nystrom @ v
        weight = np.zeros(FEATURES)
        for p, f, x in marks.occurrences():
            own = np.searchsorted(marks.start, p, side="right") - 1
            np.add.at(weight, f, x * beta[own] * marks.scale[own])
        model = Model(weight, b, 1.0, 0.0, 0.0)
        value = model.margins(s.windows)
    top = s.top(value)[0]
    check = held if min((held & (s.y == k)).sum() for k in (0, 1)) >= 20 else np.ones(len(s.y), bool)
    slope, shift = curve(top[check], s.y[check], prior)
    return Model(weight, b, slope, shift, float(min(top[s.y == 0].min(), -1.0)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 1000, max_chars: int = 20_000) -> Model:
    """Learn from the label rows where ``learn`` (on labels.doc_id) holds."""
    lab = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", F.lit(17)).alias("h")) \
        .filter(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    n = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = n.get(1, 0) / sum(n.values()) if n else 0.5
    chosen = smallest(lab, "toxic", "h", per_class).select("doc_id", "toxic")  # at most 2 * per_class rows
    rows = pick(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id") \
        .filter(F.length("text") <= max_chars).select("toxic", "text").collect()
    got = sorted((r["toxic"], r["text"]) for r in rows if CODES[np.frombuffer(r["text"].encode(), np.uint8)].any())
    if len({t for t, _ in got}) < 2:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(np.zeros(FEATURES), 0.0, 1.0, float(np.log(p / (1 - p))), 0.0)
    return train(sample_of([t for _, t in got], [k for k, _ in got]), prior)


def score(docs: DataFrame, model: Model, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """The carried columns (doc_id), score, evidence (the highest window as it
    stands in the text; null without one) of every whole text."""
    src = pick(docs, row=F.struct(*[docs[c] for c in carry or ["doc_id"]]), text=text)
    kind = src.schema["row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(
        Model(model.weight.astype(np.float32), model.intercept, model.slope, model.shift, model.lowest))  # 4 MB: FEATURES weights

    def run(rows: pa.RecordBatch, c: T.Chunk) -> dict:
        m = shared.value
        margin, lo, hi = m.best(c)
        raw = c.buf.tobytes()
        found = pa.array([raw[i:j] if j > i else None for i, j in zip(lo.tolist(), hi.tolist())], pa.binary())
        return {"row": column(rows, "row"), "score": m.probability(margin), "evidence": found.cast(pa.string())}

    return map_chunks(src, run, f"row {kind}, score double, evidence string", limit=CHUNK_BYTES).select("row.*", "score", "evidence")
