"""Model scores against a plain Python model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import kneser_ney as K
from strata.llm.common import crc_remainder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
END = "</s>"


def tokens(t):
    return WORD.findall((t or "").translate(LOWER)) + [END]


class Plain:
    def __init__(self, texts):
        self.uni, self.pair = Counter(), Counter()
        for t in texts:
            prev = END
            for w in tokens(t):
                self.uni[w] += 1
                self.pair[prev, w] += 1
                prev = w
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        before = Counter(w for _, w in self.pair)
        coc = lambda c: [Counter(c.values())[k] for k in (1, 2, 3, 4)]
        self.d, self.d1 = [0, *K.discounts(*coc(self.pair))], [0, *K.discounts(*coc(before))]
        self.total, self.back = Counter(), defaultdict(float)
        for (a, _), c in self.pair.items():
            self.total[a] += c
            self.back[a] += self.d[min(c, 3)]
        self.before, self.k = before, sum(before.values())
        self.g1 = sum(self.d1[min(c, 3)] for c in before.values()) / self.k if self.k else 1.0

    def p1(self, w):
        c = self.before[w]
        return max(c - self.d1[min(c, 3)], 0) / max(self.k, 1) + self.g1 / (self.v + 1)

    def p(self, a, w):
        if a not in self.total:
            return self.p1(w)
        c = self.pair[a, w]
        return (max(c - self.d[min(c, 3)], 0) + self.back[a] * self.p1(w)) / self.total[a]

    def row(self, t):
        tok = tokens(t)
        base = sum(math.log10((self.uni[w] + 1) / (self.n + self.v + 1)) for w in tok)
        score = sum(math.log10(self.p(a, w)) for a, w in zip([END, *tok], tok))
        return len(tok), sum(self.uni[w] > 0 for w in tok), self.n, base, score


def check(docs, rows, learn):
    model = K.fit(docs, learn(F.col("doc_id")))
    plain = Plain([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    got = sorted(tuple(r) for r in K.score(docs, model).collect())
    want = sorted((i, *plain.row(t)) for i, t in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)
    return model, plain


@pytest.mark.parametrize("flush,per_range", [(1 << 21, 16 << 20), (40, 5000)])
def test_scores_equal_a_plain_model(docs_of, odd_rows, monkeypatch, flush, per_range):
    monkeypatch.setattr(K, "BYTES_PER_RANGE", per_range)
    monkeypatch.setattr(K, "FLUSH", flush)
    check(docs_of(odd_rows), odd_rows, lambda _: crc_remainder("doc_id", 7) != 2)


def test_extra_columns(extra_columns, odd_rows):
    check(extra_columns, odd_rows, lambda _: crc_remainder("doc_id", 7) != 2)


def test_probabilities_sum_to_one(docs_of, odd_rows):
    plain = Plain([t for _, t in odd_rows])
    vocab = list(plain.uni)
    for a in (*vocab[:5], END, "never seen"):
        assert sum(plain.p(a, w) for w in vocab) + plain.p(a, "unknown word") == pytest.approx(1)


def test_nothing_to_learn_and_empty_table(docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    got = sorted(tuple(r) for r in K.score(docs, K.fit(docs, F.lit(False))).collect())
    assert got == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    empty = docs_of([])
    assert K.score(empty, K.fit(empty, F.lit(True))).collect() == []


def test_pairs_of_a_hot_first_word_are_spread_over_the_ranges(docs_of, monkeypatch):
    monkeypatch.setattr(K, "BYTES_PER_RANGE", 4000)
    monkeypatch.setattr(K, "HOT", 100, raising=False)
    rows = [(i, " ".join(f"the n{40 * i + k}" for k in range(40))) for i in range(100)]
    model, plain = check(docs_of(rows), rows, lambda _: crc_remainder("doc_id", 7) != 2)
    after = sum(a == "the" for a, _ in plain.pair)
    assert len(model.pairs) > 5 and after > 0.4 * len(plain.pair)
    assert sum(model.pairs) == len(plain.pair)
    assert max(model.pairs) < 2 * len(plain.pair) / len(model.pairs)


def test_discounts_stay_inside_their_counts():
    for n in ((0, 0, 0, 0), (5, 0, 0, 0), (5, 3, 0, 0), (1, 50, 3, 90), (1000, 400, 200, 100)):
        assert all(0 < d < k for k, d in enumerate(K.discounts(*n), 1))
