"""The subsequence kernel against a plain count, and the model on held-out texts."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import string_kernel as K
from strata.llm import textbytes as T
from strata.llm.queries import op11_toxicity


def chunk(*texts):
    [c] = T.chunks(pa.array(texts), 1 << 30)
    return c


def counts(word):
    """Weight of each subsequence, and the square of the vector of occurrences."""
    s, out, square = [K.EDGE, *word, K.EDGE], defaultdict(float), 0.0
    for n in K.ORDERS:
        for at in combinations(range(len(s)), n):
            skipped = at[-1] - at[0] - (n - 1)
            if skipped <= K.GAPS:
                out[tuple(s[i] for i in at)] += K.DECAY ** skipped
                square += K.DECAY ** (2 * skipped)
    return out, square


def spelled(w):
    return [tuple(w.symbols[i + 1:i + n - 1].tolist()) for i, n in zip(w.start, w.size)]


def test_kernel_is_that_of_all_common_subsequences():
    rng = random.Random(3)
    r = K.read(chunk(" ".join("".join(rng.choices("abé", k=rng.randint(1, 9))) for _ in range(40))))
    words = spelled(r.distinct)
    got = K.kernel(r.distinct, r.distinct.take(np.arange(0, len(words), 3)))
    for i, x in enumerate(words):
        for j, y in enumerate(words[::3]):
            (a, xx), (b, yy) = counts(x), counts(y)
            want = sum(a[u] * b[u] for u in a.keys() & b.keys()) / np.sqrt(max(xx, 1e-9) * max(yy, 1e-9))
            assert got[i, j] == pytest.approx(want, abs=1e-9)


def test_table_of_subsequences_equals_landmarks_and_weights():
    rng = np.random.default_rng(2)
    r = K.read(chunk("stupid idiot clown i.d.i.o.t the winding stup id owl clowning"))
    marks = r.distinct.take(np.array([0, 2, 4]))
    beta = rng.normal(size=3)
    weight = np.zeros(K.FEATURES)
    for p, f, x in marks.occurrences():
        own = np.searchsorted(marks.start, p, side="right") - 1
        np.add.at(weight, f, x * beta[own] * marks.scale[own])
    m = K.Model(weight, 0.25, 1.0, 0.0, 0.0)
    assert m.margins(r.distinct) == pytest.approx(K.kernel(r.distinct, marks) @ beta + 0.25)


def test_windows_skip_marks_and_join_single_letters():
    def letters(text):
        r = K.read(chunk(text))
        s = spelled(r.distinct)
        return ["".join(chr(96 + x) for x in s[k]) for k in r.which]
    assert letters("I.D.i-o*t 12 a") == ["idiot", "a"]
    assert letters("you i d i o t now") == ["you", "idiot", "now"]
    assert letters("a b cd") == ["a", "b", "cd"]
    assert letters("") == [] == letters("12 ... 3")
    r = K.read(chunk("i d", "i o t"))  # runs end with their text
    assert r.row.tolist() == [0, 0, 1]


def test_hinge_separates_and_curve_finds_the_gap():
    x = np.array([[2.0, 0], [3, 1], [-1, 0], [-2, 1]])
    y = np.array([1.0, 1, -1, -1])
    v, b = K.hinge(x, y, np.full(4, 100.0))
    assert ((x @ v + b) * y > 0.8).all()
    slope, shift = K.curve(np.array([-1.0, 0.0, 2.0, 3.0]), np.array([0, 0, 1, 1]), 0.5)
    assert slope > 0 and -shift / slope == pytest.approx(1.0)


def made_texts(seed, n=260):
    """Texts of random words; a third holds one of four insults, inflected."""
    rng = random.Random(seed)
    part = ["ba", "lo", "ti", "ren", "so", "ka", "mi", "du", "pel", "wo"]
    word = lambda: "".join(rng.choices(part, k=rng.randint(1, 4)))
    rows = []
    for i in range(n):
        ws = [word() for _ in range(rng.randint(10, 60))]
        bad = int(i % 3 == 0)
        for _ in range(2 * bad):
            ws.insert(rng.randint(0, len(ws)), rng.choice(["snarfle", "grumbo", "vexhead", "quizzer"]) + rng.choice(["", "s", "ish"]))
        rows.append((i, " ".join(ws) + ".", bad))
    return rows


@pytest.fixture(scope="module")
def made():
    rows = made_texts(1)
    return K.train(K.sample_of([r[1] for r in rows], [r[2] for r in rows]), 1 / 3, landmarks=64, hard=2000)


def test_unseen_texts_and_hidden_insults(made):
    rows = made_texts(2)
    margin, _, _ = made.best(chunk(*[r[1] for r in rows]))
    hit = made.probability(margin) >= 0.5
    assert (hit == np.array([r[2] for r in rows], bool)).mean() > 0.98
    for hidden in ("g.r.u.m.b.o", "g r u m b o", "Grumbo!", "snarfling snarfle", "vexxhead", "s-n-a-r-f-l-e", "snarffle"):
        clean, text = "lo ren bati soka mi", f"lo ren bati {hidden} soka mi"
        m, lo, hi = made.best(chunk(clean, text))
        assert made.probability(m)[1] >= 0.5 > made.probability(m)[0], hidden
        assert (clean + text)[lo[1]:hi[1]] in (hidden, *hidden.split())  # the evidence, in bytes of the chunk


def test_a_text_scores_alike_alone_and_in_any_chunk(made):
    texts = [r[1] for r in made_texts(4, 40)] + ["", "..."]
    together, _, _ = made.best(chunk(*texts))
    alone = [made.best(chunk(t))[0][0] for t in texts]
    assert together == pytest.approx(alone)
    assert together[-1] == together[-2] == made.lowest


def test_training_repeats_exactly():
    s = K.sample_of(*zip(*[(r[1], r[2]) for r in made_texts(5, 90)]))
    a, b = (K.train(s, 0.3, landmarks=32, hard=500) for _ in range(2))
    assert (a.weight == b.weight).all() and (a.slope, a.shift) == (b.slope, b.shift)


def test_odd_rows_and_clashing_columns(spark, extra_columns, odd_rows, made):
    got = K.score(extra_columns, made).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in odd_rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"]: r["evidence"] for r in got}[1] is None  # a null text
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[1] == score[2] == score[3] and score[8] == score[9] == score[10]


def test_missing_classes_null_ids_and_empty_tables(spark, docs_of):
    docs = docs_of([(1, "some text"), (2, "more text"), (None, "no id"), (None, None)])
    schema = "doc_id long, quality int, toxic int, text string, h string"
    for rows, want in (([], 0.5), ([(1, 1, 0, "x", "y"), (2, 1, 0, "x", "y")], 0.0), ([(1, 1, 1, "x", "y"), (None, 1, 0, "x", "y")], 1.0),
                       ([(7, 1, None, "x", "y")], 0.5)):
        model = K.fit(docs, spark.createDataFrame(rows, schema), F.lit(True))
        got = K.score(docs, model).collect()
        assert len(got) == 4 and all(r["score"] == pytest.approx(want, abs=1e-5) for r in got)
    assert K.score(docs_of([]), model).collect() == []


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    out = op11_toxicity(spark, SF01).cache()
    assert out.count() == docs.count()
    held = out.filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.93  # 57 toxic rows learnt from or held out
    assert 0 < out.agg(F.sum("predicted")).first()[0] < 0.3 * docs.count()
