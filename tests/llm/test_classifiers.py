"""Held-out accuracy and defined results of the two trained classifiers."""

import random

import duckdb
import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import lang_id as L
from strata.llm import quality_model as Q
from strata.llm import textbytes as T
from strata.llm.queries import QUERIES


def test_language_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, SF01).collect()}
    rows = duckdb.sql(f"SELECT doc_id, lang, text FROM '{SF01}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    held = [(got[i]["lang_pred"], lang) for i, lang, _ in rows if got[i]["held_out"]]
    assert len(held) > 200 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_quality_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_quality_classifier"](spark, SF01).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall()
    held = [(got[i]["predicted"], q) for i, q in labels if got[i]["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_language_edge_rows(docs_of, odd_rows, extra_columns):
    learn = [(100 + i, ("der die und das nicht " if i % 2 else "the of and that with ") * 9, "de" if i % 2 else "en") for i in range(40)]
    model = L.fit(docs_of(learn), F.lit(True), per_lang=20)
    for docs in (docs_of(odd_rows), extra_columns):
        got = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in L.predict(docs, model).collect())
        assert [g[0] for g in got] == sorted(i for i, _ in odd_rows)
        by = {g[0]: g[1:] for g in got}
        assert by[1] == by[2] == by[3] == ("und", 0.0)
        assert {p for i, (p, _) in by.items() if i > 3} <= {"de", "en"}
    probe = docs_of([(1, "und das nicht"), (2, "that with the"), (3, "12 + 34"), (4, "é")])
    assert [r["lang_pred"] for r in L.predict(probe, model).orderBy("doc_id").collect()][:3] == ["de", "en", "und"]
    assert L.predict(docs_of([]), model).collect() == []


def test_language_without_labels(docs_of):
    docs = docs_of([(1, "some text", None), (2, None, "en"), (3, "77", "en")])
    assert L.fit(docs, F.lit(True)) is None
    assert [(r["lang_pred"], r["score"]) for r in L.predict(docs, None).collect()] == [("und", 0.0)] * 3


def test_pair_tables_equal_the_plain_convolution():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc déf"), 300)) for _ in range(6)]
    m = L.train(texts, ["a", "b"] * 3, epochs=1)
    win = L.encode_windows(texts)
    pooled = []
    for w, f in zip(L.WIDTHS, m.conv):
        n = L.WINDOW - w + 1
        pooled.append(sum(f[k][win[:, k:k + n]] for k in range(w)).max(axis=1))
    want = L.softmax(np.maximum(np.concatenate(pooled, 1) + m.bias, 0) @ m.out + m.out_bias)
    assert m.probabilities(win) == pytest.approx(want, abs=1e-5)


def test_windows_hold_every_byte():
    rows = ["", "x" * L.WINDOW, "y" * (L.WINDOW + 1), "é" * 300]
    c = next(T.chunks(T.pa.array(rows)))
    win, row, used = L.to_windows(c)
    back = [b"".join(win[i, :used[i]].tobytes() for i in np.flatnonzero(row == r)) for r in range(4)]
    assert back == [r.encode() for r in rows]


def test_quality_edge_rows(spark, docs_of, odd_rows, extra_columns):
    rng = random.Random(3)
    good = [(1000 + i, " ".join(rng.choices(["river", "stone", "walks", "under", "green"], k=60))) for i in range(60)]
    bad = [(2000 + i, " ".join(rng.choices(["BUY!!", "NOW!!", "###", "$$$"], k=60))) for i in range(60)]
    docs = docs_of(good + bad + odd_rows)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (1, None, 0), (99999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = Q.fit(docs, labels, F.lit(True), per_class=50)
    got = {r["doc_id"]: r["score"] for r in Q.score(docs_of(good + bad), model).collect()}
    assert min(got[i] for i, _ in good) > max(got[i] for i, _ in bad)
    for d in (docs_of(odd_rows), extra_columns):
        s = Q.score(d, model).collect()
        assert len(s) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in s)
    assert Q.score(docs_of([]), model).collect() == []
    one = Q.fit(docs, labels.filter("quality = 1"), F.lit(True))
    assert {round(r["score"], 3) for r in Q.score(docs_of(odd_rows), one).collect()} == {1.0}
    none = Q.fit(docs, labels.filter("false"), F.lit(True))
    assert {r["score"] for r in Q.score(docs_of(odd_rows), none).collect()} == {0.5}


def test_indicators_are_distinct_and_stay_in_their_row():
    rows = ["", "one", "same same same same", None, "Mixed CASE 12 ##"]
    c = next(T.chunks(T.pa.array(rows)))
    row, bucket = Q.indicators(c)
    assert len({*zip(row.tolist(), bucket.tolist())}) == len(row)
    for i, t in enumerate(rows):
        if t:
            alone = Q.indicators(next(T.chunks(T.pa.array([t]))))[1]
            assert sorted(bucket[row == i].tolist()) == sorted(alone.tolist())
    assert set(row.tolist()) == {1, 2, 4}


@pytest.mark.parametrize("text", ["the end.", "what!", "x.", "caf\u00e9", "a B9", "."])
def test_the_last_text_of_a_chunk_has_the_indicators_it_has_elsewhere(text):
    rows = [text, "between", text]
    row, bucket = Q.indicators(next(T.chunks(T.pa.array(rows))))
    assert sorted(bucket[row == 0].tolist()) == sorted(bucket[row == 2].tolist())
