"""Repeated windows against a per-window version."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[k:k + n]) for _, w in words for k in range(len(w) - n + 1))
    out = []
    for i, w in words:
        gone = {j for k in range(len(w) - n + 1) if count[tuple(w[k:k + n])] > 1 for j in range(k, k + n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def run(docs, n):
    got = S.remove(docs, carry=["doc_id"], n=n).collect()
    return sorted((r["row"]["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in got)


@pytest.mark.parametrize("n", [1, 3, 35])
def test_equals_the_per_window_version(docs_of, odd_rows, n):
    assert run(docs_of(odd_rows), n) == brute(odd_rows, n)


def test_passages_shared_by_many_and_inside_one(docs_of):
    rng = random.Random(2)
    w = [f"v{i}" for i in range(400)]
    shared = rng.choices(w, k=60)
    rows = [(i, " ".join(rng.choices(w, k=50) + shared[i % 7:] + rng.choices(w, k=20))) for i in range(150)]
    rows += [(900, " ".join(shared[:34])), (901, " ".join(["again"] * 36)), (902, " ".join(["once"] * 35))]
    assert run(docs_of(rows, 7), 35) == brute(rows, 35)


def test_small_flushes_and_a_useless_sketch_change_nothing(docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(S, "cells_for", lambda words, per: 1 << 20)
    monkeypatch.setattr(S.Plane, "level", lambda self, h: h >= 0)
    monkeypatch.setattr(S, "FLUSH", 300)
    monkeypatch.setattr(S, "PER_RANGE", 500)
    monkeypatch.setattr(S, "PER_BUCKET", 3)
    assert run(docs_of(odd_rows), 5) == brute(odd_rows, 5)


def test_extra_columns_repeated_ids_and_empty_table(docs_of, odd_rows, extra_columns):
    assert run(extra_columns, 35) == brute(odd_rows, 35)
    rows = [(1, "a b c d e f"), (1, "x a b c d y"), (None, "a b c d"), (1, "x a b c d y")]
    got = sorted((r["n_words"], r["n_removed"], r["kept"]) for r in S.remove(docs_of(rows), n=4).collect())
    assert got == sorted([(6, 4, b"e f"), (6, 6, b""), (4, 4, b""), (6, 6, b"")])
    assert S.remove(docs_of([])).collect() == []


def test_rows_without_id_whose_text_hashes_share_32_bits(docs_of):
    rows = [(None, "a b c d e436434"), (None, "p904835 q r904835 s t"), (5, "a b c d z")]
    got = sorted((r["n_removed"], r["kept"]) for r in S.remove(docs_of(rows), n=4).collect())
    assert got == [(0, b"p904835 q r904835 s t"), (4, b"e436434"), (4, b"z")]


def test_equal_rows_of_one_id_send_a_position_once():
    doc, th, pos = np.array([7, 7, 7, 8], np.int64), np.array([3, 3, 3, 3], np.uint64), np.array([1, 1, 2, 1], np.int32)
    rows = S._by_document(doc, th, pos, 1)
    assert sum(len(S.unpack(r[4], np.int32)) for r in rows) == 3


def test_windows_without_a_repeated_anchor_stay_out_of_the_exchange(docs_of, monkeypatch):
    def none_expected(held, ranges, buckets):
        raise AssertionError("a single window was sent to be grouped")

    monkeypatch.setattr(S, "_flush", none_expected)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(1000))) for i in range(40)]
    assert run(docs_of(rows), 35) == brute(rows, 35)


@pytest.mark.parametrize("n", [1, 5, 16, 17, 35])
def test_a_window_keeps_its_anchor_wherever_it_stands(n):
    rng = np.random.default_rng(n)
    h = rng.integers(0, 4, 300).astype(np.uint64)  # few values: many ties
    h = np.concatenate([h, rng.integers(0, 1 << 60, 50).astype(np.uint64), h])
    anchors, serves = S._anchors(h, np.arange(len(h) - n + 1), n)
    of = np.repeat(anchors, serves)
    assert serves.sum() == len(h) - n + 1
    assert (of[:300 - n + 1] == of[350:]).all()
    k = min(n, S.GRAM)
    g = S.T.window_hashes(h, k)
    assert [int(x) for x in of] == [int(g[i:i + n - k + 1].min()) for i in range(len(of))]
    count = Counter(int(x) for x in anchors)
    assert all(count[int(x)] > 1 for x in of[350:])
