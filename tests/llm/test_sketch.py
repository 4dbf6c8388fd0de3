"""The count-min sketch never understates, whatever its size."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import docs_of  # noqa: F401
from strata.llm import sketch as K
from strata.llm import textbytes as T


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, K.RANGE - 1), max_size=60, unique=True).map(sorted))
def test_gaps_round_trip(cells):
    a = np.array(cells, np.int64)
    assert K.unpack_gaps(K.pack_gaps(a)).tolist() == cells


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=40).map(sorted))
def test_packed_arrays_round_trip(values):
    a = np.array(values, np.uint64)
    assert K.unpack(K.pack(a), np.uint64).tolist() == values
    assert K.unpack_sorted(K.pack_sorted(a)).tolist() == values


@pytest.mark.parametrize("rows,levels,flush", [(1, (2,), 1 << 22), (2, (2,), 50), (1, (2, 8, 64), 30)])
def test_levels_bound_the_true_counts(docs_of, monkeypatch, rows, levels, flush):
    texts = [(i, " ".join([f"w{j}" for j in range(i % 90)] + ["hot"] * 3)) for i in range(200)]
    monkeypatch.setattr(K, "FLUSH", flush)
    values = lambda c: T.word_hashes(c, T.words(c))
    cells = K.cells_for(5000, 1)
    bits = 1 if len(levels) == 1 else 2
    plane = K.Plane(K.merged(docs_of(texts, 5), values, cells, rows, 255, levels=levels), cells, rows, bits)
    count = Counter(w for _, t in texts for w in t.split())
    exact = 0
    for w, n in count.items():
        c = next(T.chunks(T.pa.array([w])))
        got, want = int(plane.level(values(c))[0]), sum(n >= x for x in levels)
        assert got >= want
        exact += got == want
    assert exact >= len(count) - 2


def test_sketch_of_nothing(docs_of):
    cells = K.cells_for(0, 2)
    raw = K.merged(docs_of([(1, None), (2, "")]), lambda c: T.word_hashes(c, T.words(c)), cells)
    assert not any(raw) and K.Plane(raw, cells).level(np.array([3, 4], np.uint64)).tolist() == [0, 0]
