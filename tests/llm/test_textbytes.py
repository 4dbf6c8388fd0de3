"""Byte-level words and hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import textbytes as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b #", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 60))
def test_words_match_the_pattern(rows, limit):
    got = [None] * len(rows)
    for c in T.chunks(pa.array(rows, pa.string()), limit):
        w = T.words(c)
        raw = c.buf.tobytes()
        for r in range(c.rows):
            got[c.lo + r] = [raw[a:b].decode() for a, b in zip(w.start[w.first[r]:w.first[r + 1]], w.end[w.first[r]:w.first[r + 1]])]
    assert got == [WORD.findall(t or "") for t in rows]


def test_equal_words_and_windows_hash_alike_wherever_they_stand():
    text = "alpha beta gamma alpha beta gamma delta"
    c = next(T.chunks(pa.array(["zz", text])))
    w = T.words(c)
    h = T.word_hashes(c, w)
    words = ["zz", *text.split()]
    assert [len(set(h[[i for i, x in enumerate(words) if x == y]].tolist())) for y in set(words)] == [1] * 5
    assert len(set(h.tolist())) == 5
    win = T.window_hashes(h, 3)
    assert win[1] == win[4] and len(set(win.tolist())) == len(win) - 1


def test_window_starts_stay_inside_a_row():
    c = next(T.chunks(pa.array(["a b c", "d e", "", "f g h i"])))
    w = T.words(c)
    assert T.window_starts(w, 3).tolist() == [0, 5, 6]
    assert T.window_starts(w, 9).tolist() == []


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(T.mix(x))) == len(x)
