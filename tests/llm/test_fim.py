"""Fill-in-middle against a regular expression over code points."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import fim
from strata.llm import textbytes as T

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
FULL = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def plainly(doc_id, text):
    """One row by the contract, on code points."""
    t = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    u = UNIT.findall(t)
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(u), "plain", None, None, t
    if h4 % 100 < 80:
        return doc_id, len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def agrees(docs, rows):
    out = fim.transform(docs)
    got = sorted((tuple(r) for r in out.select(*FULL).collect()), key=key)
    assert got == sorted((plainly(i, t) for i, t in rows), key=key)
    back = sorted(((r[0], r[1]) for r in out.select("doc_id", fim.restore(F.col("output"), F.col("form"))).collect()), key=key)
    assert back == sorted(((i, t or "") for i, t in rows), key=key)


def test_odd_rows_with_clashing_columns(extra_columns, odd_rows):
    agrees(extra_columns, odd_rows)


def test_sentinels_white_space_null_ids_and_many_forms(docs_of):
    rng = random.Random(2)
    pool = ["<P>", "<S", ">", "<M", "M>", " ", "\n\n", "é", "漢字", "word", "\x0b", " ", "😀", "<", "a b"]
    rows = [(i, "".join(rng.choices(pool, k=rng.randint(0, 30)))) for i in range(400)]
    rows += [(None, "null id here"), (None, "null id here"), (None, None), (5, "twice the id"), (-7, " lead and trail \t")]
    agrees(docs_of(rows), rows)
    forms = {plainly(i, t)[2] for i, t in rows}
    assert forms == {"plain", "psm", "spm"}


def test_empty_table(docs_of):
    assert fim.transform(docs_of([])).collect() == []


def test_rates_and_own_sentinels(docs_of):
    rows = [(i, f"the <P> text number {i} ends here") for i in range(300)]
    out = fim.transform(docs_of(rows), rate=100, spm=0, sentinels=("[pre|", "[suf|", "[mid|"), epsilon=0)
    marks = out.select("text" if "text" in out.columns else "output", "form").collect()
    assert {r[1] for r in marks} == {"psm"} and all(r[0].startswith("[pre|") for r in marks)
    back = out.select("doc_id", fim.restore(F.col("output"), F.col("form"), ("[pre|", "[suf|", "[mid|")))
    assert sorted(tuple(r) for r in back.collect()) == rows
    with pytest.raises(ValueError):
        fim.fit(np.zeros(1, np.int64), np.array([0, 1]), 128)


@given(st.lists(st.text(alphabet=st.sampled_from(" \n\tab漢é<"), max_size=60), min_size=1, max_size=6), st.sampled_from([0, 1, 9, 127]))
@settings(max_examples=150, deadline=None)
def test_index_is_exact_and_bounded(texts, epsilon):
    [c] = T.chunks(pa.array(texts), 1 << 20)
    at, first = fim.boundaries(c)
    want = []
    for t, lo in zip(texts, c.off):
        want += np.cumsum([0] + [len(u.encode()) for u in UNIT.findall(t)]).__add__(lo).tolist()
    assert at.tolist() == want
    index = fim.fit(at, first, epsilon)
    assert index.lookup(np.arange(len(at))).tolist() == want
    assert not len(at) or np.abs(index.residual.astype(int)).max() <= epsilon


def test_uneven_text_needs_more_segments_but_fewer_than_boundaries():
    rng = random.Random(1)
    text = " ".join("x" * (rng.randint(1, 4) if i % 5000 < 4000 else rng.randint(50, 90)) for i in range(40_000))
    [c] = T.chunks(pa.array([text]), 1 << 30)
    at, first = fim.boundaries(c)
    index = fim.fit(at, first)
    assert (index.lookup(np.arange(len(at))) == at).all()
    assert 8 < len(index.start) < len(at) / 50
