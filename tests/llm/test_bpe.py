"""BPE ids against the tokenizers library, and the joins of halved texts."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import bpe as B
from strata.llm.queries import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


MESSY = st.text(alphabet=st.one_of(st.sampled_from(list("aaabcdE 012.,!'\n\t#é 　ß日")),
                                   st.characters(blacklist_categories=("Cs",), max_codepoint=0x2FFF)), max_size=120)


@settings(max_examples=150, deadline=None)
@given(MESSY)
def test_ids_equal_the_library(text):
    from tokenizers import Tokenizer
    lib = test_ids_equal_the_library.__dict__.setdefault("lib", Tokenizer.from_file(PATH))
    c = B.codec(PATH)
    want = ids_of(lib, text)
    assert c.encode(text) == want
    assert B.encode_text(c, text, 8) == want       # cut wherever possible
    assert c.decode(want) == lib.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abehnrst", min_size=2, max_size=400), st.integers(2, 40))
def test_tree_joins_of_one_unsplit_run_are_exact(run, limit):
    c = B.codec(PATH)
    parts = [c.run(x) for x in B._halves(run.encode(), limit)]
    assert B.join_tree(c, parts) == c.run(run.encode())


def test_special_token_text_and_vocabulary(library):
    c = B.codec(PATH)
    for t in ("a<|endoftext|> b", "<|endoftext|>", "x" * 50 + "<|endoftext|>" * 3 + " y", "<|endof text|>"):
        assert B.encode_text(c, t, 10) == c.encode(t) == ids_of(library, t)
    for t in random.Random(1).sample(sorted(json.load(open(PATH))["model"]["vocab"]), 3000):
        raw = bytes(B.byte_letters()[x] for x in t) if "<|" not in t else t.encode()
        try:
            s = raw.decode()
        except UnicodeDecodeError:
            continue
        assert c.encode(s) == ids_of(library, s)


def test_distributed_form_over_odd_rows(docs_of, odd_rows, extra_columns, library):
    rows = odd_rows + [(40, "z" * 5000 + " end"), (41, "\n" * 3000 + "x" + " " * 3000), (42, "!?" * 4000), (None, "no id")]
    want = sorted(((i if i is not None else -1), ids_of(library, t)) for i, t in rows)
    for split in (B.SPLIT_CHARS, 1000):
        got = B.encode(docs_of(rows), PATH, split_chars=split, decoded=True).collect()
        assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), list(r["ids"])) for r in got) == want
        text = {tuple(ids_of(library, t)): t or "" for _, t in rows}
        assert all(r["decoded"] == text[tuple(r["ids"])] for r in got)
    assert B.encode(extra_columns, PATH).columns == ["doc_id", "ids"]
    assert B.encode(extra_columns, PATH).count() == len(odd_rows)


def test_decode_round_trip_and_empty_table(docs_of, odd_rows):
    e = B.encode(docs_of(odd_rows), PATH)
    got = {r["doc_id"]: r["decoded"] for r in B.decode(e, PATH).collect()}
    assert all(got[i] == (t or "") for i, t in odd_rows)
    assert B.encode(docs_of([]), PATH).collect() == []


def test_other_vocabularies_are_refused(tmp_path):
    spec = {"model": {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}}
    p = tmp_path / "t.json"
    p.write_text(json.dumps(spec))
    with pytest.raises((ValueError, KeyError)):
        B.Codec(str(p))
