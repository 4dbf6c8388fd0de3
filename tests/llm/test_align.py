"""Tokenizer alignment against whole-text encoding with the two libraries."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import align as A
from strata.llm.bpe import byte_letters
from strata.llm.queries import tokenizer_path

PATHS = (tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def one(libraries, text):
    """(a ids, b ids, groups as index ranges) of a whole text, or nothing."""
    lib_a, lib_b = libraries
    a = lib_a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = lib_b.encode(text) if text else []
    letters = byte_letters()
    a_bytes = [bytes(letters[c] for c in lib_a.id_to_token(i)) for i in a]
    pieces = [lib_b.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if lib_b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    want = (" " + (text or "")).encode()
    if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return [], [], []
    groups, i, j, x, y, start = [], 0, 0, 0, 0, (0, 0)
    while i < len(a) or j < len(b):  # walk both lists by bytes
        if x <= y and i < len(a):
            x += len(a_bytes[i])
            i += 1
        else:
            y += len(b_bytes[j])
            j += 1
        if x == y:
            groups.append((start, (i, j)))
            start = (i, j)
    return a, b, groups


def plainly(libraries, rows):
    found, held = [], Counter()
    for doc_id, text in rows:
        a, b, groups = one(libraries, text)
        links = [(p, q) for (i0, j0), (i1, j1) in groups for p in a[i0:i1] for q in b[j0:j1]]
        held.update(set(links))
        found.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    return [(i, len(a), len(b), len(g), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
             ";".join(f"{','.join(map(str, a[i0:i1]))}|{','.join(map(str, b[j0:j1]))}" for (i0, j0), (i1, j1) in g))
            for i, a, b, g, links in found]


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def agrees(libraries, docs, rows, **kw):
    got = sorted((tuple(r) for r in A.align(docs, *PATHS, **kw).select(*COLS).collect()), key=key)
    assert got == sorted(plainly(libraries, rows), key=key)


def test_odd_rows_with_clashing_columns(libraries, extra_columns, odd_rows):
    agrees(libraries, extra_columns, odd_rows)


def test_scripts_specials_and_white_space_in_small_blocks(libraries, docs_of):
    rng = random.Random(4)
    pool = ["the", " ", "  ", "\n", "\t", "naïve", "漢字", "😀", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", " a", "don't", "123", "é",
            " ", "\x1c", "\x00", "word", "Ünder", "　", "ﬁ", "xxxxxxxxxxxxxxxx", ".", " ▁", "…"]
    rows = [(i, "".join(rng.choices(pool, k=rng.randint(0, 40)))) for i in range(300)]
    rows += [(None, "no id here"), (None, "no id here"), (None, None), (7, "twice the id"), (301, "a" * 5000), (302, "ab " * 3000), (303, "▁"), (304, "plain words only")]
    agrees(libraries, docs_of(rows, 5), rows, block_bytes=500)


def test_whole_texts_of_the_tables(libraries, spark):
    from conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    agrees(libraries, docs, rows, block_bytes=1 << 16)


def test_digest_and_empty_table(spark, docs_of):
    import hashlib
    rows = [(1, "two words"), (2, ""), (3, None)]
    plain = {r["doc_id"]: r["groups"] for r in A.align(docs_of(rows), *PATHS).collect()}
    hashed = {r["doc_id"]: r["groups"] for r in A.align(docs_of(rows), *PATHS, hashed=True).collect()}
    assert plain[2] == plain[3] == hashed[2] == hashed[3] == ""
    assert hashed[1] == hashlib.sha256(plain[1].encode()).hexdigest()
    assert A.align(docs_of([]), *PATHS).collect() == []


def test_links_of_a_wide_group_are_counted():
    al = A.Aligner(*PATHS)
    a, b = np.array([5, 6] * 50 + [7]), np.array([8] * 60 + [9])
    pair, times, owner = al._pairs(a, b, np.array([0]), np.array([0]), np.array([101]), np.array([61]), np.array([0]))
    got = {(int(p) >> A.B_BITS, int(p) & ((1 << A.B_BITS) - 1)): int(n) for p, n in zip(pair, times)}
    assert got == {(x, y): k * m for x, k in ((5, 50), (6, 50), (7, 1)) for y, m in ((8, 60), (9, 1))} and not owner.any()


def test_stretches_start_anew_after_the_bound(monkeypatch):
    monkeypatch.setattr(A, "CACHE", 50)
    al = A.Aligner(*PATHS)
    for k in range(5):
        texts = [" ".join(f"w{i * j + k}x" for j in range(20)) for i in range(15)]
        A.read_texts(al, texts)
        assert len(al.seen.ok) <= 50 + 15 * 20  # the bound, then one call's own
