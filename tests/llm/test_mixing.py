"""The mixture's targets, blocks and counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes, weights, most=3):
    """Share by weight; what is above a ceiling goes round again."""
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while free and left > 1e-9:
        w = sum(weights[i] for i in free)
        give = {i: left * weights[i] / w for i in free}
        left = 0.0
        for i, g in give.items():
            out[i] += g
            if out[i] >= most * sizes[i]:
                left += out[i] - most * sizes[i]
                out[i] = most * sizes[i]
                free.discard(i)
    return out


def test_targets_equal_repeated_resharing():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 12)
        sizes = [rng.choice([0, 1, rng.randint(1, 50), rng.randint(1, 100_000)]) for _ in range(n)]
        w = [M.WEIGHTS[i % 3] for i in range(n)]
        assert M.targets(sizes, w, sum(sizes)) == pytest.approx(reshared(sizes, w), abs=1e-4)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4099])
def test_feistel_is_a_permutation_that_depends_on_the_key(n):
    a = M.feistel(np.arange(n), np.full(n, n), np.full(n, 5, np.uint64))
    b = M.feistel(np.arange(n), np.full(n, n), np.full(n, 6, np.uint64))
    assert sorted(a) == list(range(n)) == sorted(b)
    assert n < 60 or (a != b).mean() > 0.5


def corpus(seed=3, docs=400):
    rng = random.Random(seed)
    rows = []
    for i in range(docs):
        s = rng.choice(["b", "a", "a", "a", "c", "Z", "é", None])
        text = None if rng.random() < 0.02 else " ".join(f"d{i}w{k}" for k in range(rng.choice([0, 1, 5, 40, 130, 300])))
        rows.append((i, text, "en", s))
    return rows


def test_counts_targets_and_ceiling(docs_of):
    rows = corpus()
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    per = Counter()
    for i, _, _, s in rows:
        per[s] += size[i]
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(order, reshared([per[s] for s in order], [M.WEIGHTS[k % 3] for k in range(len(order))])))
    first = sorted(tuple(r) for r in M.Mixture(docs_of(rows)).taken().drop("row_id", "source").collect())
    again = sorted(tuple(r) for r in M.Mixture(docs_of(rows, 7)).taken().drop("row_id", "source").collect())
    assert first == again and len(first) == len(rows)
    source = {i: s for i, _, _, s in rows}
    taken = Counter()
    for doc, n, total, target, got in first:
        assert n == size[doc] and total == per[source[doc]] and target == pytest.approx(want[source[doc]])
        assert 0 <= got <= 3 * n
        taken[source[doc]] += got
    for s in order:
        assert abs(taken[s] - want[s]) <= max(3 * M.BLOCK, 0.02 * want[s])


def test_blocks_are_the_slots_and_texts_are_the_words(docs_of):
    rows = corpus(5, 150)
    docs = docs_of(rows)
    mix = M.Mixture(docs, texts=True, block=16, slots=50)
    parts = mix.blocks().collect()
    slots = mix.slots.collect()
    assert len({(r["src"], r["slot"]) for r in slots}) == len(slots) == mix.table["slots"].sum()
    per = defaultdict(int)
    for r in slots:
        per[r["shard"]] += 1
    assert all(n == 50 for n in list(dict(sorted(per.items())).values())[:-1])  # every shard but the last is full
    seen = Counter((r["src"], r["epoch"], r["index"]) for r in slots)
    assert set(seen.values()) == {1}                          # an epoch takes a block once
    text = {i: t for i, t, *_ in rows}
    words = Counter()
    for r in parts:
        words.update(WORD.findall(text[r["doc_id"]])[r["first"]:r["first"] + r["n"]])
    out = mix.texts()
    assert out.columns == docs.columns
    got = Counter(w for r in out.collect() for w in r["text"].split())
    assert got == words and max(got.values()) <= 3
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_small_buckets_place_the_same_blocks(docs_of, monkeypatch):
    rows = corpus(8, 200)
    monkeypatch.setattr(M, "BUCKET_ROWS", 11)
    mix = M.Mixture(docs_of(rows), block=10)
    cover = defaultdict(int)
    for r in mix.pieces.collect():
        cover[(r["src"], r["index"])] += r["n"]
    blocks = dict(zip(mix.table["src"], mix.table["blocks"]))
    last = {s: b - 1 for s, b in blocks.items()}
    assert all(n == 10 or i == last[s] for (s, i), n in cover.items())
    assert len(cover) == sum(blocks.values())


def test_edge_tables(docs_of, odd_rows, extra_columns):
    assert M.Mixture(docs_of([])).taken().collect() == []
    nothing = M.Mixture(docs_of([(1, None), (2, "")])).taken().collect()
    assert [(r["size"], r["taken"], r["target"]) for r in nothing] == [(0, 0, 0.0)] * 2
    got = M.Mixture(extra_columns).taken().collect()
    assert len(got) == len(odd_rows)
    assert sorted(r["size"] for r in got) == sorted(len(WORD.findall(t or "")) for _, t in odd_rows)
    out = M.Mixture(extra_columns, texts=True).texts()
    assert out.columns == extra_columns.columns and out.count() > 0


def test_long_texts_cost_in_proportion(docs_of):
    """Twice the words of one document, of which every second block is taken,
    must not cost four times as much (the text is split once, not per part)."""
    import time
    took = []
    for words in (60_000, 120_000):
        rows = [(1, " ".join(f"w{i}" for i in range(words)), "en", "a"), (2, " ".join(["x"] * words), "en", "b")]
        mix = M.Mixture(docs_of(rows, 1), block=50, texts=True)
        mix.slots = mix.slots.filter("index % 2 = 0").cache()
        parts = mix.blocks().groupBy("row_id").count().agg({"count": "max"}).first()[0]
        assert parts > words / 200
        start = time.perf_counter()
        mix.texts().write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - start)
    assert took[1] < 3 * took[0] + 2
