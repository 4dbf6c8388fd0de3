"""The length histogram against lists of lengths."""

import random

import numpy as np
import pytest

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import bpe
from strata.llm import token_counts as C
from strata.llm.queries import tokenizer_path


def check(spark, lens):
    table = C.limits(C.histogram(spark.createDataFrame([(x,) for x in lens], "n_tokens long"))).cache()
    rows = {r["n_tokens"]: r for r in table.collect()}
    a = np.array(lens)
    assert set(rows) == set(lens)
    for limit, r in rows.items():
        cut = np.minimum(a, limit).sum()
        assert (r["n_docs"], r["docs_at_least"], r["docs_longer"], r["docs_upto"]) == \
            ((a == limit).sum(), (a >= limit).sum(), (a > limit).sum(), (a <= limit).sum())
        assert (r["truncated_tokens"], r["lost_tokens"], r["total_tokens"], r["total_docs"]) == (cut, a.sum() - cut, a.sum(), len(a))
    for limit in (0, 1, 7, 5000, 10 ** 6):
        assert C.truncated_total(table, limit).first()[0] == np.minimum(a, limit).sum()
    for q in (0.01, 0.5, 0.9, 1.0):
        assert C.quantile(table, q).first()[0] == np.sort(a)[int(np.ceil(q * len(a))) - 1]


@pytest.mark.parametrize("high", [3, 500, 30_000])
def test_suffix_sums(spark, high):
    rng = random.Random(high)
    check(spark, [rng.randint(0, high) for _ in range(400)])


def test_lengths_of_odd_rows_and_empty_table(spark, docs_of, odd_rows, extra_columns):
    c = bpe.codec(tokenizer_path())
    want = sorted((i, len(c.encode(t or ""))) for i, t in odd_rows)
    assert sorted(tuple(r) for r in C.lengths(extra_columns, tokenizer_path()).collect()) == want
    empty = C.limits(C.histogram(C.lengths(docs_of([]), tokenizer_path())))
    assert empty.collect() == [] and C.truncated_total(empty, 5).first()[0] == 0
