"""Two-pass Bloom dedup against grouping by the text itself."""

import hashlib
from collections import defaultdict

import pytest

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return groups


@pytest.mark.parametrize("options", [{}, {"bits_per_row": 1, "k": 1}, {"max_bits": 1}])
def test_groups_equal_grouping_by_text(docs_of, odd_rows, options):
    rows = odd_rows + [(None, "null id"), (None, "null id"), (30, "null id"), (None, "alone")]
    got = X.mark(docs_of(rows), carry=["doc_id"], **options).collect()
    groups = brute(rows)
    assert len(got) == len(rows)
    stay = defaultdict(int)
    by_sha = {hashlib.sha256(t.encode()).digest(): (t, ids) for t, ids in groups.items()}
    for r in got:
        t, ids = by_sha[bytes(r["sha"])]
        best = max(ids, key=lambda x: (x is not None, x or 0))
        assert r["row"]["doc_id"] in ids and r["keep_id"] == best and r["group_size"] == len(ids)
        assert not r["kept"] or r["row"]["doc_id"] == best
        stay[t] += r["kept"]
    assert set(stay.values()) == {1}  # exactly one row of each group, repeated rows included


def test_unique_rows_pass_without_a_shuffle(docs_of):
    docs = docs_of([(i, f"text {i}") for i in range(500)])
    m = X.mark(docs)
    assert m.filter("kept").count() == 500
    again = [r for r in m.select("group_size").collect() if r["group_size"] > 1]
    assert again == []


def test_native_plan_and_columns(extra_columns):
    m = X.mark(extra_columns)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    out = X.keep_one(extra_columns)
    assert out.columns == extra_columns.columns
    assert len({r["text"] or "" for r in out.collect()}) == out.count()


def test_empty_table(docs_of):
    assert X.mark(docs_of([])).collect() == []
