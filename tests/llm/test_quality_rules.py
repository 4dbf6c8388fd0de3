"""The quality ledger against a per-text version."""

import re
from collections import Counter

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
from strata.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    ws = WORD.findall(t)
    tri = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {i + k for i in range(len(ws) - 2) if tri[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "n_plain_words": sum(not re.search(r"[#*$%&|<>]", w) for w in ws)}


def test_measurements_equal_a_per_text_version(docs_of, odd_rows, extra_columns):
    want = sorted((i, tuple(brute(t).values())) for i, t in odd_rows)
    for d in (docs_of(odd_rows), extra_columns):
        got = sorted((r["doc_id"], tuple(r[k] for k in brute(""))) for r in Q.ledger(d).collect())
        assert got == want


def test_bits_verdicts_and_policies(docs_of, odd_rows):
    led = Q.ledger(docs_of(odd_rows)).cache()
    for r in Q.verdicts(led).collect():
        base = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == base
        assert r["kept"] == (r["failed_bits"] == 0)
        assert not (base and r["kept"])
    bits = [r["failed_bits"] for r in led.collect()]
    for p in Q.POLICIES:
        mask = Q.mask_of(Q.POLICIES[p])
        kept = sum(b & mask == 0 for b in bits)
        assert Q.apply_policy(led, p).filter("kept").count() == kept
        rows = {r["rule"]: r for r in Q.ablation(led, p).collect()}
        assert set(rows) == set(Q.POLICIES[p])
        for name, r in rows.items():
            bit = Q.mask_of([name])
            assert r["n_failed"] == sum(bool(b & bit) for b in bits)
            assert r["n_failed_alone"] == sum(b & mask == bit for b in bits)
            assert (r["n_kept"], r["n_kept_without"]) == (kept, sum(b & mask & ~bit == 0 for b in bits))


def test_keep_clean_returns_the_kept_rows_with_all_columns(extra_columns, odd_rows):
    kept = sorted(r["doc_id"] for r in Q.verdicts(Q.ledger(extra_columns)).filter("kept").collect())
    out = Q.keep_clean(extra_columns)
    assert out.columns == extra_columns.columns
    assert sorted(r["doc_id"] for r in out.collect()) == kept and kept


def test_policies_read_the_stored_ledger_and_no_text(docs_of, odd_rows, tmp_path, monkeypatch):
    led = Q.stored_ledger(docs_of(odd_rows), str(tmp_path / "ledger"))
    want = sorted((p, *r) for p in Q.POLICIES for r in Q.ablation(Q.ledger(docs_of(odd_rows)), p).collect())
    monkeypatch.setattr(Q, "_measure", None)  # nothing is measured again
    for df in (Q.verdicts(led, "v1"), Q.ablations(led)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "text" not in plan
    assert sorted(tuple(r) for r in Q.ablations(led).collect()) == want


def test_null_ids_are_judged_row_by_row(docs_of):
    good = " ".join(f"word{i}" for i in range(60))
    docs = docs_of([(None, good), (None, "too short"), (None, None), (3, good)])
    got = sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in Q.verdicts(Q.ledger(docs)).collect())
    assert got == [(0, 0, False), (0, 2, False), (0, 60, True), (3, 60, True)]
    assert sorted(r["doc_id"] or 0 for r in Q.keep_clean(docs).collect()) == [0, 3]


def test_empty_table(docs_of):
    empty = docs_of([])
    assert Q.ledger(empty).collect() == [] and Q.keep_clean(empty).collect() == []
    assert [r["n_kept"] for r in Q.ablation(Q.ledger(empty)).collect()] == [0] * len(Q.RULES)
