"""The pipeline, stage by stage, against brute-force versions."""

import hashlib
import random
import re

from conftest import SF001

from llm_fixtures import docs_of, extra_columns, odd_rows  # noqa: F401
import corpus_pipeline as P
from strata.llm import bpe, quality_rules
from strata.llm.queries import tokenizer_path
from test_ngram_join import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_dict(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_over_the_small_table(spark):
    assert [n for n, _ in P.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    start = as_dict(docs)

    clean = P.kept_table(P.quality_stage(spark, docs, SF001), "t")
    judged = {r["doc_id"] for r in quality_rules.verdicts(quality_rules.ledger(docs)).filter("kept").collect()}
    assert clean.columns == COLUMNS and as_dict(clean) == {i: start[i] for i in judged}

    single = P.kept_table(P.exact_stage(spark, clean, SF001), "t")
    last = {}
    for i in sorted(judged):
        last[start[i]] = i
    assert single.columns == COLUMNS and as_dict(single) == {i: t for t, i in last.items()}

    apart = P.kept_table(P.near_stage(spark, single, SF001), "t")
    ids = sorted(last.values())
    sets = {i: shingle_set(start[i]) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in ids:
        for b in ids:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert apart.columns == COLUMNS and sorted(as_dict(apart)) == sorted({find(i) for i in ids})

    mixed = P.kept_table(P.mixing_stage(spark, apart, SF001), "t")
    assert mixed.columns == COLUMNS
    size = sum(len(WORD.findall(t)) for t in as_dict(apart).values())
    got = [(r["doc_id"], WORD.findall(r["text"])) for r in mixed.collect()]
    assert abs(sum(len(w) for _, w in got) - size) < 0.02 * size + 200
    for i, w in got:
        it = iter(WORD.findall(start[i]))
        assert w and all(x in it for x in w)  # the words taken, in order
    assert max(sum(i == d for d, _ in got) for i in {d for d, _ in got}) <= 3

    coded = P.encoding_stage(spark, mixed, SF001).collect()
    c = bpe.codec(tokenizer_path())
    assert sorted(c.decode(r["ids"]) for r in coded) == sorted(r["text"] for r in mixed.collect())
    assert all(r["n_tokens"] == len(r["ids"]) for r in coded)


def test_run_is_the_stages_in_a_row_and_repeats(spark):
    digest = lambda df: sorted((r["doc_id"], hashlib.md5(str(r["ids"]).encode()).hexdigest()) for r in df.collect())
    assert digest(P.run(spark, SF001)) == digest(P.run(spark, SF001))


def test_stages_on_odd_rows_and_an_empty_table(spark, docs_of, odd_rows, extra_columns):
    rng = random.Random(0)
    words = [f"q{i}" for i in range(500)]
    more = [(100 + i, " ".join(rng.choices(words, k=80))) for i in range(20)]
    for docs in (docs_of(odd_rows + more), extra_columns, docs_of([])):
        for _, stage in P.STAGES:
            docs = P.kept_table(stage(spark, docs, ""), "t")
            docs.count()


def test_encoding_stage_decodes_and_compares(spark, docs_of, odd_rows):
    got = [(r["doc_id"], r["decoded_sha256"], r["round_trip"]) for r in P.encoding_stage(spark, docs_of(odd_rows), "").collect()]
    assert sorted(got) == sorted((i, hashlib.sha256((t or "").encode()).hexdigest(), True) for i, t in odd_rows)
