"""Word lists of any size against one test per word."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.functions.text import TOXIC_WORDS, flag_word_hits
from strata.operators import word_list as W


def listed(spark, words):
    return spark.createDataFrame([(w,) for w in words], "w string")


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, t string")


LETTERS = "abcé😀 z"


def some_texts(rng, n):
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 3, 31, 32, 33, 64, 100, 500]))) for _ in range(n)]
    return out + [None, "", "\n", "a\nb", "a" * 5000]


@pytest.mark.parametrize("bound", [W.PATTERN_BYTES, 10])
def test_substrings_of_a_large_list_equal_a_test_per_word(spark, bound, monkeypatch):
    monkeypatch.setattr(W, "PATTERN_BYTES", bound)
    rng = random.Random(5)
    words = {"".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 45))) for _ in range(10_000)}
    ts = some_texts(rng, 60)
    ts += [rng.choice(sorted(words)) + " x " + rng.choice(sorted(words)) for _ in range(100)]
    want = [(i, sum(w in ("g" if t is None else t) for w in words)) for i, t in enumerate(ts)]
    df = W.listed_word_hits(texts(spark, ts), ["id"], "t", listed(spark, sorted(words) + [None, ""]), "w")
    assert rows(df) == sorted(want, key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("mode", ["substring", "word"])
@pytest.mark.parametrize("fold", [False, True])
def test_equal_to_the_pass_per_word(spark, mode, fold):
    rng = random.Random(6)
    parts = [*TOXIC_WORDS, "Ass", "EZ", "ok", ",", " ", "é", "passez", "n00b"]
    t = texts(spark, ["".join(rng.choice(parts) + rng.choice(["", " ", "-"]) for _ in range(12)) for _ in range(80)] + [None, ""])
    got = W.listed_word_hits(t, ["id"], "t", listed(spark, TOXIC_WORDS), "w", mode=mode, ignore_case=fold)
    assert rows(got) == rows(t.select("id", flag_word_hits("t", mode=mode, ignore_case=fold).alias("hits")))


@pytest.mark.parametrize("mode", ["substring", "word"])
def test_a_list_beyond_the_broadcast_bound_is_merged(spark, mode, monkeypatch):
    t = texts(spark, ["".join(random.Random(i).choices("ab c", k=300)) for i in range(20)])
    words = listed(spark, ["ab", "abab", "c", "a", "bbbbb"])
    small = W.listed_word_hits(t, ["id"], "t", words, "w", mode=mode)
    monkeypatch.setattr(W, "BROADCAST_BYTES", 10)
    monkeypatch.setattr(W, "PATTERN_BYTES", 10)
    large = W.listed_word_hits(t, ["id"], "t", words, "w", mode=mode)
    assert rows(small) == rows(large)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_which_words_and_shared_or_null_keys(spark):
    t = spark.createDataFrame([(1, "abc", 9), (1, "cab", 8), (None, "b", 7), (None, "zz", 7)], "id long, t string, word int")
    assert rows(W.listed_words(t, ["id"], "t", listed(spark, ["ab", "bc", "b", "b"]), "w")) == \
        sorted([(1, "ab"), (1, "bc"), (1, "b"), (None, "b")], key=repr)
    assert rows(W.listed_word_hits(t, ["id"], "t", listed(spark, ["ab", "ca", "q"]), "w")) == sorted([(1, 2), (None, 0)], key=repr)


def test_marks_of_patterns_are_plain_text_in_a_list(spark):
    words = ["a.c", "(", "[x]", "\\d", "^", "a|b", "#-&~", "\n", "😀", "é", "E\\Q", "$1", "a.", "-"]
    ts = ["abc a.c", "(x) [x]", "\\d 1", "a|b ^ #-&~", "\n😀é", "\\E\\Q$1", "a\ud7ffb"]
    got = W.listed_word_hits(texts(spark, ts), ["id"], "t", listed(spark, words), "w")
    assert rows(got) == [(i, sum(w in t for w in words)) for i, t in enumerate(ts)]


def test_empty_lists_and_tables(spark):
    none = listed(spark, ["x"]).limit(0)
    for mode in ("substring", "word"):
        assert rows(W.listed_word_hits(texts(spark, ["x y", None]), ["id"], "t", none, "w", mode=mode)) == [(0, 0), (1, 0)]
        assert rows(W.listed_word_hits(texts(spark, ["x"]).limit(0), ["id"], "t", listed(spark, ["x"]), "w", mode=mode)) == []


def test_a_listed_word_that_is_no_single_word_raises_in_word_mode(spark):
    with pytest.raises(Exception, match="letters and digits"):
        W.listed_word_hits(texts(spark, ["x y"]), ["id"], "t", listed(spark, ["x y"]), "w", mode="word").collect()
    with pytest.raises(ValueError):
        W.listed_word_hits(texts(spark, ["x"]), ["id"], "t", listed(spark, ["x"]), "w", mode="other")


def test_listed_runs_in_repeated_words_of_one_partition(spark):
    words = ["ab", "b", "bc", "1a", "é", "ß1", "x y"]
    ts = ["abc abc, abc-abc", "a b c", "1ab\n1ab é", "aß1é", "", None, "x y xy"]
    for listed_words in (words[:-1], words):  # the last one is no run of letters and digits
        one = texts(spark, ts).coalesce(1)
        got = W.listed_word_hits(one, ["id"], "t", listed(spark, listed_words), "w")
        assert rows(got) == [(i, sum(w in (t or "g") for w in listed_words)) for i, t in enumerate(ts)]
        assert "RoundRobinPartitioning" in got._jdf.queryExecution().toString()
